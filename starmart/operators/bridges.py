"""Business-to-category bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.operators.dimensions import investor_categories, manager_categories
from starmart.operators.skew import heavy_keys, lookup_join


def category_bridge(business: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Distinct (business_id, category_id)."""
    return _with_category(manager_categories(business), dim_category).select("business_id", "category_id")


def category_bridge_keys(business: DataFrame, dim_category: DataFrame, dim_business: DataFrame) -> DataFrame:
    """Distinct (business_key, category_key); unknown businesses and categories drop out."""
    keys = dim_business.select(F.col("business_nk").alias("business_id"), "business_key")
    linked = _with_category(investor_categories(business), dim_category)
    # A business has as many rows here as it lists categories, so this join has no heavy keys.
    return linked.join(keys, "business_id").select("business_key", "category_key")


def _with_category(listed: DataFrame, dim_category: DataFrame) -> DataFrame:
    heavy = heavy_keys(listed, ["category_name"])[0]
    return lookup_join(
        listed.distinct(), dim_category, ["category_name"], "inner", [(heavy, ["category_name"])]
    )


def business_category_bridge(profile: DataFrame) -> DataFrame:
    """(business_id, category) as listed, repeats included."""
    return profile.select("business_id", F.explode("categories").alias("category")).filter("category != ''")
