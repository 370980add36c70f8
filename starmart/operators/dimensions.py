"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from starmart.functions import dates as D
from starmart.functions.measures import null_safe_sum
from starmart.functions.text import (
    BLANK, BLANK_OR_NULL_TEXT, COMMA, COMMA_ANY_SPACE, COMMA_SPACE, split_text, subcategory, valid_token,
)
from starmart.operators.keys import dense_key
from starmart.operators.skew import lookup_join
from starmart.schemas import COMPLIMENTS

PLACE = ["city", "state", "postal_code", "latitude", "longitude"]


def calendar(dates: DataFrame) -> DataFrame:
    """Every calendar attribute of the distinct days in ``dates`` (one ``date`` column).

    The result has at most one row per day of the calendar.
    """
    return dates.select(
        "date",
        D.date_key("date").alias("date_key"),
        D.date_id("date").alias("date_id"),
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekday("date").alias("weekday"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.date_format("date", "MMMM").alias("month_name"),
        D.is_weekend("date").alias("is_weekend"),
    )


def dim_date(dates: DataFrame, profile: str) -> DataFrame:
    """Projection of the calendar for one schema."""
    days = calendar(dates)
    date = F.col("date")
    if profile == "manager":
        return days.select("date_id", "date", "month", "year", "quarter", "is_weekend")
    if profile == "marketing":
        return days.select(
            F.col("date_key").alias("date_id"), date.alias("full_date"), "day", "month", "quarter", "year",
            F.col("day_name").alias("day_of_week"),
        ).orderBy("date_id")
    if profile == "investor":
        return days.select(
            "date_key", date.alias("full_date"), "year", "month", "day", F.col("weekday").alias("day_of_week"),
            "day_name", "month_name", "quarter", "is_weekend",
        ).orderBy("full_date")
    if profile == "operations":
        return days.select("date_id", "date", F.col("day_name").alias("day_of_week"))
    raise ValueError(f"unknown date profile {profile!r}")


def dim_location(business: DataFrame) -> DataFrame:
    """One location per business."""
    return business.select(F.col("business_id").alias("location_id"), "business_id", *PLACE).distinct()


def distinct_locations(business: DataFrame) -> DataFrame:
    """Distinct places; null attributes compare equal."""
    return business.select(*PLACE).distinct()


def dim_location_keys(business: DataFrame) -> DataFrame:
    """One numbered location per distinct place."""
    return dense_key(distinct_locations(business), "location_key", PLACE)


def listed_categories(business: DataFrame, separator: str, drop: list[str]) -> DataFrame:
    """(business_id, category_name), one row per listed category, invalid texts left out."""
    return business.select(
        "business_id", F.explode(split_text("categories", separator)).alias("category_name")
    ).filter(valid_token("category_name", drop))


def manager_categories(business: DataFrame) -> DataFrame:
    return listed_categories(business, COMMA_ANY_SPACE, BLANK_OR_NULL_TEXT)


def investor_categories(business: DataFrame) -> DataFrame:
    return listed_categories(business, COMMA_SPACE, BLANK)


def dim_category(business: DataFrame) -> DataFrame:
    names = manager_categories(business).select("category_name").distinct()
    return dense_key(names, "category_id", ["category_name"])


def dim_category_keys(business: DataFrame) -> DataFrame:
    names = investor_categories(business).select("category_name").distinct()
    return dense_key(names, "category_key", ["category_name"])


def business_subcategory(business: DataFrame) -> DataFrame:
    return business.select("business_id", subcategory("categories").alias("subcategory"))


def dim_business(business: DataFrame, review_stats: DataFrame) -> DataFrame:
    """Business with subcategory, overall rating and review count (0 without reviews)."""
    # Distinct before the join: copies of a business collapse on the map side.
    base = business.select(
        "business_id", "name", subcategory("categories").alias("subcategory"),
        (F.col("is_open") == 1).alias("is_open"),
    ).distinct()
    return base.join(review_stats, "business_id", "left").select(
        "business_id", "name", "subcategory", "is_open",
        F.col("overall_avg_rating").cast("decimal(3,1)").alias("overall_avg_rating"),
        F.coalesce("overall_review_count", F.lit(0)).alias("overall_review_count"),
    )


def dim_business_location(business: DataFrame, locations: DataFrame) -> DataFrame:
    """Numbered business with the key of its location.

    Missing coordinates match missing coordinates, so every business finds its place.
    """
    rows = business.select(
        F.col("business_id").alias("business_nk"), "name", "address", *PLACE, "stars", "review_count", "is_open"
    ).distinct()
    located = lookup_join(rows, locations.select(*PLACE, "location_key"), PLACE, "left", null_safe=True)
    return dense_key(located.drop(*PLACE), "business_key", ["business_nk"]).select(
        "business_key", "business_nk", "name", "address", "location_key", "stars", "review_count", "is_open"
    )


def attributes_json(business: DataFrame, column: str = "attributes"):
    """Attributes as JSON text: structs are serialised, source text is passed through."""
    if isinstance(business.schema[column].dataType, T.StringType):
        return F.col(column)
    return F.to_json(column)


def dim_business_profile(business: DataFrame) -> DataFrame:
    """Business with its category list and attributes."""
    return business.select(
        "business_id", "name", split_text("categories", COMMA_ANY_SPACE).alias("categories"),
        *PLACE, F.col("is_open").cast("boolean").alias("is_open"),
        attributes_json(business).alias("attributes_json"),
    )


def dim_user(user: DataFrame) -> DataFrame:
    return user.select(
        "user_id", "name", D.parse_timestamp("yelping_since").cast("date").alias("yelping_since"),
        "review_count", "average_stars", "fans", split_text("elite", COMMA).alias("elite_years"),
        null_safe_sum(COMPLIMENTS).alias("compliment_count"),
    )


def dim_review(review: DataFrame) -> DataFrame:
    return review.select("review_id", F.col("text").alias("review_text"))
