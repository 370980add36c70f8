"""Exact distinct counts that can be merged: bitmaps over dense keys.

``COUNT(DISTINCT business_id)`` over a range of months cannot be added up from monthly counts. A bitmap per month can be:
bit k stands for the business with key k, and the union of months is a bitwise or. A bitmap covers 32,768 keys, so a
month has a row of 4 KB per bucket of keys in which any business was active, however many events there were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def monthly_bitmaps(monthly: DataFrame, keys: DataFrame, key: str = "business_key") -> DataFrame:
    """(month_id, bucket, members): the businesses with a row in ``monthly``; events without a business are nobody's.

    ``keys`` maps business_id to a positive dense ``key``.
    """
    return (
        monthly.select("month_id", "business_id").join(keys.select("business_id", key), "business_id")
        .groupBy("month_id", F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("members"))
    )


def distinct_by(bitmaps: DataFrame, period: Column, name: str = "num_businesses") -> DataFrame:
    """Distinct businesses per ``period``, an expression over ``month_id``; from the stored bitmaps alone."""
    merged = bitmaps.groupBy(period.alias("period"), "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("members")).alias(name))


def distinct_between(bitmaps: DataFrame, first: str, last: str, name: str = "num_businesses") -> DataFrame:
    """One row: distinct businesses in the months from ``first`` to ``last`` (yyyyMM, both included)."""
    merged = bitmaps.where(F.col("month_id").between(first, last)).groupBy("bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(name))
