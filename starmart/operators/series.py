"""Shaping of query results for charts. Inputs are small results, not facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def trend_series(trend: DataFrame, value: str, month: str = "month_id") -> DataFrame:
    """(date, value) from ``yyyyMM`` months; unreadable months and values drop out."""
    points = trend.select(
        F.try_to_timestamp(month, F.lit("yyyyMM")).cast("date").alias("date"),
        F.col(value).try_cast("double").alias("value"),
    )
    return points.filter(F.col("date").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))


def weekly_series(weekly: DataFrame, week: str, value: str) -> DataFrame:
    """(date, value) from weeks given as a date, as ISO text or as epoch seconds."""
    text = F.col(week).cast("string")
    date = F.coalesce(
        F.timestamp_seconds(text.try_cast("bigint")).cast("date"),  # first: a short number reads as a year
        F.substring(text, 1, 10).try_cast("date"),
    )
    return weekly.select(date.alias("date"), F.col(value).alias("value")).na.drop(subset=["date"])


def stars_series(monthly: DataFrame) -> DataFrame:
    """(date, value) from (year, month, average_stars), in date order."""
    return monthly.select(
        F.make_date("year", "month", F.lit(1)).alias("date"), F.col("average_stars").alias("value")
    ).orderBy("date")


def vote_series(votes: DataFrame) -> DataFrame:
    """The three vote totals as (label, value) rows."""
    renamed = votes.select(
        F.col("total_useful").alias("Useful"), F.col("total_funny").alias("Funny"), F.col("total_cool").alias("Cool")
    )
    return renamed.unpivot([], ["Useful", "Funny", "Cool"], "label", "value")


def label_series(result: DataFrame, label: str, value: str) -> DataFrame:
    return result.select(F.col(label).alias("label"), F.col(value).alias("value"))


def share_of_total(result: DataFrame, value: str) -> DataFrame:
    """Add each row's share of the total. Meant for results of a few rows, such as the user groups."""
    total = F.sum(value).over(Window.partitionBy())
    return result.withColumn("share", F.try_divide(F.col(value), total))
