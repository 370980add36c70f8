"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.dates import date_id, date_key, month_id, parse_timestamp
from starmart.functions.measures import engagement_score, growth_rate, mean
from starmart.operators.events import checkin_counts, dated, roll_up, tip_counts
from starmart.operators.keys import digest, digest_bucket, number_groups, number_rows
from starmart.operators.skew import heavy_keys, partitions


def monthly_fact(activity: DataFrame) -> DataFrame:
    """Monthly performance per business.

    Growth compares with the previous month in which the business had any
    event, not with the previous calendar month. It is null for the first
    month and after a month without reviews.
    """
    month = F.trunc("date", "month").alias("month")
    counts = roll_up(dated(activity), "business_id", month,
                     counters=["review_count", "checkin_count", "tip_count"])
    # The window holds one row per month of a business, however busy it is.
    previous = F.lag("review_count").over(Window.partitionBy("business_id").orderBy("month"))
    return counts.select(
        "business_id", month_id("month").alias("month_id"), "review_count", "checkin_count", "tip_count",
        F.lit(0).alias("photo_count"),  # no source carries photos
        growth_rate(F.col("review_count"), previous).alias("growth_rate"),
    ).select(
        "business_id", "month_id", "review_count", "checkin_count", "tip_count", "photo_count",
        engagement_score("review_count", "tip_count", "photo_count", "checkin_count").alias("engagement_score"),
        "growth_rate",
    )


def daily_rollup(activity: DataFrame, rolled: bool = False) -> DataFrame:
    """Counters by business and day for days with a review or a check-in.

    ``rolled`` says that the activity is ``daily_activity`` already, one row per business and day, and needs no shuffle.
    """
    counters = ["review_rows", "review_count", "star_sum", "star_count", "checkin_count", "score_sum", "score_count"]
    rows = dated(activity)
    days = rows.select("business_id", "date", *counters) if rolled else roll_up(rows, "business_id", "date", counters=counters)
    return days.filter("review_rows + checkin_count > 0")


def daily_fact(activity: DataFrame, dim_business: DataFrame, dim_date: DataFrame, rolled: bool = False) -> DataFrame:
    """Daily performance per business with surrogate keys; rating 0 on days without reviews.

    Events are rolled up before the key lookups, so the joins see one row per
    business and day. With ``rolled`` each business has one row in ``dim_business``;
    of activity that lies by business no row is moved then.
    """
    businesses = dim_business.select(F.col("business_nk").alias("business_id"), "business_key")
    # Days are made unique, so one row per calendar day at most.
    dates = F.broadcast(dim_date.select(F.col("full_date").alias("date")).distinct())
    keyed = (
        daily_rollup(activity, rolled)
        .join(dates, "date", "left_semi")
        .join(businesses, "business_id")
        .select(
            "business_id", "business_key", date_key("date").alias("date_key"), "review_count",
            F.coalesce(mean("star_sum", "star_count"), F.lit(0.0)).alias("average_stars"),
            "checkin_count",
            # business_key counts businesses in digest order, so this bucket grows with it
            digest_bucket(digest("business_id")).alias("bucket"),
        )
    )
    if rolled:
        numbered = number_groups(keyed, "performance_key", "business_id", "business_key", "bucket", "date_key")
    else:
        numbered = number_rows(keyed.drop("business_id"), "performance_key", "bucket", ["business_key", "date_key"])
    return numbered.select(
        "performance_key", "business_key", "date_key", "review_count", "average_stars", "checkin_count"
    )


def operational_daily_fact(activity: DataFrame, missing_rating: float | None = None, rolled: bool = False) -> DataFrame:
    """Daily operations per business. A day without reviews has no rating unless one is given."""
    rating = mean("star_sum", "star_count")
    if missing_rating is not None:
        rating = F.coalesce(rating, F.lit(missing_rating))
    return daily_rollup(activity, rolled).select(
        date_id("date").alias("date_id"), "business_id",
        F.col("review_count").alias("daily_reviews"),
        rating.alias("avg_daily_rating"),
        F.col("checkin_count").alias("daily_checkins"),
        mean("score_sum", "score_count").alias("sentiment_score_avg"),
    )


def engagement_rows(
    review: DataFrame, dim_date: DataFrame | None, dim_user: DataFrame, dim_business: DataFrame
) -> DataFrame:
    """Reviews whose date, user and business are known; the fact without its counts.

    Without a calendar every readable date is known, as it is to a calendar made from these reviews.
    Plain semi-joins on dimensions that are no aggregates: adaptive execution splits any number of hot keys. The
    user comes last, so that a later grouping by business has a shuffle of its own.
    """
    rows = _review_keys(review, dim_date)
    return _known(_known(rows, dim_business, "business_id"), dim_user, "user_id")


def engagement_rows_without(review: DataFrame, unknown_users: DataFrame, unknown_businesses: DataFrame) -> DataFrame:
    """``engagement_rows`` of every readable date, from the stored ``unknown_keys`` of the reviews: known ones are not moved."""
    return without(without(_review_keys(review, None), unknown_businesses, "business_id"), unknown_users, "user_id")


def engagement_fact(
    review: DataFrame, tip: DataFrame, checkin: DataFrame,
    dim_date: DataFrame | None, dim_user: DataFrame, dim_business: DataFrame, unknown_users: DataFrame | None = None,
) -> DataFrame:
    """One row per review, with the tips of its user for its business and the business's check-ins.

    Every review of a user-business pair carries the pair's tip count, and
    every review of a business the business's check-in count, so neither may
    be summed over reviews.

    The reviews are moved once, by business, together with the tip counts of the pairs. The rows of a heavy business are
    dealt by their user, those of a heavy pair at random, and its tip count goes to all of them. ``unknown_users`` are the
    reviews' ``unknown_keys``, if the caller has them: the reviews then meet these few and not the users.
    """
    heavy_user, heavy_business = heavy_keys(review, ["user_id"], ["business_id"])
    spread = partitions(review)
    rows = _review_keys(review, dim_date)
    rows = _known(rows, dim_user, "user_id") if unknown_users is None else without(rows, unknown_users, "user_id")
    rows = rows.filter("business_id is not null")

    def heavy(hashes: Column, key: str) -> Column:
        return F.coalesce(F.array_contains(hashes, F.xxhash64(key)), F.lit(False))

    busy, by_user, salts = heavy(heavy_business, "business_id"), F.pmod(F.xxhash64("user_id"), F.lit(spread)).cast("int"), F.sequence(F.lit(0), F.lit(spread - 1))
    # A pair can only be heavy when its user and its business are.
    pair = busy & heavy(heavy_user, "user_id")
    # As in lookup_join, the salt of a row is the same however often its task is retried.
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(spread)).cast("int")
    rows = rows.withColumn("_salt", F.when(pair, dealt).when(busy, by_user).otherwise(0))
    tips = tip_counts(tip).filter("user_id is not null and business_id is not null").withColumn(
        "_salt", F.explode(F.when(pair, salts).when(busy, F.array(by_user)).otherwise(F.array(F.lit(0)))))
    # One lookup answers both "is the business known" and "how many check-ins".
    businesses = dim_business.select("business_id").distinct().join(
        checkin_counts(checkin), "business_id", "left"
    ).withColumn("_salt", F.explode(F.when(busy, salts).otherwise(F.array(F.lit(0)))))

    of_pair = Window.partitionBy("business_id", "_salt", "user_id")
    rows = (
        rows.unionByName(tips, allowMissingColumns=True).repartition("business_id", "_salt")
        .withColumn("tip_count", F.max("tip_count").over(of_pair)).filter("date_id is not null")  # the reviews
        .join(businesses, ["business_id", "_salt"])
    )
    return rows.select(
        "review_id", "user_id", "business_id", "date_id", "stars", "useful_votes", "funny_votes", "cool_votes",
        F.coalesce("tip_count", F.lit(0)).alias("tip_count"),
        F.coalesce("checkin_count", F.lit(0)).alias("checkin_count"),
    )


def unknown_keys(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """The keys of the rows that the dimension does not have, each once. Only keys are moved, none of them twice by a task."""
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().join(dimension.select(key), key, "left_anti")


def without(rows: DataFrame, unknown: DataFrame, key: str) -> DataFrame:
    """Rows whose key is known: neither missing nor one of the stored ``unknown`` ones, which rarely are too many to broadcast."""
    known = rows.filter(F.col(key).isNotNull())
    return known if unknown.isEmpty() else known.join(unknown, key, "left_anti").select(*rows.columns)


def _review_keys(review: DataFrame, dim_date: DataFrame | None) -> DataFrame:
    rows = review.select(
        "review_id", "user_id", "business_id",
        parse_timestamp("date").cast("date").alias("date"),
        F.col("stars").cast("int").alias("stars"),
        F.col("useful").alias("useful_votes"),
        F.col("funny").alias("funny_votes"),
        F.col("cool").alias("cool_votes"),
    )
    if dim_date is None:
        return rows.withColumn("date_id", date_key("date")).drop("date").filter("date_id is not null")
    # One row per calendar day at most, and never a null one.
    days = F.broadcast(dim_date.select(F.col("full_date").alias("day")).na.drop().distinct())
    # The null-safe match equals a plain one here, without the null check that
    # Spark would push below the projection, parsing every date a second time.
    rows = rows.join(days, F.col("date").eqNullSafe(F.col("day")), "left_semi")
    return rows.withColumn("date_id", date_key("date")).drop("date")


def _known(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension has; a semi-join repeats no row, however often the dimension lists the key.

    A missing key is known to no dimension. Said as a filter, every reader of the rows has the same one below the joins,
    whether it asks for the key or not, and their shuffles are made once.
    """
    return rows.filter(F.col(key).isNotNull()).join(dimension.select(key), key, "left_semi").select(*rows.columns)
