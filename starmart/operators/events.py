"""Review, check-in and tip events.

``activity_rows`` turns the three sources into one stream of additive counters.
Every fact at business level is a rollup of it, and so is ``daily_activity``,
which has the same columns: facts can be built from the raw events in one
shuffle, or from a stored, compacted copy without reading the events again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.dates import parse_date, parse_timestamp
from starmart.functions.measures import EXACT, exact, mean
from starmart.functions.text import COMMA_ANY_SPACE, COMMA_SPACE, split_text
from starmart.operators.skew import heavy_keys

COUNTERS = [
    "review_rows", "review_count", "star_sum", "star_count",
    "checkin_count", "tip_count", "score_sum", "score_count",
]


def checkin_events(checkin: DataFrame, separator: str = COMMA_SPACE) -> DataFrame:
    """One row per readable check-in: (business_id, date)."""
    return _checkin_dates(checkin, separator).na.drop(subset=["date"])


def _checkin_dates(checkin: DataFrame, separator: str) -> DataFrame:
    return checkin.select(
        "business_id", F.explode(split_text("date", separator)).alias("text")
    ).select("business_id", parse_date("text").alias("date"))


def activity_rows(
    review: DataFrame | None = None,
    checkin: DataFrame | None = None,
    tip: DataFrame | None = None,
    score_col: str | None = None,
) -> DataFrame:
    """(business_id, date, counters) with one row per event; unreadable dates are null.

    ``score_col`` names an optional per-review score.
    """
    return _counted(_event_rows(review, checkin, tip, score_col))


#: What an event is, in ``_event_rows``.
REVIEW, REVIEW_WITHOUT_ID, CHECKIN, TIP = range(4)


def _event_rows(review: DataFrame | None, checkin: DataFrame | None, tip: DataFrame | None, score_col: str | None) -> DataFrame:
    """(business_id, date, kind, stars, score): one narrow row per event, from which ``_counted`` makes the counters."""
    stars = review.schema["stars"].dataType if review is not None else "double"
    score = review.schema[score_col].dataType if review is not None and score_col else "double"

    def row(events: DataFrame, kind: Column, *values: Column) -> DataFrame:
        found = values or (F.lit(None).cast(stars), F.lit(None).cast(score))
        return events.select("business_id", "date", kind.cast("tinyint").alias("kind"),
                             *[v.alias(name) for v, name in zip(found, ("stars", "score"))])

    parts = []
    if review is not None:
        scored = F.col(score_col) if score_col else F.lit(None).cast(score)
        parts.append(row(
            review.withColumn("date", parse_date("date")),
            F.when(F.col("review_id").isNotNull(), REVIEW).otherwise(REVIEW_WITHOUT_ID), F.col("stars"), scored))
    if checkin is not None:
        parts.append(row(_checkin_dates(checkin, COMMA_SPACE), F.lit(CHECKIN)))
    if tip is not None:
        parts.append(row(tip.select("business_id", parse_date("date").alias("date")), F.lit(TIP)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _counters() -> dict[str, Column]:
    """The counters of one event, as expressions over ``_event_rows``."""
    kind = F.col("kind")
    reviewed, stars, score = kind <= REVIEW_WITHOUT_ID, exact("stars"), exact("score")
    values = {
        "review_rows": reviewed, "review_count": kind == REVIEW, "checkin_count": kind == CHECKIN, "tip_count": kind == TIP,
        "star_sum": F.when(reviewed, stars).otherwise(0), "star_count": reviewed & stars.isNotNull(),
        "score_sum": F.when(reviewed, score).otherwise(0), "score_count": reviewed & score.isNotNull(),
    }
    return {name: values[name].cast(EXACT if name.endswith("_sum") else "bigint") for name in COUNTERS}


def _counted(rows: DataFrame) -> DataFrame:
    return rows.select("business_id", "date", *[value.alias(name) for name, value in _counters().items()])


def roll_up(activity: DataFrame, *keys, counters: list[str] = COUNTERS) -> DataFrame:
    """Sum the counters by ``keys``."""
    return activity.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def daily_activity(activity: DataFrame) -> DataFrame:
    """Counters by business and day. Rows without a date stay, under a null date."""
    return roll_up(activity, "business_id", "date")


def placed_daily_activity(
    review: DataFrame, checkin: DataFrame, tip: DataFrame, buckets: int, score_col: str | None = None
) -> DataFrame:
    """``daily_activity`` of all events, dealt by business to ``buckets`` partitions, in one shuffle of narrow rows.

    The events of a business with more than an even partition of them are counted by day before, so no task receives more
    than its days.
    """
    rows = _event_rows(review, checkin, tip, score_col)
    busy = F.coalesce(F.array_contains(heavy_keys(rows, ["business_id"])[0], F.xxhash64("business_id")), F.lit(False))
    before = roll_up(_counted(rows.filter(busy)), "business_id", "date").select("business_id", "date", F.struct(*COUNTERS).alias("counted"))
    dealt = rows.filter(~busy).unionByName(before, allowMissingColumns=True).repartition(buckets, "business_id")
    counters = [F.when(F.col("counted").isNotNull(), F.col("counted")[name]).otherwise(value).alias(name)
                for name, value in _counters().items()]
    return roll_up(dealt.select("business_id", "date", *counters), "business_id", "date")


SOURCE_COUNTERS = {"review": "review_rows", "checkin": "checkin_count", "tip": "tip_count"}


def dated(activity: DataFrame) -> DataFrame:
    """Rows usable in a business fact: a readable date.

    Events without a business form a group of their own, under a null business
    id, in every fact by business.
    """
    return activity.na.drop(subset=["date"])


def audit_counts(activity: DataFrame) -> list:
    """Aggregates for the audit, by source: events, those without a readable date, those without a business."""
    without = {"rows": F.lit(True), "bad_dates": F.col("date").isNull(),
               "no_business": F.col("date").isNotNull() & F.col("business_id").isNull()}
    return [F.coalesce(F.sum(F.when(condition, F.col(counter))), F.lit(0)).alias(f"{source}_{name}")
            for source, counter in SOURCE_COUNTERS.items() for name, condition in without.items()]


def rejected_dates(activity: DataFrame) -> DataFrame:
    """Number of events per source whose date could not be read."""
    totals = activity.agg(*audit_counts(activity)).select(*[F.col(f"{s}_bad_dates").alias(s) for s in SOURCE_COUNTERS])
    return totals.unpivot([], list(SOURCE_COUNTERS), "source", "rejected")


def activity_dates(activity: DataFrame) -> DataFrame:
    """Distinct days with any event."""
    return activity.select("date").distinct().na.drop()


def review_checkin_dates(activity: DataFrame) -> DataFrame:
    """Distinct days with a review or a check-in; tips do not count."""
    return activity_dates(activity.filter("review_rows + checkin_count > 0"))


def timestamp_dates(review: DataFrame, checkin: DataFrame, tip: DataFrame) -> DataFrame:
    """Distinct days of events whose text is a full timestamp."""
    texts = (
        review.select(F.col("date").alias("text"))
        .unionByName(tip.select(F.col("date").alias("text")))
        .unionByName(checkin.select(F.explode(split_text("date", COMMA_ANY_SPACE)).alias("text")))
    )
    return texts.select(parse_timestamp("text").cast("date").alias("date")).distinct().na.drop()


def activity_month_base(activity: DataFrame) -> DataFrame:
    """Distinct (business_id, year, month) with any event."""
    return dated(activity).select(
        "business_id", F.year("date").alias("year"), F.month("date").alias("month")
    ).distinct()


def monthly_counts(activity: DataFrame, counter: str) -> DataFrame:
    """One counter by business and calendar month."""
    return dated(activity).groupBy(
        "business_id", F.year("date").alias("year"), F.month("date").alias("month")
    ).agg(F.sum(counter).alias(f"{counter}_monthly"))


def business_review_stats(activity: DataFrame) -> DataFrame:
    """Average rating and number of reviews per business, whatever the review's date."""
    totals = roll_up(
        activity.filter("review_rows > 0"), "business_id", counters=["review_count", "star_sum", "star_count"]
    )
    return totals.select(
        "business_id",
        mean("star_sum", "star_count").alias("overall_avg_rating"),
        F.col("review_count").alias("overall_review_count"),
    )


def tip_counts(tip: DataFrame) -> DataFrame:
    return tip.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("tip_count"))


def checkin_counts(checkin: DataFrame) -> DataFrame:
    """Check-ins per business from the list length alone; null where no list is given.

    Summed, so that a business listed in several source rows has one count.
    """
    return checkin.groupBy("business_id").agg(
        F.sum(F.size(split_text("date", COMMA_ANY_SPACE))).alias("checkin_count")
    )
