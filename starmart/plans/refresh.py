"""The manager and operations schemas as versions, refreshed by the events that are new.

Facts are partitioned by month. A refresh rolls the new events up to days, merges them with the stored days of their
months, and rewrites those partitions alone; growth looks back, so a month behind a late event is rewritten too if a
value in it changes. Calendars and the business dimension are small rollups and are written anew. The result is the
same as a build from all events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.operators import bridges, dimensions as dims, events, facts
from starmart.plans.star_schema import ACTIVITY
from starmart.schemas import STAR_TABLES
from starmart.sinks.versions import Warehouse

MONTHLY, DAILY = "manager/Fact_Business_Performance", "operations/Fact_Operational_Performance"


def activity_schema(spark: SparkSession) -> str:
    sums = {c: events.EXACT if c.endswith("_sum") else "bigint" for c in events.COUNTERS}
    return ", ".join(["business_id string", "date date", *[f"{c} {kind}" for c, kind in sums.items()]])


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyyMM")


def read(warehouse: Warehouse, name: str, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
    schema = activity_schema(warehouse.spark) if name == ACTIVITY else STAR_TABLES[name]
    return warehouse.read(name, schema, version, parts)


def build(spark: SparkSession, sources: dict[str, DataFrame], root: str, score_col: str | None = None) -> int:
    """Both schemas from all events; the new version."""
    warehouse = Warehouse(spark, root)
    base, business = warehouse.version(), sources["business"]
    rows = events.activity_rows(sources["review"], sources["checkin"], sources["tip"], score_col)
    written = {ACTIVITY: warehouse.write(ACTIVITY, events.daily_activity(rows), month_of("date"))}
    activity = _stored(warehouse, written[ACTIVITY])
    written |= {
        MONTHLY: warehouse.write(MONTHLY, facts.monthly_fact(activity), F.col("month_id")),
        DAILY: warehouse.write(DAILY, facts.operational_daily_fact(activity, rolled=True), F.substring("date_id", 1, 6)),
        "manager/Dim_Location": warehouse.write("manager/Dim_Location", dims.dim_location(business)),
        "manager/Dim_Category": warehouse.write("manager/Dim_Category", dims.dim_category(business)),
    }
    categories = spark.read.schema(STAR_TABLES["manager/Dim_Category"]).parquet(f"{warehouse.root}/{written['manager/Dim_Category']['']}")
    name = "manager/Fact_Business_Categories"
    written[name] = warehouse.write(name, bridges.category_bridge(business, categories))
    return warehouse.commit(written | _summaries(warehouse, activity, business), base)


def add_events(
    spark: SparkSession, root: str, business: DataFrame, review: DataFrame | None = None, checkin: DataFrame | None = None,
    tip: DataFrame | None = None, score_col: str | None = None,
) -> int:
    """The stored version with more events; the new version."""
    warehouse = Warehouse(spark, root)
    base = warehouse.version()
    before = warehouse.manifest(base)
    given = warehouse.write(f"{ACTIVITY}_added", events.daily_activity(events.activity_rows(review, checkin, tip, score_col)))
    added = _stored(warehouse, given)
    months = sorted(r[0] for r in added.select(F.coalesce(month_of("date"), F.lit("none"))).distinct().collect())  # calendar months

    merged = read(warehouse, ACTIVITY, base, months).unionByName(added)
    days = warehouse.write(ACTIVITY, events.daily_activity(merged), month_of("date"))
    activity = {**before[ACTIVITY], **days}
    touched = _stored(warehouse, days)

    # Growth of the businesses with new events, over all their months; other businesses keep theirs.
    known = added.where("date is not null").select("business_id").distinct()
    own = F.col("business_id").eqNullSafe(F.col("_id"))
    old = read(warehouse, MONTHLY, base)
    theirs = old.join(known.select(F.col("business_id").alias("_id")), own, "left_semi")
    past = theirs.where(~F.col("month_id").isin(months)).select(
        "business_id", F.to_date(F.concat("month_id", F.lit("01")), "yyyyMMdd").alias("date"), "review_count", "checkin_count", "tip_count")
    now = touched.join(known.select(F.col("business_id").alias("_id")), own, "left_semi").select(*past.columns)
    recounted = warehouse.write(f"{MONTHLY}_added", facts.monthly_fact(past.unionByName(now)))
    fresh = spark.read.schema(STAR_TABLES[MONTHLY]).parquet(f"{warehouse.root}/{recounted['']}")
    moved = fresh.where(~F.col("month_id").isin(months)).join(
        theirs.select(F.col("business_id").alias("_id"), F.col("month_id").alias("_month"), F.col("growth_rate").alias("_growth")),
        own & (F.col("month_id") == F.col("_month"))).where(~F.col("growth_rate").eqNullSafe(F.col("_growth")))
    rewritten = sorted({*months} - {"none"} | {r[0] for r in moved.select("month_id").distinct().collect()})
    others = read(warehouse, MONTHLY, base, rewritten).join(known.select(F.col("business_id").alias("_id")), own, "left_anti")
    monthly = warehouse.write(MONTHLY, others.unionByName(fresh.where(F.col("month_id").isin(rewritten))), F.col("month_id"))
    daily = warehouse.write(DAILY, facts.operational_daily_fact(touched, rolled=True), F.substring("date_id", 1, 6))
    written = {ACTIVITY: activity, MONTHLY: {**before[MONTHLY], **monthly}, DAILY: {**before[DAILY], **daily}}
    version = warehouse.commit(written | _summaries(warehouse, _stored(warehouse, activity), business), base)
    for helper in (given, recounted):
        warehouse.discard(helper)
    return version


def _stored(warehouse: Warehouse, parts: dict[str, str]) -> DataFrame:
    spark = warehouse.spark
    if not parts:
        return spark.createDataFrame([], activity_schema(spark))
    return spark.read.schema(activity_schema(spark)).parquet(*[f"{warehouse.root}/{folder}" for folder in sorted(parts.values())])


def _summaries(warehouse: Warehouse, activity: DataFrame, business: DataFrame) -> dict[str, dict[str, str]]:
    """Tables of a row per day or per business."""
    frames = {
        "manager/Dim_Date": dims.dim_date(events.activity_dates(activity), "manager"),
        "operations/Dim_Date": dims.dim_date(events.review_checkin_dates(activity), "operations"),
        "manager/Dim_Business": dims.dim_business(business, events.business_review_stats(activity)),
    }
    return {name: warehouse.write(name, frame) for name, frame in frames.items()}
