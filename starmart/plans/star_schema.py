"""Build and store every star-schema table."""

from __future__ import annotations

import uuid
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from starmart.operators import bridges, dimensions as dims, events, facts
from starmart.operators.keys import assert_unique
from starmart.operators.skew import partitions
from starmart.sinks.tables import write_placed, write_table
from starmart.sources.star_tables import read_table

ACTIVITY = "activity/Daily_Activity"
UNKNOWN_USERS = "activity/Unknown_Users"
#: Facts that dashboards filter by business, laid out so that such a filter skips most files.
CLUSTERED = {
    "manager/Fact_Business_Performance": ["business_id", "month_id"],
    "operations/Fact_Operational_Performance": ["business_id", "date_id"],
    "marketing/FactCustomerEngagement": ["business_id", "date_id"],
}


def build_star_schema(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    out: str,
    score_col: str | None = None,
    parallel: int = 8,
    audit: dict[str, dict[str, int]] | None = None,
) -> dict[str, int]:
    """Write all tables below ``out`` and return their row counts.

    The tables are written to a new folder beside ``out`` and take its place
    only when all of them are complete, so a failed build leaves the old ones.
    ``audit`` receives, per source, the number of events, of those dropped for
    an unreadable date, and of those kept without a business; they are counted
    while the events are read for the build itself.

    The events are rolled up once into daily counters that lie by business, and
    most tables come from those without another shuffle. Tables are built from stored tables rather than from recomputed
    plans, so a lost executor costs a task and not a lineage. Tables that do
    not need one another are written by concurrent jobs.
    """
    business, review, checkin, tip, user = (
        sources[name] for name in ("business", "review", "checkin", "tip", "user")
    )
    written: dict[str, Future] = {}
    run = f"{out.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    seen = Observation()

    def stored(name: str) -> DataFrame:
        """The table under ``name``, as soon as it is written."""
        written[name].result()
        return read_table(spark, run, name)

    def activity() -> DataFrame:
        return written[ACTIVITY].result()

    def daily() -> DataFrame:
        buckets = partitions(review)
        days = events.placed_daily_activity(review, checkin, tip, buckets, score_col)
        return write_placed(days.observe(seen, *events.audit_counts(days)), f"{run}/{ACTIVITY}", "business_id", buckets)

    def unknown_users() -> DataFrame:
        written[UNKNOWN_USERS].result()
        return spark.read.schema("user_id string").parquet(f"{run}/{UNKNOWN_USERS}")

    def keyed_business() -> DataFrame:
        return assert_unique(stored("investor/Dim_Business"), ["business_nk"], "investor/Dim_Business")

    # In this order each table comes after those it is built from.
    tables = {
        "marketing/DimDate": lambda: dims.dim_date(events.timestamp_dates(review, checkin, tip), "marketing"),
        "marketing/DimBusiness": lambda: dims.dim_business_profile(business),
        "marketing/DimUser": lambda: dims.dim_user(user),
        "investor/Dim_Location": lambda: dims.dim_location_keys(business),
        "investor/Dim_Category": lambda: dims.dim_category_keys(business),
        "manager/Dim_Category": lambda: dims.dim_category(business),
        "manager/Dim_Location": lambda: dims.dim_location(business),
        UNKNOWN_USERS: lambda: facts.unknown_keys(review, stored("marketing/DimUser"), "user_id"),
        "marketing/DimReview": lambda: dims.dim_review(review),
        "marketing/FactCustomerEngagement": lambda: facts.engagement_fact(
            review, tip, checkin,
            stored("marketing/DimDate"), stored("marketing/DimUser"), stored("marketing/DimBusiness"), unknown_users(),
        ),
        "investor/Dim_Business": lambda: dims.dim_business_location(business, stored("investor/Dim_Location")),
        "investor/Dim_Date": lambda: dims.dim_date(events.review_checkin_dates(activity()), "investor"),
        "investor/Fact_Business_Performance": lambda: facts.daily_fact(
            activity(), keyed_business(), stored("investor/Dim_Date"), rolled=True
        ),
        "investor/Fact_Business_Categories": lambda: bridges.category_bridge_keys(
            business, stored("investor/Dim_Category"), keyed_business()
        ),
        "manager/Fact_Business_Performance": lambda: facts.monthly_fact(activity()),
        "manager/Fact_Business_Categories": lambda: bridges.category_bridge(
            business, stored("manager/Dim_Category")
        ),
        "manager/Dim_Business": lambda: dims.dim_business(business, events.business_review_stats(activity())),
        "manager/Dim_Date": lambda: dims.dim_date(events.activity_dates(activity()), "manager"),
        "marketing/BusinessCategoryBridge": lambda: bridges.business_category_bridge(
            stored("marketing/DimBusiness")
        ),
        "operations/Dim_Date": lambda: dims.dim_date(events.review_checkin_dates(activity()), "operations"),
        "operations/Fact_Operational_Performance": lambda: facts.operational_daily_fact(activity(), rolled=True),
    }
    with ThreadPoolExecutor(parallel) as pool:
        written[ACTIVITY] = pool.submit(daily)
        for name, table in tables.items():
            written[name] = pool.submit(lambda n=name, make=table: write_table(
                make(), f"{run}/{n}", cluster_by=CLUSTERED.get(n), placed=True))
    counts = {name: job.result() for name, job in written.items() if not name.startswith("activity/")}
    publish(spark, run, out)
    if audit is not None:
        for source in events.SOURCE_COUNTERS:
            audit[source] = {n: seen.get[f"{source}_{n}"] for n in ("rows", "bad_dates", "no_business")}
    return counts


def publish(spark: SparkSession, run: str, out: str) -> None:
    """Put the finished folder in the place of the old one, in whatever store the path belongs to."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(out), jvm.org.apache.hadoop.fs.Path(run)
    store = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = jvm.org.apache.hadoop.fs.Path(f"{run}-before")
    if store.exists(old):
        store.rename(old, before)
    if not store.rename(new, old):
        raise OSError(f"{run} could not be published as {out}")
    store.delete(before, True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def row_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The row-count audit as a frame; one row per table."""
    return spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")
