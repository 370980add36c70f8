"""Registered queries over the sample tables: name -> (spark, sf_dir) -> DataFrame.

Each reads whole tables and stays lazy. Averages are rounded to six digits so
that results can be compared with another engine's; the library itself returns
unrounded values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart import schemas
from starmart.functions import dates as D, measures
from starmart.operators import bridges, dimensions as dims, distinct, events, facts, series
from starmart.operators.keys import dense_key, extend_keys
from starmart.operators.skew import partitions
from starmart.plans import dashboards as dash, refresh, sql_functions
from starmart.plans.star_schema import build_star_schema, remove, row_counts
from starmart.session import shared_dir
from starmart.sinks.results import payload
from starmart.sinks.tables import write_bucketed, write_by_year, write_placed, write_table
from starmart.sinks.versions import Warehouse
from starmart.sources import json_lines, samples
from starmart.streaming import daily_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(result: DataFrame) -> DataFrame:
    return result.select(*[
        F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in result.dtypes
    ])


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"


def keeper(spark: SparkSession, root: str) -> samples.Keep:
    def keep(name: str, frame: DataFrame) -> DataFrame:
        """A table that several plans need, stored once."""
        write_table(frame, f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")
    return keep


class Model:
    """Sources and tables of one data set, each a lazy plan over the given tables, or over what ``keep`` has stored."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: samples.Keep | None = None):
        sources = samples.sources(spark, sf_dir, keep)
        self.business, self.review, self.checkin, self.tip, self.user = (
            sources[name] for name in ("business", "review", "checkin", "tip", "user")
        )

    def activity(self, *names: str, score_col: str | None = None) -> DataFrame:
        return events.activity_rows(**{n: getattr(self, n) for n in names}, score_col=score_col)

    @cached_property
    def all_activity(self) -> DataFrame:
        return self.activity("review", "checkin", "tip")

    @cached_property
    def profile(self) -> DataFrame:
        return dims.dim_business_profile(self.business)

    @cached_property
    def dim_user(self) -> DataFrame:
        return dims.dim_user(self.user)

    @cached_property
    def timestamp_days(self) -> DataFrame:
        return dims.dim_date(events.timestamp_dates(self.review, self.checkin, self.tip), "marketing")

    @cached_property
    def dim_business(self) -> DataFrame:
        return dims.dim_business(self.business, events.business_review_stats(self.activity("review")))

    @cached_property
    def dim_business_location(self) -> DataFrame:
        return dims.dim_business_location(self.business, dims.dim_location_keys(self.business))

    @cached_property
    def monthly_fact(self) -> DataFrame:
        return facts.monthly_fact(self.all_activity)

    @cached_property
    def operations(self) -> DataFrame:
        return facts.operational_daily_fact(self.activity("review", "checkin", score_col="score"))

    @cached_property
    def operations_days(self) -> DataFrame:
        return dims.dim_date(events.review_checkin_dates(self.activity("review", "checkin")), "operations")

    @cached_property
    def engagement(self) -> DataFrame:
        """The engagement fact without its two count columns, which the dashboard does not read.

        Its calendar would be made from these very reviews, so every readable date is a known one.
        """
        return facts.engagement_rows(self.review, None, self.dim_user, self.profile)


# ---- sources and sinks ----


@query
def parse_timestamps(spark, sf_dir):
    """Timestamps parsed from clean, padded, single-digit, cut-off and empty texts."""
    review = Model(spark, sf_dir).review
    line = F.col("useful")
    moment = F.to_timestamp("date")
    text = (
        F.when(line == 1, F.concat(F.lit("  "), "date"))
        .when(line == 2, F.concat(F.year(moment), F.lit("-"), F.month(moment), F.lit("-"),
                                  F.dayofmonth(moment), F.lit(" 9:05:00")))
        .when(line == 3, F.substring("date", 1, 7))
        .when(line == 4, F.lit(""))
        .otherwise(F.col("date"))
    )
    dirty = review.select("review_id", text.alias("text"))
    return dirty.select("review_id", D.parse_timestamp("text").alias("review_date"))


@query
def json_reject_stats(spark, sf_dir):
    """Kept and rejected lines of a JSON file of all reviews in which some lines are cut off."""
    review = Model(spark, sf_dir).review.select(*schemas.REVIEW.fieldNames())
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("useful") == 7, F.expr("left(line, length(line) - 2)")).otherwise(F.col("line"))
    path = scratch(spark)
    review.select("useful", line.alias("line")).select(cut.alias("value")).write.text(path)
    return json_lines.json_reject_stats(spark, path, schemas.REVIEW)


@query
def attribute_values(spark, sf_dir):
    """Attributes as they stand in a JSON file of all businesses, with values read out of them by type."""
    business = Model(spark, sf_dir).business.select("business_id", "name", "attributes.brand", "attributes.size")
    text = F.concat(F.lit('{ "brand" :"'), "brand", F.lit('", "rates": [1.50, '), F.coalesce("size", F.lit(0)), F.lit("E1],"),
                    F.lit('"nested":{"size": '), F.coalesce(F.col("size").cast("string"), F.lit("null")), F.lit(".0 }  }"))
    text = F.replace(text, F.lit("null.0"), F.lit("null"))
    line = F.concat(F.lit('{"business_id": "'), "business_id", F.lit('", "attributes": '), text, F.lit(', "name": "'), "name", F.lit('"}'))
    path = scratch(spark)
    business.select(line.alias("value")).write.text(path)
    stored = dims.dim_business_profile(json_lines.read_json_lines(spark, path, schemas.BUSINESS)).select("business_id", "attributes_json")
    return stored.select(
        "*", json_lines.json_value("attributes_json", "$.brand", "string").alias("brand"),
        json_lines.json_value("attributes_json", "$.nested.size", "double").alias("size"),
        json_lines.json_value("attributes_json", "$.rates[1]", "double").alias("rate"))


@query
def table_row_counts(spark, sf_dir):
    """Build and store the whole star schema; one row per table with its row count."""
    root, staged = scratch(spark), scratch(spark)
    counts = build_star_schema(spark, samples.sources(spark, sf_dir, keeper(spark, staged)), root, score_col="score")
    remove(spark, root)
    remove(spark, staged)
    return row_counts(spark, counts)


@query
def dashboard_payload(spark, sf_dir):
    """All three dashboards as (result_set, position, row as JSON)."""
    root = scratch(spark)
    keep, buckets = keeper(spark, root), partitions(spark)
    m = Model(spark, sf_dir, keep)
    activity = write_placed(events.placed_daily_activity(m.review, m.checkin, m.tip, buckets, "score"), f"{root}/activity", "business_id", buckets)
    unknown = {key: keep(f"unknown_{key}", facts.unknown_keys(m.review, known, key))
               for key, known in (("user_id", m.dim_user), ("business_id", m.profile))}
    sets = dash.all_dashboards(
        operations=facts.operational_daily_fact(activity, rolled=True),
        days=dims.dim_date(events.review_checkin_dates(activity), "operations"),
        engagement=facts.engagement_rows_without(m.review, unknown["user_id"], unknown["business_id"]), monthly=facts.monthly_fact(activity),
        dim_business=dims.dim_business(m.business, events.business_review_stats(activity)),
        profile=m.profile, users=m.dim_user, keep=keep)
    order = {
        "manager.timeSeries": ["week_start_date"],
        "manager.sentimentBreakdown": ["review_count_group"],
        "manager.performanceByDay": ["day_of_week"],
        "marketing.avgStarsMonthly": ["year", "month"],
        "marketing.reviewsByState": [F.desc("review_count"), "state"],
        "marketing.topCategories": [F.desc("review_count"), "category_name"],
        "investor.trends": ["month_id"],
        "investor.byCategory": [F.desc("category_total_reviews"), "subcategory"],
    }
    named = {f"{d}.{name}": rounded(result) for d, results in sets.items() for name, result in results.items()}
    return payload(named, order)


# ---- projections ----


@query
def review_votes_projection(spark, sf_dir):
    return Model(spark, sf_dir).review.select(
        "review_id", F.col("useful").alias("useful_votes"), F.col("funny").alias("funny_votes"),
        F.col("cool").alias("cool_votes"),
    )


@query
def engagement_score(spark, sf_dir):
    return rounded(Model(spark, sf_dir).monthly_fact.select(
        "business_id", "month_id",
        measures.engagement_score("review_count", "tip_count", "photo_count", "checkin_count")
        .alias("engagement_score"),
    ))


@query
def compliment_total(spark, sf_dir):
    return Model(spark, sf_dir).user.select(
        "user_id", measures.null_safe_sum(schemas.COMPLIMENTS).alias("compliment_count")
    )


@query
def attributes_json(spark, sf_dir):
    business = Model(spark, sf_dir).business
    return business.select("business_id", dims.attributes_json(business).alias("attributes_json"))


@query
def subcategory(spark, sf_dir):
    return dims.business_subcategory(Model(spark, sf_dir).business)


@query
def rating_decimal(spark, sf_dir):
    stats = events.business_review_stats(Model(spark, sf_dir).activity("review"))
    return stats.select("business_id", F.col("overall_avg_rating").cast("decimal(3,1)").alias("rating"))


# ---- events ----


@query
def checkin_events(spark, sf_dir):
    return events.checkin_events(Model(spark, sf_dir).checkin)


@query
def activity_dates(spark, sf_dir):
    return events.activity_dates(Model(spark, sf_dir).all_activity)


@query
def activity_month_base(spark, sf_dir):
    return events.activity_month_base(Model(spark, sf_dir).all_activity)


@query
def business_review_stats(spark, sf_dir):
    return rounded(events.business_review_stats(Model(spark, sf_dir).activity("review")))


@query
def monthly_reviews(spark, sf_dir):
    return events.monthly_counts(Model(spark, sf_dir).activity("review"), "review_count")


@query
def monthly_checkins(spark, sf_dir):
    return events.monthly_counts(Model(spark, sf_dir).activity("checkin"), "checkin_count")


@query
def monthly_tips(spark, sf_dir):
    return events.monthly_counts(Model(spark, sf_dir).activity("tip"), "tip_count")


@query
def daily_reviews(spark, sf_dir):
    daily = facts.daily_rollup(Model(spark, sf_dir).activity("review"))
    return rounded(daily.select(
        "business_id", "date", "review_count", measures.mean("star_sum", "star_count").alias("average_stars")
    ))


@query
def daily_checkins(spark, sf_dir):
    return facts.daily_rollup(Model(spark, sf_dir).activity("checkin")).select(
        "business_id", "date", "checkin_count"
    )


@query
def tip_counts(spark, sf_dir):
    return events.tip_counts(Model(spark, sf_dir).tip)


@query
def checkin_counts(spark, sf_dir):
    return events.checkin_counts(Model(spark, sf_dir).checkin)


# ---- dimensions ----


@query
def dim_date_manager(spark, sf_dir):
    return dims.dim_date(events.activity_dates(Model(spark, sf_dir).all_activity), "manager")


@query
def dim_date_marketing(spark, sf_dir):
    return Model(spark, sf_dir).timestamp_days


@query
def dim_date_investor(spark, sf_dir):
    m = Model(spark, sf_dir)
    return dims.dim_date(events.review_checkin_dates(m.activity("review", "checkin")), "investor")


@query
def dim_location(spark, sf_dir):
    return dims.dim_location(Model(spark, sf_dir).business)


@query
def distinct_locations(spark, sf_dir):
    return dims.distinct_locations(Model(spark, sf_dir).business)


@query
def dim_location_keys(spark, sf_dir):
    return dims.dim_location_keys(Model(spark, sf_dir).business)


@query
def dim_category(spark, sf_dir):
    return dims.dim_category(Model(spark, sf_dir).business)


@query
def dim_category_keys(spark, sf_dir):
    return dims.dim_category_keys(Model(spark, sf_dir).business)


@query
def dim_business(spark, sf_dir):
    return Model(spark, sf_dir).dim_business


@query
def dim_business_location(spark, sf_dir):
    return Model(spark, sf_dir).dim_business_location


@query
def dim_business_profile(spark, sf_dir):
    profile = Model(spark, sf_dir).profile
    return profile.withColumn("categories", F.array_join("categories", "|"))


@query
def dim_user(spark, sf_dir):
    users = Model(spark, sf_dir).dim_user
    return rounded(users.withColumn("elite_years", F.array_join("elite_years", "|")))


@query
def dim_review(spark, sf_dir):
    return dims.dim_review(Model(spark, sf_dir).review)


# ---- bridges ----


@query
def category_bridge(spark, sf_dir):
    business = Model(spark, sf_dir).business
    return bridges.category_bridge(business, dims.dim_category(business))


@query
def category_bridge_keys(spark, sf_dir):
    m = Model(spark, sf_dir)
    return bridges.category_bridge_keys(
        m.business, dims.dim_category_keys(m.business), m.dim_business_location
    )


@query
def business_category_bridge(spark, sf_dir):
    return bridges.business_category_bridge(Model(spark, sf_dir).profile)


# ---- facts ----


@query
def monthly_fact(spark, sf_dir):
    return rounded(Model(spark, sf_dir).monthly_fact)


@query
def review_growth(spark, sf_dir):
    return rounded(Model(spark, sf_dir).monthly_fact.select("business_id", "month_id", "growth_rate"))


@query
def daily_fact(spark, sf_dir):
    m = Model(spark, sf_dir)
    activity = m.activity("review", "checkin")
    days = dims.dim_date(events.review_checkin_dates(activity), "investor")
    return rounded(facts.daily_fact(activity, m.dim_business_location, days))


@query
def operational_daily_fact(spark, sf_dir):
    return rounded(Model(spark, sf_dir).operations)


@query
def engagement_fact(spark, sf_dir):
    m = Model(spark, sf_dir)
    return facts.engagement_fact(m.review, m.tip, m.checkin, None, m.dim_user, m.profile)


@query
def engagement_fk_filter(spark, sf_dir):
    return Model(spark, sf_dir).engagement.select("review_id", "user_id", "business_id", "date_id")


def refreshed(spark, sf_dir, name: str) -> DataFrame:
    """A fact built from most events and refreshed with the rest: the last months, and a few days in the middle."""
    m = Model(spark, sf_dir, keeper(spark, scratch(spark)))
    root = scratch(spark)
    parts = {}
    for source in ("review", "checkin", "tip"):
        frame, day = getattr(m, source), F.substring("date", 1, 10)
        later = F.coalesce((day >= "1998-06-01") | day.between("1995-03-30", "1995-04-02"), F.lit(False))
        parts[source] = {"first": frame.where(~later), "later": frame.where(later)}
    refresh.build(spark, {"business": m.business, **{s: p["first"] for s, p in parts.items()}}, root, score_col="score")
    refresh.add_events(spark, root, m.business, **{s: p["later"] for s, p in parts.items()}, score_col="score")
    return rounded(refresh.read(Warehouse(spark, root), name))


@query
def refreshed_monthly_fact(spark, sf_dir):
    return refreshed(spark, sf_dir, refresh.MONTHLY)


@query
def refreshed_operational_fact(spark, sf_dir):
    return refreshed(spark, sf_dir, refresh.DAILY)


@query
def registered_business_keys(spark, sf_dir):
    """Business keys after a second build: businesses of the first keep theirs, new ones follow; one that is gone stays."""
    business = Model(spark, sf_dir).business.select("business_id")
    number = F.col("business_id").cast("int")
    path = scratch(spark)
    first = extend_keys(None, business.where(number % 10 != 0), "business_key", ["business_id"])
    write_table(first, path)
    return extend_keys(spark.read.parquet(path), business.where(number % 7 != 0), "business_key", ["business_id"])


@query
def distinct_businesses_by_quarter(spark, sf_dir):
    """Businesses with any event per quarter, from stored bitmaps of the months."""
    monthly = Model(spark, sf_dir).monthly_fact
    keys = dense_key(monthly.select("business_id").distinct().na.drop(), "business_key", ["business_id"])
    path = scratch(spark)
    write_table(distinct.monthly_bitmaps(monthly, keys), path)
    month = F.substring("month_id", 5, 2).cast("int")
    quarter = F.concat(F.substring("month_id", 1, 4), F.lit("Q"), F.ceil(month / 3).cast("string"))
    return distinct.distinct_by(spark.read.parquet(path), quarter)


@query
def streamed_daily_counts(spark, sf_dir):
    """Daily counts from a stream over three deliveries of the events, each with some late ones of the one before."""
    m = Model(spark, sf_dir)
    times = m.checkin.select("business_id", F.explode(F.split("date", ", ")).alias("time"))
    rows = daily_counts.event_rows(m.review, times)
    year, day = F.substring("time", 1, 4).cast("int"), F.substring("time", 6, 5)
    delivery = F.when(year < 1994, 0).when(year < 1997, 1).otherwise(2)
    # The last days of a delivery's period: every third event comes with the next one.
    late = year.isin(1993, 1996) & (day >= "12-20") & (F.pmod(F.xxhash64("business_id", "time", "event_id"), F.lit(3)) == 0)
    rows = rows.withColumn("delivery", delivery + late.cast("int"))
    root = scratch(spark)
    write_table(rows, f"{root}/all")
    stored = spark.read.schema(rows.schema).parquet(f"{root}/all")
    for n in range(3):
        stored.where(F.col("delivery") == n).drop("delivery").write.mode("append").option("compression", "zstd").parquet(f"{root}/events")
        daily_counts.run(daily_counts.read_events(spark, f"{root}/events"), f"{root}/days", f"{root}/checkpoint", "30 days")
    for done in ("all", "events", "checkpoint"):  # what follows reads the days alone
        remove(spark, f"{root}/{done}")
    counted = daily_counts.current(spark, f"{root}/days")
    return rounded(counted.select("business_id", "date", "review_count", measures.mean("star_sum", "star_count").alias("average_stars"),
                                  "checkin_count"))


# ---- operations dashboard ----


@query
def manager_kpis(spark, sf_dir):
    return rounded(dash.manager_kpis(Model(spark, sf_dir).operations))


@query
def kpis_one_business(spark, sf_dir):
    """The KPIs restricted to one business: the one with the most reviews."""
    operations = Model(spark, sf_dir).operations
    busiest = (
        operations.groupBy("business_id").agg(F.sum("daily_reviews").alias("n"))
        .orderBy(F.desc("n"), "business_id").limit(1).select("business_id").scalar()
    )
    return rounded(dash.manager_kpis(operations, busiest))


@query
def weekly_performance(spark, sf_dir):
    m = Model(spark, sf_dir)
    return rounded(dash.weekly_performance(m.operations, m.operations_days))


@query
def users_by_review_bucket(spark, sf_dir):
    return dash.users_by_review_bucket(Model(spark, sf_dir).dim_user)


@query
def performance_by_day(spark, sf_dir):
    m = Model(spark, sf_dir)
    return rounded(dash.performance_by_day(m.operations, m.operations_days))


# ---- marketing dashboard ----


@query
def avg_stars_monthly(spark, sf_dir):
    m = Model(spark, sf_dir)
    return rounded(dash.avg_stars_monthly(m.engagement))


@query
def vote_distribution(spark, sf_dir):
    return dash.vote_distribution(Model(spark, sf_dir).engagement)


@query
def top_states(spark, sf_dir):
    m = Model(spark, sf_dir)
    return dash.top_states(m.engagement, m.profile)


@query
def top_categories(spark, sf_dir):
    m = Model(spark, sf_dir)
    return dash.top_categories(m.engagement, m.profile)


@query
def user_stats(spark, sf_dir):
    return rounded(dash.user_stats(Model(spark, sf_dir).dim_user))


# ---- investor dashboard ----


@query
def investor_kpis(spark, sf_dir):
    return rounded(dash.investor_kpis(Model(spark, sf_dir).monthly_fact))


@query
def investor_trend(spark, sf_dir):
    return rounded(dash.investor_trend(Model(spark, sf_dir).monthly_fact))


@query
def top_subcategories(spark, sf_dir):
    m = Model(spark, sf_dir)
    return rounded(dash.top_subcategories(m.monthly_fact, m.dim_business))


# ---- on other layouts ----


@query
def top_subcategories_bucketed(spark, sf_dir):
    """From a fact and a dimension bucketed by business: grouped and joined without an exchange of the fact."""
    m = Model(spark, sf_dir)
    root, tag = scratch(spark), uuid.uuid4().hex[:8]
    monthly = write_bucketed(m.monthly_fact, f"monthly_{tag}", f"{root}/monthly", buckets=16)
    labels = write_bucketed(m.dim_business, f"business_{tag}", f"{root}/business", buckets=16)
    return rounded(dash.top_subcategories(monthly, labels))


@query
def days_of_a_winter(spark, sf_dir):
    """Daily totals around a turn of the year, from a fact stored by year."""
    m = Model(spark, sf_dir)
    root = scratch(spark)
    fact = write_by_year(m.operations, f"{root}/fact")
    write_table(m.operations_days, f"{root}/days")
    return rounded(dash.days_between(fact, spark.read.parquet(f"{root}/days"), "1995-12-01", "1996-02-29"))


# ---- the same in SQL ----


@query
def sql_kpis_one_business(spark, sf_dir):
    """The KPIs of the business with the most reviews, by a table function with a bound parameter."""
    operations = Model(spark, sf_dir).operations
    busiest = (operations.groupBy("business_id").agg(F.sum("daily_reviews").alias("n"))
               .orderBy(F.desc("n"), "business_id").first()["business_id"])
    sql_functions.register(spark, {"operations/Fact_Operational_Performance": operations})
    return rounded(spark.sql("select * from manager_kpis(business => :business)", args={"business": busiest}))


@query
def sql_top_categories(spark, sf_dir):
    m = Model(spark, sf_dir)
    sql_functions.register(spark, {"marketing/FactCustomerEngagement": m.engagement, "marketing/DimBusiness": m.profile})
    return spark.sql("select * from top_categories(k => 10)")


# ---- chart series ----


@query
def trend_series(spark, sf_dir):
    trend = dash.investor_trend(Model(spark, sf_dir).monthly_fact)
    return rounded(series.trend_series(trend, "monthly_avg_engagement_score"))


@query
def weekly_series(spark, sf_dir):
    """The weekly trend with its weeks given as dates, ISO texts and epoch seconds in turn."""
    m = Model(spark, sf_dir)
    weekly = dash.weekly_performance(m.operations, m.operations_days)
    week = F.col("week_start_date")
    form = F.dayofmonth(week) % 3
    mixed = (
        F.when(form == 0, week.cast("string"))
        .when(form == 1, F.concat(week.cast("string"), F.lit("T00:00:00Z")))
        .otherwise(F.unix_seconds(week.cast("timestamp")).cast("string"))
    )
    return series.weekly_series(weekly.withColumn("week", mixed), "week", "weekly_reviews")


@query
def stars_series(spark, sf_dir):
    m = Model(spark, sf_dir)
    return rounded(series.stars_series(dash.avg_stars_monthly(m.engagement)))


@query
def vote_distribution_long(spark, sf_dir):
    return series.vote_series(dash.vote_distribution(Model(spark, sf_dir).engagement))


@query
def user_bucket_share(spark, sf_dir):
    groups = dash.users_by_review_bucket(Model(spark, sf_dir).dim_user)
    return rounded(series.share_of_total(groups, "user_count"))
