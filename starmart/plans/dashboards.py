"""The twelve dashboard queries.

Facts are pre-aggregated on their own key before they meet a dimension: the
joins then see one row per day or per business instead of one per event.
Averages of doubles are made from exact sums, so a result is the same for any
order and partitioning of its rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.dates import week_start
from starmart.functions.measures import engagement_score, exact, exact_mean, mean, review_group, review_group_rank
from starmart.operators.skew import lookup_join

TOP_K = 10

# ---- operations dashboard ----


def for_business(fact: DataFrame, business_id: str | Column | None) -> DataFrame:
    return fact if business_id is None else fact.filter(F.col("business_id") == business_id)


def manager_kpis(operations: DataFrame, business_id: str | Column | None = None) -> DataFrame:
    """Headline numbers. ``avg_rating`` averages daily averages, unweighted."""
    return for_business(operations, business_id).agg(
        F.count_distinct("business_id").alias("num_businesses"),
        F.sum("daily_reviews").alias("total_reviews"),
        exact_mean("avg_daily_rating").alias("avg_rating"),
        F.sum("daily_checkins").alias("total_checkins"),
        exact_mean("sentiment_score_avg").alias("avg_sentiment"),
    )


def _by_day(operations: DataFrame, dim_date: DataFrame, business_id: str | Column | None) -> DataFrame:
    """Totals per calendar day with the day's attributes."""
    daily = for_business(operations, business_id).groupBy("date_id").agg(*_operations_measures())
    return daily.join(F.broadcast(dim_date), "date_id")  # at most one row per calendar day


def _operations_measures() -> list[Column]:
    return [
        F.sum("daily_reviews").alias("reviews"),
        F.sum("daily_checkins").alias("checkins"),
        F.count("daily_checkins").alias("checkin_days"),
        F.sum(exact("avg_daily_rating")).alias("rating_sum"),
        F.count(exact("avg_daily_rating")).alias("rating_days"),
    ]


def days_between(operations: DataFrame, dim_date: DataFrame, first: str, last: str) -> DataFrame:
    """Totals per calendar day from ``first`` to ``last`` (ISO dates), for facts stored by year.

    The calendar is joined on the year as well, so that a fact in folders by year is read for the years that hold such days.
    """
    days = dim_date.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).withColumn("year", F.year("date"))
    daily = operations.join(F.broadcast(days.select("date_id", "year", "date")), ["date_id", "year"])  # a row per calendar day
    return daily.groupBy("date").agg(
        F.sum("daily_reviews").alias("reviews"), F.sum("daily_checkins").alias("checkins"),
        exact_mean("avg_daily_rating").alias("avg_rating")).orderBy("date")


def weekly_performance(
    operations: DataFrame, dim_date: DataFrame, business_id: str | Column | None = None
) -> DataFrame:
    return _weekly(_by_day(operations, dim_date, business_id))


def _weekly(by_day: DataFrame) -> DataFrame:
    return (
        by_day.groupBy(week_start("date").alias("week_start_date"))
        .agg(
            F.sum("reviews").alias("weekly_reviews"),
            mean(F.sum("rating_sum"), F.sum("rating_days")).alias("avg_weekly_rating"),
        )
        .orderBy("week_start_date")
    )


def performance_by_day(
    operations: DataFrame, dim_date: DataFrame, business_id: str | Column | None = None
) -> DataFrame:
    """Averages per weekday, Monday first."""
    return _weekdays(_by_day(operations, dim_date, business_id))


def _weekdays(by_day: DataFrame) -> DataFrame:
    return (
        by_day.groupBy("day_of_week", F.weekday("date").alias("weekday"))
        .agg(
            mean(F.sum("checkins"), F.sum("checkin_days")).alias("avg_checkins"),
            mean(F.sum("rating_sum"), F.sum("rating_days")).alias("avg_rating"),
        )
        .orderBy("weekday")
        .drop("weekday")
    )


def users_by_review_bucket(dim_user: DataFrame) -> DataFrame:
    """Users per review-count group, in group order."""
    return (
        dim_user.filter(F.col("review_count").isNotNull())
        .groupBy(review_group("review_count").alias("review_count_group"))
        .agg(F.count("user_id").alias("user_count"))
        .orderBy(review_group_rank("review_count_group"))
    )


# ---- marketing dashboard ----


def avg_stars_monthly(engagement: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Average stars per calendar month. Without a calendar the months are read off the day keys (yyyyMMdd)."""
    return _stars_by_month(engagement.groupBy("date_id").agg(F.sum("stars").alias("stars"), F.count("stars").alias("n")), dim_date)


def _stars_by_month(daily: DataFrame, dim_date: DataFrame | None) -> DataFrame:
    if dim_date is None:
        day = F.col("date_id").cast("int")
        dated = daily.withColumns({"year": F.floor(day / 10000).cast("int"), "month": (F.floor(day / 100) % 100).cast("int")})
    else:
        days = dim_date.select("date_id", F.year("full_date").alias("year"), F.month("full_date").alias("month")).distinct()
        dated = daily.join(F.broadcast(days), "date_id")  # at most one row per calendar day
    return (
        dated.groupBy("year", "month")
        .agg(mean(F.sum("stars"), F.sum("n")).alias("average_stars"))
        .orderBy("year", "month")
    )


def vote_distribution(engagement: DataFrame) -> DataFrame:
    return engagement.agg(
        F.sum("useful_votes").alias("total_useful"),
        F.sum("funny_votes").alias("total_funny"),
        F.sum("cool_votes").alias("total_cool"),
    )


def top_states(engagement: DataFrame, profile: DataFrame, k: int = TOP_K) -> DataFrame:
    """States with the most reviews; ties by name."""
    return _states(engagement.groupBy("business_id").agg(F.count("review_id").alias("n")), profile, k)


def _states(per_business: DataFrame, profile: DataFrame, k: int) -> DataFrame:
    states = profile.select("business_id", "state").filter(F.col("state").isNotNull())
    return (
        per_business.join(states, "business_id")
        .groupBy("state").agg(F.sum("n").alias("review_count"))
        .orderBy(F.desc("review_count"), "state").limit(k)
    )


def top_categories(engagement: DataFrame, profile: DataFrame, k: int = TOP_K) -> DataFrame:
    """Categories with the most distinct reviews; ties by name.

    Nearly every review id belongs to one business; its reviews are counted per business, and only the counts meet the
    categories. The least and the greatest business of an id tell which ids belong to several; their pairs alone are
    expanded to categories and counted distinct, so that part costs what the true share of such ids costs.
    """
    pairs = engagement.select("review_id", "business_id").filter("review_id is not null and business_id is not null")
    # Combined on the map side, so an id with many rows is never hot.
    owners = pairs.groupBy("review_id").agg(F.min("business_id").alias("first"), F.max("business_id").alias("last"))
    shared = pairs.join(owners.filter("first < last").select("review_id"), "review_id", "left_semi").distinct()
    per_business = owners.filter("first = last").groupBy(F.col("first").alias("business_id")).agg(F.count(F.lit(1)).alias("n"))
    return _categories(per_business, shared, profile, k)


def _categories(per_business: DataFrame, shared: DataFrame | None, profile: DataFrame, k: int) -> DataFrame:
    """From each business's number of review ids that are its alone, and the pairs of the ids that have several."""
    bridge = (
        profile.select("business_id", F.explode("categories").alias("category_name"))
        .filter("business_id is not null and category_name != ''").distinct()
    )
    counted = per_business.join(bridge, "business_id").groupBy("category_name").agg(F.sum("n").alias("n"))

    if shared is not None:
        counted = counted.unionByName(
            lookup_join(shared, bridge, ["business_id"], "inner")
            .groupBy("category_name").agg(F.count_distinct("review_id").alias("n"))
        )
    return (
        counted.groupBy("category_name").agg(F.sum("n").alias("review_count"))
        .orderBy(F.desc("review_count"), "category_name").limit(k)
    )


def user_stats(dim_user: DataFrame) -> DataFrame:
    return dim_user.agg(
        exact_mean("average_stars").alias("overall_avg_user_rating"),
        F.sum("fans").alias("total_fans"),
        F.sum("compliment_count").alias("total_compliments"),
        F.count("user_id").alias("total_users"),
    )


# ---- investor dashboard ----


def measurable(monthly: DataFrame) -> DataFrame:
    """Months with a growth rate.

    First months and months after one without reviews have none, so they are
    missing from the totals below as well as from the averages.
    """
    return monthly.na.drop(subset=["engagement_score", "growth_rate"])


COUNTS = ["review_count", "checkin_count", "tip_count", "photo_count"]


def _totals(monthly: DataFrame, *keys: str) -> DataFrame:
    """Sums of the measurable months by ``keys``."""
    return measurable(monthly).groupBy(*keys).agg(*_monthly_measures())


def _monthly_measures() -> list[Column]:
    return [
        *[F.sum(c).alias(c) for c in COUNTS],
        F.sum(exact("growth_rate")).alias("growth_sum"),
        F.count(F.lit(1)).alias("months"),
    ]


def _average_engagement() -> Column:
    """Average engagement score of the summed months.

    The score is linear in the counts, so it is the score of the summed
    counts over the number of months: whole-number sums, the same in any order.
    """
    return mean(engagement_score("review_count", "tip_count", "photo_count", "checkin_count"), "months")


def _performance(prefix: str) -> list[Column]:
    return [
        *[F.col(f"{what}_count").alias(f"{prefix}_total_{what}s") for what in ("review", "checkin", "tip", "photo")],
        _average_engagement().alias(f"{prefix}_avg_engagement_score"),
        mean("growth_sum", "months").alias(f"{prefix}_avg_growth_rate"),
    ]


def investor_kpis(monthly: DataFrame) -> DataFrame:
    return _investor_kpis(_totals(monthly, "business_id"))


def _investor_kpis(per_business: DataFrame) -> DataFrame:
    # The businesses are counted as the groups of a per-business total.
    totals = per_business.agg(
        F.count("business_id").alias("total_businesses"),
        *[F.sum(c).alias(c) for c in [*COUNTS, "growth_sum", "months"]],
    )
    return totals.select(
        "total_businesses",
        *[F.col(f"{what}_count").alias(f"total_{what}s") for what in ("review", "checkin", "tip", "photo")],
        _average_engagement().alias("avg_engagement_score"),
        mean("growth_sum", "months").alias("avg_growth_rate"),
    )


def investor_trend(monthly: DataFrame) -> DataFrame:
    return _trend(_totals(monthly, "month_id"))


def _trend(per_month: DataFrame) -> DataFrame:
    return per_month.select("month_id", *_performance("monthly")).orderBy("month_id")


def top_subcategories(monthly: DataFrame, dim_business: DataFrame, k: int = TOP_K) -> DataFrame:
    """Subcategories with the most reviews; ties by name."""
    return _subcategories(_totals(monthly, "business_id"), dim_business, k)


def _subcategories(per_business: DataFrame, dim_business: DataFrame, k: int) -> DataFrame:
    labels = dim_business.select("business_id", "subcategory").filter(F.col("subcategory").isNotNull())
    totals = (
        per_business.join(labels, "business_id")
        .groupBy("subcategory")
        .agg(*[F.sum(c).alias(c) for c in [*COUNTS, "growth_sum", "months"]])
    )
    return (
        totals.select("subcategory", *_performance("category"))
        .orderBy(F.desc("category_total_reviews"), "subcategory").limit(k)
    )


# ---- bundles: the named result sets of each dashboard ----


def manager_dashboard(operations, dim_date, dim_user, business_id=None) -> dict[str, DataFrame]:
    return {
        "kpis": manager_kpis(operations, business_id),
        "timeSeries": weekly_performance(operations, dim_date, business_id),
        "sentimentBreakdown": users_by_review_bucket(dim_user),
        "performanceByDay": performance_by_day(operations, dim_date, business_id),
    }


def marketing_dashboard(engagement, dim_date, profile, dim_user) -> dict[str, DataFrame]:
    return {
        "avgStarsMonthly": avg_stars_monthly(engagement, dim_date),
        "voteDistribution": vote_distribution(engagement),
        "reviewsByState": top_states(engagement, profile),
        "topCategories": top_categories(engagement, profile),
        "userStats": user_stats(dim_user),
    }


def investor_dashboard(monthly, dim_business) -> dict[str, DataFrame]:
    return {
        "kpis": investor_kpis(monthly),
        "trends": investor_trend(monthly),
        "byCategory": top_subcategories(monthly, dim_business),
    }


# ---- all dashboards at once: one aggregate per table ----


def totals_by(table: DataFrame, keys: list[str], measures: list[Column]) -> DataFrame:
    """The measures by each key alone, from one pass: column ``of`` names the key of a row, the other keys are null."""
    alone = (1 << len(keys)) - 1
    sets = table.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("__set"), *measures)
    of = F.when(F.lit(False), "")
    for place, key in enumerate(keys):
        of = of.when(F.col("__set") == alone - (1 << (len(keys) - 1 - place)), key)
    return sets.withColumn("of", of).drop("__set")


def all_dashboards(
    operations: DataFrame, days: DataFrame, engagement: DataFrame, monthly: DataFrame, dim_business: DataFrame,
    profile: DataFrame, users: DataFrame, keep, k: int = TOP_K,
) -> dict[str, dict[str, DataFrame]]:
    """The result sets of the three dashboards, each fact read once, reviews once more for their ids.

    Every fact goes through one aggregate with grouping sets whose rows are routed to the result sets by their set;
    result sets that need more are rollups of those. ``keep(name, frame)`` stores a frame and returns it as stored.
    Review ids, nearly as many as reviews, are grouped apart with their businesses alone, and stored only if they have
    several. These are the one reason to read reviews a third time, and only if there are any.
    """
    pairs = engagement.select("review_id", "business_id").filter("review_id is not null and business_id is not null")
    # Combined on the map side, so an id with many rows is never hot.
    owners = pairs.groupBy("review_id").agg(F.min("business_id").alias("first"), F.max("business_id").alias("last"))
    alone = F.col("first") == F.col("last")
    steps = {
        "operations": lambda: totals_by(operations, ["business_id", "date_id"], [
            *_operations_measures(), F.sum(exact("sentiment_score_avg")).alias("sentiment_sum"),
            F.count(exact("sentiment_score_avg")).alias("sentiment_days")]),
        "engagement": lambda: totals_by(engagement, ["date_id", "business_id"], [
            F.sum("stars").alias("stars"), F.count("stars").alias("rated"), F.count("review_id").alias("n"),
            *[F.sum(f"{v}_votes").alias(v) for v in ("useful", "funny", "cool")]]),
        "owners": lambda: owners.groupBy(F.when(alone, F.col("first")).alias("business_id"), F.when(~alone, F.col("review_id")).alias("review_id"))
                                .agg(F.count(F.lit(1)).alias("n")),
        "monthly": lambda: totals_by(measurable(monthly), ["business_id", "month_id"], _monthly_measures()),
        "users": lambda: users.groupBy(F.when(F.col("review_count").isNotNull(), review_group("review_count")).alias("review_count_group")).agg(
            F.count("user_id").alias("user_count"), F.sum(exact("average_stars")).alias("stars"),
            F.count(exact("average_stars")).alias("rated"), F.sum("fans").alias("fans"), F.sum("compliment_count").alias("compliments")),
        "labels": lambda: dim_business.select("business_id", "subcategory"),
        "profile": lambda: profile.select("business_id", "state", "categories"),
    }
    with ThreadPoolExecutor(len(steps)) as pool:  # independent jobs, submitted together
        stored = dict(zip(steps, pool.map(lambda name: keep(name, steps[name]()), steps)))

    def of(table: str, key: str) -> DataFrame:
        return stored[table].where(F.col("of") == key)

    by_day = of("operations", "date_id").drop("business_id").join(F.broadcast(days), "date_id")
    per_day, per_business = of("engagement", "date_id"), of("monthly", "business_id")
    several = stored["owners"].where("review_id is not null").select("review_id")
    shared = None if several.isEmpty() else pairs.join(several, "review_id", "left_semi").distinct()
    groups = stored["users"]
    return {
        "manager": {
            "kpis": of("operations", "business_id").agg(
                F.count("business_id").alias("num_businesses"), F.sum("reviews").alias("total_reviews"),
                mean(F.sum("rating_sum"), F.sum("rating_days")).alias("avg_rating"), F.sum("checkins").alias("total_checkins"),
                mean(F.sum("sentiment_sum"), F.sum("sentiment_days")).alias("avg_sentiment")),
            "timeSeries": _weekly(by_day),
            "sentimentBreakdown": groups.where("review_count_group is not null").select("review_count_group", "user_count")
                                        .orderBy(review_group_rank("review_count_group")),
            "performanceByDay": _weekdays(by_day),
        },
        "marketing": {
            "avgStarsMonthly": _stars_by_month(per_day.select("date_id", "stars", F.col("rated").alias("n")), None),
            "voteDistribution": per_day.agg(*[F.sum(v).alias(f"total_{v}") for v in ("useful", "funny", "cool")]),
            "reviewsByState": _states(of("engagement", "business_id").select("business_id", "n"), stored["profile"], k),
            "topCategories": _categories(stored["owners"].where("business_id is not null").select("business_id", "n"), shared, stored["profile"], k),
            "userStats": groups.agg(
                mean(F.sum("stars"), F.sum("rated")).alias("overall_avg_user_rating"), F.sum("fans").alias("total_fans"),
                F.sum("compliments").alias("total_compliments"), F.coalesce(F.sum("user_count"), F.lit(0)).alias("total_users")),
        },
        "investor": {
            "kpis": _investor_kpis(per_business),
            "trends": _trend(of("monthly", "month_id")),
            "byCategory": _subcategories(per_business, stored["labels"], k),
        },
    }
