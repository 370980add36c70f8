"""The twelve dashboard questions as SQL table functions with named parameters.

``register(spark, tables)`` makes views of the tables and temporary functions over them, so that
``select * from manager_kpis(business => 'b1')`` answers what ``dashboards.manager_kpis`` does. A parameter is a literal
by the time the plan is optimized: a missing business folds away, a given one reaches the scan as a plain filter. As in
the DataFrame form, facts are grouped before they meet a dimension, and averages come from exact sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.functions.measures import (
    CHECKIN_WEIGHT, EXACT, PHOTO_WEIGHT, REVIEW_BOUNDS, REVIEW_GROUPS, REVIEW_WEIGHT, TIP_WEIGHT,
)

VIEWS = {
    "operations": "operations/Fact_Operational_Performance", "days": "operations/Dim_Date", "users": "marketing/DimUser",
    "engagement": "marketing/FactCustomerEngagement", "profile": "marketing/DimBusiness",
    "monthly": "manager/Fact_Business_Performance", "labels": "manager/Dim_Business",
}


def mean(total: str, n: str) -> str:
    return f"case when {n} > 0 then cast({total} as double) / {n} end"


def exact_sum(column: str) -> str:
    return f"sum(try_cast({column} as {EXACT}))"


def exact_mean(column: str) -> str:
    return mean(exact_sum(column), f"count(try_cast({column} as {EXACT}))")


def _bucket() -> str:
    zero, *between, most = REVIEW_GROUPS
    cases = "".join(f" when review_count between {low} and {high} then '{g}'" for g, (low, high) in zip(between, REVIEW_BOUNDS))
    return f"case when review_count > {REVIEW_BOUNDS[-1][1]} then '{most}'{cases} else '{zero}' end"


ONE = "(business is null or business_id = business)"
BY_DAY = f"""
    select date, day_of_week, reviews, checkins, checkin_days, rating_sum, rating_days from (
        select date_id, sum(daily_reviews) as reviews, sum(daily_checkins) as checkins, count(daily_checkins) as checkin_days,
            {exact_sum('avg_daily_rating')} as rating_sum, count(try_cast(avg_daily_rating as {EXACT})) as rating_days
        from {{operations}} where {ONE} group by date_id) join {{days}} using (date_id)"""
MONTHS = """
    sum(review_count) as reviews, sum(checkin_count) as checkins, sum(tip_count) as tips, sum(photo_count) as photos,
    {growth} as growth, count(1) as months
    from {{monthly}} where engagement_score is not null and growth_rate is not null""".format(growth=exact_sum("growth_rate"))


def _measures(prefix: str) -> str:
    score = f"(reviews * {REVIEW_WEIGHT}D + tips * {TIP_WEIGHT}D + photos * {PHOTO_WEIGHT}D + checkins * {CHECKIN_WEIGHT}D)"
    return (f"reviews as {prefix}total_reviews, checkins as {prefix}total_checkins, tips as {prefix}total_tips, photos as {prefix}total_photos, "
            f"{mean(score, 'months')} as {prefix}avg_engagement_score, {mean('growth', 'months')} as {prefix}avg_growth_rate")


def _types(prefix: str) -> str:
    return (", ".join(f"{prefix}total_{w} bigint" for w in ("reviews", "checkins", "tips", "photos"))
            + f", {prefix}avg_engagement_score double, {prefix}avg_growth_rate double")


BUSINESS, TOP = "business string default null", "k int default 10"
#: name -> (parameters, columns, query)
FUNCTIONS = {
    "manager_kpis": (BUSINESS, "num_businesses bigint, total_reviews bigint, avg_rating double, total_checkins bigint, avg_sentiment double", f"""
        select count(distinct business_id), sum(daily_reviews), {exact_mean('avg_daily_rating')}, sum(daily_checkins),
            {exact_mean('sentiment_score_avg')} from {{operations}} where {ONE}"""),
    "weekly_performance": (BUSINESS, "week_start_date date, weekly_reviews bigint, avg_weekly_rating double", f"""
        select cast(date_trunc('week', date) as date), sum(reviews), {mean('sum(rating_sum)', 'sum(rating_days)')}
        from ({BY_DAY}) group by 1 order by 1"""),
    "users_by_review_bucket": ("", "review_count_group string, user_count bigint", f"""
        select review_count_group, user_count from (
            select {_bucket()} as review_count_group, count(user_id) as user_count from {{users}} where review_count is not null group by 1)
        order by array_position(array({', '.join(f"'{g}'" for g in REVIEW_GROUPS)}), review_count_group)"""),
    "performance_by_day": (BUSINESS, "day_of_week string, avg_checkins double, avg_rating double", f"""
        select day_of_week, avg_checkins, avg_rating from (
            select day_of_week, weekday(date) as n, {mean('sum(checkins)', 'sum(checkin_days)')} as avg_checkins,
                {mean('sum(rating_sum)', 'sum(rating_days)')} as avg_rating from ({BY_DAY}) group by 1, 2) order by n"""),
    "avg_stars_monthly": ("", "year int, month int, average_stars double", f"""
        select cast(date_id div 10000 as int), cast(date_id div 100 % 100 as int), {mean('sum(stars)', 'sum(n)')}
        from (select date_id, sum(stars) as stars, count(stars) as n from {{engagement}} group by date_id) group by 1, 2 order by 1, 2"""),
    "vote_distribution": ("", "total_useful bigint, total_funny bigint, total_cool bigint",
                          "select sum(useful_votes), sum(funny_votes), sum(cool_votes) from {engagement}"),
    "top_states": (TOP, "state string, review_count bigint", """
        select state, n from (select state, n, row_number() over (order by n desc, state) as place from (
            select state, sum(n) as n from (select business_id, count(review_id) as n from {engagement} group by business_id)
            join {profile} using (business_id) where state is not null group by state)) where place <= k order by place"""),
    "top_categories": (TOP, "category_name string, review_count bigint", """
        with owners as (
            select review_id, min(business_id) as first, max(business_id) as last from {engagement}
            where review_id is not null and business_id is not null group by review_id
        ), listed as (
            select distinct business_id, category_name from {profile} lateral view explode(categories) as category_name
            where business_id is not null and category_name <> ''
        ), counted as (
            select category_name, sum(n) as n from (select first as business_id, count(1) as n from owners where first = last group by first)
            join listed using (business_id) group by category_name
            union all
            select category_name, count(distinct review_id) from (
                select review_id, business_id from {engagement} left semi join (select review_id from owners where first < last) using (review_id))
            join listed using (business_id) group by category_name
        )
        select category_name, n from (select *, row_number() over (order by n desc, category_name) as place from (
            select category_name, sum(n) as n from counted group by category_name)) where place <= k order by place"""),
    "user_stats": ("", "overall_avg_user_rating double, total_fans bigint, total_compliments bigint, total_users bigint",
                   f"select {exact_mean('average_stars')}, sum(fans), sum(compliment_count), count(user_id) from {{users}}"),
    "investor_kpis": ("", "total_businesses bigint, total_reviews bigint, total_checkins bigint, total_tips bigint, total_photos bigint, "
                      "avg_engagement_score double, avg_growth_rate double", f"""
        select businesses, {_measures('')} from (
            select count(business_id) as businesses, sum(reviews) as reviews, sum(checkins) as checkins, sum(tips) as tips,
                sum(photos) as photos, sum(growth) as growth, sum(months) as months
            from (select business_id, {MONTHS} group by business_id))"""),
    "investor_trend": ("", f"month_id string, {_types('monthly_')}", f"""
        select month_id, {_measures('monthly_')} from (select month_id, {MONTHS} group by month_id) order by month_id"""),
    "top_subcategories": (TOP, f"subcategory string, {_types('category_')}", f"""
        select subcategory, {_measures('category_')} from (select *, row_number() over (order by reviews desc, subcategory) as place from (
            select subcategory, sum(reviews) as reviews, sum(checkins) as checkins, sum(tips) as tips, sum(photos) as photos,
                sum(growth) as growth, sum(months) as months
            from (select business_id, {MONTHS} group by business_id) join {{labels}} using (business_id)
            where subcategory is not null group by subcategory)) where place <= k order by place"""),
}


def register(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "starmart_") -> list[str]:
    """Create the functions whose tables (by the names of ``schemas.STAR_TABLES``) are given; their names."""
    views = {short: f"{prefix}{short}" for short, name in VIEWS.items() if name in tables}
    for short, view in views.items():
        tables[VIEWS[short]].createOrReplaceTempView(view)
    made = []
    for name, (parameters, columns, query) in FUNCTIONS.items():
        if all(f"{{{short}}}" not in query for short in VIEWS if short not in views):
            for short, view in views.items():
                query = query.replace(f"{{{short}}}", view)
            spark.sql(f"create or replace temporary function {name}({parameters}) returns table({columns}) return {query}")
            made.append(name)
    return made
