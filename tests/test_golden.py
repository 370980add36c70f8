"""Hand-computed results on a few awkward rows: bad dates, missing values, repeated keys."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import dates as D
from starmart.operators import bridges, dimensions as dims, events, facts, series
from starmart.plans import dashboards as dash


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def business(spark):
    rows = [
        ("b1", "Food, Bars,Nightlife", 1, "C", 1.0),
        ("b2", "Food", 0, "C", None),
        ("b3", None, 1, "C", None),
        ("b4", "", 1, "D", 2.0),
        ("b5", "Food, , null", None, "C", 1.0),
    ]
    frame = spark.createDataFrame(
        rows, "business_id string, categories string, is_open int, city string, latitude double"
    )
    return frame.select(
        "business_id", F.lit("n").alias("name"), F.lit("a").alias("address"), "city", F.lit("S").alias("state"),
        F.lit("1").alias("postal_code"), "latitude", F.lit(0.0).alias("longitude"), F.lit(1.0).alias("stars"),
        F.lit(1).cast("bigint").alias("review_count"), "is_open",
        F.lit(None).cast("string").alias("attributes"), "categories",
    )


@pytest.fixture(scope="module")
def review(spark):
    rows = [
        ("r1", "u1", "b1", 5.0, "2020-01-15 10:00:00"),
        ("r2", "u1", "b1", 4.0, "2020-01-20 10:00:00"),
        ("r3", "u2", "b1", 3.0, "2020-03-02 10:00:00"),
        ("r4", "u1", "b2", 2.0, "bad"),
    ]
    frame = spark.createDataFrame(
        rows, "review_id string, user_id string, business_id string, stars double, date string"
    )
    zero = F.lit(0).cast("bigint")
    return frame.withColumns({"useful": zero, "funny": zero, "cool": zero, "text": F.lit("t")})


@pytest.fixture(scope="module")
def tip(spark):
    return spark.createDataFrame(
        [("u1", "b1", "2020-01-16 09:00:00"), ("u1", "b1", "2020-02-01 09:00:00")],
        "user_id string, business_id string, date string",
    )


@pytest.fixture(scope="module")
def checkin(spark):
    return spark.createDataFrame(
        [("b1", "2020-01-15 10:00:00, 2020-02-03 11:00:00, 2020-02-04 12:00:00"), ("b2", None)],
        "business_id string, date string",
    )


@pytest.fixture(scope="module")
def activity(review, checkin, tip):
    return events.activity_rows(review, checkin, tip)


@pytest.fixture(scope="module")
def user(spark):
    compliments = ", ".join(f"cast(null as bigint) as {c}" for c in schemas.COMPLIMENTS[1:])
    return spark.sql(f"""
        select user_id, 'n' as name, '2010-01-15 08:30:00' as yelping_since, n as review_count,
               4.0d as average_stars, 1L as fans, '' as elite, 3L as compliment_cool, {compliments}
        from values ('u1', 0L), ('u2', -1L), ('u3', 5L), ('u4', 6L), ('u5', 51L), ('u6', null) as t(user_id, n)""")


def rows(frame, *columns):
    found = [tuple(row) for row in frame.select(*columns or frame.columns).collect()]
    return sorted(found, key=lambda row: [str(v) for v in row])


def test_category_lists(business):
    profile = {r.business_id: r.categories for r in dims.dim_business_profile(business).collect()}
    assert profile == {
        "b1": ["Food", "Bars", "Nightlife"], "b2": ["Food"], "b3": None, "b4": [""], "b5": ["Food", "", "null"],
    }


def test_bridges(business):
    dim = dims.dim_category(business)
    named = bridges.category_bridge(business, dim).join(dim, "category_id")
    manager = [("b1", "Bars"), ("b1", "Food"), ("b1", "Nightlife"), ("b2", "Food"), ("b5", "Food")]
    assert rows(named, "business_id", "category_name") == manager
    marketing = bridges.business_category_bridge(dims.dim_business_profile(business))
    assert rows(marketing) == [*manager, ("b5", "null")]


def test_investor_categories_split_on_comma_and_space(business):
    dim = dims.dim_category_keys(business)
    assert {r.category_name for r in dim.collect()} == {"Food", "Bars,Nightlife", "null"}
    assert sorted(r.category_key for r in dim.collect()) == [1, 2, 3]


def test_subcategory(business):
    found = {r.business_id: r.subcategory for r in dims.business_subcategory(business).collect()}
    assert found == {"b1": "Bars", "b2": None, "b3": None, "b4": None, "b5": None}


def test_monthly_fact(activity):
    fact = facts.monthly_fact(activity)
    assert rows(
        fact, "business_id", "month_id", "review_count", "checkin_count", "tip_count",
        F.round("engagement_score", 6), "growth_rate",
    ) == [
        ("b1", "202001", 2, 1, 1, 2.7, None),
        ("b1", "202002", 0, 2, 1, 0.9, -1.0),
        ("b1", "202003", 1, 0, 0, 1.0, None),
    ]


def test_rejected_dates(activity):
    assert dict(rows(events.rejected_dates(activity))) == {"review": 1, "checkin": 0, "tip": 0}


def test_investor_kpis(activity):
    row = dash.investor_kpis(facts.monthly_fact(activity)).first()
    assert (row.total_businesses, row.total_reviews, row.total_checkins, row.total_tips, row.total_photos) == (
        1, 0, 2, 1, 0,
    )
    assert row.avg_engagement_score == pytest.approx(0.9)
    assert row.avg_growth_rate == -1.0


def test_engagement_fact(spark, business, review, tip, checkin, user):
    days = dims.dim_date(events.timestamp_dates(review, checkin, tip), "marketing")
    fact = facts.engagement_fact(
        review, tip, checkin, days, dims.dim_user(user), dims.dim_business_profile(business)
    )
    assert rows(fact, "review_id", "date_id", "tip_count", "checkin_count") == [
        ("r1", 20200115, 2, 3), ("r2", 20200120, 2, 3), ("r3", 20200302, 0, 3),
    ]


def test_checkin_counts(checkin):
    assert dict(rows(events.checkin_counts(checkin))) == {"b1": 3, "b2": None}


def test_daily_fact(activity, business):
    located = dims.dim_business_location(business, dims.dim_location_keys(business))
    days = dims.dim_date(events.review_checkin_dates(activity), "investor")
    fact = facts.daily_fact(activity, located, days)
    b1 = located.filter("business_nk = 'b1'").first().business_key
    assert [tuple(r) for r in fact.orderBy("performance_key").collect()] == [
        (1, b1, 20200115, 1, 5.0, 1), (2, b1, 20200120, 1, 4.0, 0), (3, b1, 20200203, 0, 0.0, 1),
        (4, b1, 20200204, 0, 0.0, 1), (5, b1, 20200302, 1, 3.0, 0),
    ]


def test_operational_daily_fact(activity):
    fact = facts.operational_daily_fact(activity)
    ratings = {r.date_id: r.avg_daily_rating for r in fact.collect()}
    assert ratings == {"20200115": 5.0, "20200120": 4.0, "20200203": None, "20200204": None, "20200302": 3.0}
    filled = facts.operational_daily_fact(activity, missing_rating=0.0)
    assert {r.date_id for r in filled.filter("avg_daily_rating = 0").collect()} == {"20200203", "20200204"}


def test_weekly_performance(activity):
    days = dims.dim_date(events.review_checkin_dates(activity), "operations")
    weekly = dash.weekly_performance(facts.operational_daily_fact(activity), days)
    assert [r.week_start_date for r in weekly.collect()] == [
        day("2020-01-13"), day("2020-01-20"), day("2020-02-03"), day("2020-03-02"),
    ]


def test_dashboards_for_one_business(activity):
    operations = facts.operational_daily_fact(activity)
    assert dash.manager_kpis(operations, "b1").first().total_reviews == 3
    nobody = dash.manager_kpis(operations, "none").first()
    assert (nobody.num_businesses, nobody.total_reviews) == (0, None)


def test_dim_business(business, activity):
    dim = dims.dim_business(business, events.business_review_stats(activity))
    assert rows(dim, "business_id", "is_open", "overall_avg_rating", "overall_review_count") == [
        ("b1", True, Decimal("4.0"), 3), ("b2", False, Decimal("2.0"), 1), ("b3", True, None, 0),
        ("b4", True, None, 0), ("b5", None, None, 0),
    ]


def test_every_business_has_a_location(business):
    places = dims.dim_location_keys(business)
    assert places.count() == 3
    located = dims.dim_business_location(business, places)
    key = {(r.city, r.latitude): r.location_key for r in places.collect()}
    assert {r.business_nk: r.location_key for r in located.collect()} == {
        "b1": key["C", 1.0], "b5": key["C", 1.0], "b2": key["C", None], "b3": key["C", None], "b4": key["D", 2.0],
    }


def test_date_profiles(activity):
    saturday = activity.sparkSession.sql("select date '2020-02-01' as date")
    assert rows(dims.dim_date(saturday, "manager")) == [("20200201", day("2020-02-01"), 2, 2020, 1, True)]
    assert rows(dims.dim_date(saturday, "marketing")) == [
        (20200201, day("2020-02-01"), 1, 2, 1, 2020, "Saturday")]
    assert rows(dims.dim_date(saturday, "investor")) == [
        (20200201, day("2020-02-01"), 2020, 2, 1, 5, "Saturday", "February", 1, True)]
    # tips are events for the manager calendar only
    assert events.activity_dates(activity).filter("date = '2020-01-16'").count() == 1
    assert events.review_checkin_dates(activity).filter("date = '2020-01-16'").count() == 0
    with pytest.raises(ValueError):
        dims.dim_date(saturday, "other")


def test_users(user):
    groups = dash.users_by_review_bucket(dims.dim_user(user))
    assert [tuple(r) for r in groups.collect()] == [
        ("0 reviews", 2), ("1-5 reviews", 1), ("6-20 reviews", 1), ("51+ reviews", 1)]
    assert {r.compliment_count for r in dims.dim_user(user).collect()} == {3}
    shares = series.share_of_total(groups, "user_count")
    assert sum(r.share for r in shares.collect()) == pytest.approx(1.0)


def test_trend_series(spark):
    trend = spark.createDataFrame(
        [("202001", "1.5"), ("abc", "2"), ("000000", "3"), ("202002", "x"), ("202003", "NaN"), ("202004", None)],
        "month_id string, v string",
    )
    assert rows(series.trend_series(trend, "v")) == [(day("2020-01-01"), 1.5)]


def test_weekly_series(spark):
    weekly = spark.createDataFrame(
        [("2020-01-06", 1), ("2020-01-13T00:00:00Z", 2), ("1579478400", 3), ("86400", 6), ("n/a", 4), (None, 5)],
        "week string, n int",
    )
    assert rows(series.weekly_series(weekly, "week", "n")) == [
        (day("1970-01-02"), 6), (day("2020-01-06"), 1), (day("2020-01-13"), 2), (day("2020-01-20"), 3)]


def test_label_series(spark):
    states = spark.createDataFrame([("S", 2)], "state string, review_count bigint")
    assert rows(series.label_series(states, "state", "review_count")) == [("S", 2)]


def test_parsing(spark):
    texts = ["2020-01-15 10:00:00", "  2020-1-7 9:00:00 ", "bad", "", "2020-02-30 10:00:00", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = [r[0] for r in frame.select(D.parse_timestamp("t")).collect()]
    assert parsed == [dt.datetime(2020, 1, 15, 10), dt.datetime(2020, 1, 7, 9), None, None, None, None]
    dates = [r[0] for r in frame.select(D.parse_date("t")).collect()]
    assert dates == [day("2020-01-15"), day("2020-01-07"), None, None, None, None]


def test_attributes_struct_and_text(spark):
    structs = spark.sql("select 'b' as business_id, named_struct('x', 1, 'y', cast(null as int)) as attributes")
    assert structs.select(dims.attributes_json(structs)).first()[0] == '{"x":1}'
    texts = spark.sql("""select 'b' as business_id, '{"x": 1}' as attributes""")
    assert texts.select(dims.attributes_json(texts)).first()[0] == '{"x": 1}'


def test_top_results_break_ties_by_name(spark):
    profile = spark.createDataFrame(
        [("b1", "B", ["y", "x"]), ("b2", "A", ["x"]), ("b3", None, None)],
        "business_id string, state string, categories array<string>",
    )
    engagement = spark.createDataFrame(
        [("r1", "b1"), ("r2", "b2"), ("r3", "b3"), ("r1", "b2"), ("r2", "b2")],
        "review_id string, business_id string",
    )
    assert [tuple(r) for r in dash.top_states(engagement, profile).collect()] == [("A", 3), ("B", 1)]
    # r1 is listed under two businesses and counts once per category
    assert [tuple(r) for r in dash.top_categories(engagement, profile).collect()] == [("x", 2), ("y", 1)]
    assert [tuple(r) for r in dash.top_categories(engagement, profile, k=1).collect()] == [("x", 2)]
