"""Results that must not depend on the order of rows, and the dashboards made in one pass per table."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.functions.measures import exact_mean
from starmart.operators import events, facts
from starmart.plans import dashboards as dash

MONTHLY = ("business_id string, month_id string, review_count bigint, checkin_count bigint, tip_count bigint, photo_count int, "
           "engagement_score double, growth_rate double")


@pytest.fixture(scope="module")
def monthly(spark):
    rng, rows = random.Random(3), []
    for i in range(6000):
        n, before = rng.randint(0, 60), rng.choice([1, 2, 3, 7, 13, 64])
        rows.append((f"b{i % 40}", f"1996{i % 12 + 1:02d}", n, i % 5, i % 3, 0, n * 1.0, rng.choice([None, (n - before) / before])))
    return spark.createDataFrame(rows, MONTHLY)


@pytest.mark.parametrize("build", ["investor_trend", "investor_kpis", "top_subcategories"])
def test_growth_is_the_same_in_any_order(monthly, spark, build):
    labels = spark.createDataFrame([(f"b{i}", f"s{i % 4}") for i in range(40)], "business_id string, subcategory string")
    args = [labels] if build == "top_subcategories" else []
    results = [getattr(dash, build)(monthly.repartition(n, F.rand(seed)), *args).collect()
               for n, seed in ((1, 1), (7, 2), (200, 3), (7, 4), (1, 5))]
    assert all(r == results[0] for r in results)


def test_scores_and_ratings_are_the_same_in_any_order(spark):
    rng = random.Random(4)
    review = spark.createDataFrame(
        [(f"b{i % 3}", f"r{i}", rng.random() * 5, rng.uniform(-1, 1), f"2020-01-{i % 4 + 1:02d} 10:00:00") for i in range(3000)],
        "business_id string, review_id string, stars double, score double, date string")
    results = []
    for n, seed in ((1, 1), (7, 2), (64, 3)):
        operations = facts.operational_daily_fact(events.activity_rows(review.repartition(n, F.rand(seed)), score_col="score"))
        results.append((sorted(map(tuple, operations.collect())), dash.manager_kpis(operations.repartition(n, F.rand(seed))).first()))
    assert results[0] == results[1] == results[2]


def test_exact_mean_of_odd_values(spark):
    values = [0.1, 0.2, None, float("nan"), float("inf"), -0.3, 1e9]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert frame.agg(exact_mean("v")).first()[0] == (0.1 + 0.2 - 0.3 + 1e9) / 4
    assert frame.filter("v is null").agg(exact_mean("v")).first()[0] is None


@pytest.fixture(scope="module")
def tables(spark, monthly):
    rng = random.Random(6)
    days = [f"199601{d:02d}" for d in range(1, 29)]
    operations = spark.createDataFrame(
        [(rng.choice(days), rng.choice([None, *[f"b{i}" for i in range(9)]]), rng.randint(0, 4), rng.choice([None, rng.random() * 5]),
          rng.randint(0, 3), rng.choice([None, rng.random()])) for _ in range(400)],
        "date_id string, business_id string, daily_reviews bigint, avg_daily_rating double, daily_checkins bigint, sentiment_score_avg double")
    calendar = spark.createDataFrame([(d,) for d in days], "date_id string").select(
        "date_id", F.to_date("date_id", "yyyyMMdd").alias("date"), F.date_format(F.to_date("date_id", "yyyyMMdd"), "EEEE").alias("day_of_week"))
    engagement = spark.createDataFrame(
        [(rng.choice([None, f"r{i // 2}", f"q{i}"]), rng.choice([None, *[f"b{j}" for j in range(9)]]), 19960101 + i % 28, rng.randint(1, 5), i % 7, i % 5, i % 3)
         for i in range(600)],
        "review_id string, business_id string, date_id int, stars int, useful_votes bigint, funny_votes bigint, cool_votes bigint")
    profile = spark.createDataFrame(
        [(f"b{i}", rng.choice([None, "TX", "NY"]), [f"c{i % 3}", f"d{i % 2}", ""]) for i in range(8)],
        "business_id string, state string, categories array<string>")
    users = spark.createDataFrame(
        [(f"u{i}", rng.choice([None, 0, 3, 9, 30, 90]), rng.choice([None, rng.random()]), i, i % 4) for i in range(60)],
        "user_id string, review_count bigint, average_stars double, fans bigint, compliment_count bigint")
    labels = spark.createDataFrame([(f"b{i}", f"s{i % 4}") for i in range(40)], "business_id string, subcategory string")
    return operations, calendar, engagement, monthly, labels, profile, users


@pytest.mark.parametrize("empty", [False, True])
def test_one_pass_equals_the_single_queries(spark, tables, empty, tmp_path):
    operations, days, engagement, monthly, labels, profile, users = [t.limit(0) if empty else t for t in tables]
    scans = {}

    def keep(name, frame):
        scans[name] = frame._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
        frame.write.parquet(str(tmp_path / name))
        return spark.read.schema(frame.schema).parquet(str(tmp_path / name))

    together = dash.all_dashboards(operations, days, engagement, monthly, labels, profile, users, keep)
    assert empty or set(scans.values()) == {1}  # each table once
    single = {
        "manager": dash.manager_dashboard(operations, days, users),
        "marketing": dash.marketing_dashboard(engagement, None, profile, users),
        "investor": dash.investor_dashboard(monthly, labels),
    }
    for board, results in single.items():
        assert together[board].keys() == results.keys()
        for name, result in results.items():
            assert together[board][name].columns == result.columns
            assert together[board][name].collect() == result.collect(), (board, name)
