"""The dashboard questions as SQL table functions equal the DataFrame results."""

import pytest
from pyspark.sql import functions as F

from starmart.catalog import queries as catalog
from starmart.plans import dashboards as dash, sql_functions

from test_exact import monthly, tables  # noqa: F401  (fixtures)


@pytest.fixture(scope="module")
def results(spark, tables):  # noqa: F811
    operations, days, engagement, months, labels, profile, users = tables
    names = ["operations", "days", "engagement", "monthly", "labels", "profile", "users"]
    frames = dict(zip(names, (operations, days, engagement, months, labels, profile, users)))
    made = sql_functions.register(spark, {sql_functions.VIEWS[n]: f for n, f in frames.items()})
    assert set(made) == set(sql_functions.FUNCTIONS) and len(made) == 12
    return {
        "manager_kpis": lambda b=None: dash.manager_kpis(operations, b), "weekly_performance": lambda b=None: dash.weekly_performance(operations, days, b),
        "users_by_review_bucket": lambda: dash.users_by_review_bucket(users), "performance_by_day": lambda b=None: dash.performance_by_day(operations, days, b),
        "avg_stars_monthly": lambda: dash.avg_stars_monthly(engagement), "vote_distribution": lambda: dash.vote_distribution(engagement),
        "top_states": lambda: dash.top_states(engagement, profile), "top_categories": lambda: dash.top_categories(engagement, profile),
        "user_stats": lambda: dash.user_stats(users), "investor_kpis": lambda: dash.investor_kpis(months),
        "investor_trend": lambda: dash.investor_trend(months), "top_subcategories": lambda: dash.top_subcategories(months, labels),
    }


@pytest.mark.parametrize("name", sorted(sql_functions.FUNCTIONS))
def test_function_equals_the_dataframe(spark, results, name):
    by_sql = spark.sql(f"select * from {name}()")
    expected = results[name]()
    assert by_sql.columns == expected.columns
    assert sorted(map(repr, by_sql.collect())) == sorted(map(repr, expected.collect()))
    if "business" in sql_functions.FUNCTIONS[name][0]:
        for business in ("b3", "nobody"):
            one = spark.sql(f"select * from {name}(business => :b)", args={"b": business})
            assert sorted(map(repr, one.collect())) == sorted(map(repr, results[name](business).collect()))
    if "k int" in sql_functions.FUNCTIONS[name][0]:
        assert spark.sql(f"select * from {name}(k => 2)").collect() == expected.collect()[:2]


def test_a_bound_business_reaches_the_scan(spark, sf_dir, tmp_path):
    catalog.Model(spark, sf_dir).operations.limit(1000).write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    sql_functions.register(spark, {"operations/Fact_Operational_Performance": stored})
    plan = spark.sql("select * from manager_kpis(business => '7')")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(business_id,7)" in plan
    everyone = spark.sql("select * from manager_kpis()")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" in everyone
    assert stored.agg(F.count("*")).first()[0] == 1000
