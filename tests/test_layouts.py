"""Tables laid out so that joins need no exchange and scans skip what they can."""

import re

import pytest
from pyspark.sql import functions as F

from starmart.catalog import queries as catalog
from starmart.plans import dashboards as dash
from starmart.sinks.tables import write_bucketed, write_by_year, write_table


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return catalog.Model(spark, sf_dir)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_bucketed_fact_is_not_exchanged(spark, model, tmp_path):
    monthly = write_bucketed(model.monthly_fact, "bucketed_monthly", str(tmp_path / "m"), buckets=8)
    labels = write_bucketed(model.dim_business, "bucketed_business", str(tmp_path / "b"), buckets=8)
    plan = plan_of(dash.top_subcategories(monthly, labels))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert set(exchanges) <= {"subcategory"} and "Bucketed: true" in plan  # only the finished totals move
    plain = dash.top_subcategories(model.monthly_fact, model.dim_business)
    assert dash.top_subcategories(monthly, labels).collect() == plain.collect()


def test_date_filter_prunes_years_at_run_time(spark, model, tmp_path):
    fact = write_by_year(model.operations, str(tmp_path / "fact"))
    write_table(model.operations_days, str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    result = dash.days_between(fact, days, "1995-12-01", "1996-02-29")
    assert "dynamicpruning" in plan_of(result)
    rows = result.collect()
    assert {r.date.year for r in rows} == {1995, 1996} and rows == sorted(rows, key=lambda r: r.date)
    assert sum(r.reviews for r in rows) == fact.where(F.col("date_id").between("19951201", "19960229")).agg(F.sum("daily_reviews")).first()[0]
    assert fact.count() == model.operations.count()


def test_stored_fact_has_bloom_filters_on_the_business(spark, tmp_path):
    """Where businesses are too many for a dictionary, which would serve the same lookups."""
    import glob

    import pyarrow.parquet as pq
    fact = spark.range(300_000).coalesce(1).select(F.md5(F.col("id").cast("string")).alias("business_id"), F.lit("19960101").alias("date_id"))
    write_by_year(fact, str(tmp_path / "fact"))
    path = glob.glob(str(tmp_path / "fact/year=1996/*.parquet"))[0]
    with open(path, "rb") as raw:
        body = raw.read()
    meta = pq.read_metadata(path)
    data = sum(meta.row_group(i).column(j).total_compressed_size for i in range(meta.num_row_groups) for j in range(meta.num_columns))
    assert len(body) - data > 50_000  # the filters lie outside the column chunks
    known = spark.read.parquet(str(tmp_path / "fact"))
    assert known.where("business_id = 'no such business'").count() == 0
