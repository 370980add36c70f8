"""JSON sources in, stored star schema out."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import events
from starmart.plans import dashboards as dash
from starmart.plans.star_schema import build_star_schema, row_counts
from starmart.sinks.results import first_row, payload, write_results
from starmart.sinks.tables import preview, write_table
from starmart.sources import json_lines, samples
from starmart.sources.star_tables import read_star_schema, register_views


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("storage"))


@pytest.fixture(scope="module")
def json_paths(spark, sf_dir, root):
    """The sample sources as JSON files, as an export would deliver them."""
    paths = {}
    for name, frame in samples.sources(spark, sf_dir).items():
        paths[name] = f"{root}/json/{name}"
        frame.drop("score").write.json(paths[name])
    return paths


@pytest.fixture(scope="module")
def stored(spark, json_paths, root):
    sources = json_lines.stage_sources(spark, json_paths, f"{root}/staged")
    return build_star_schema(spark, sources, f"{root}/star"), sources


def write_lines(path, lines):
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def test_bad_lines_are_skipped_and_counted(spark, tmp_path):
    path = write_lines(tmp_path / "tips.json", [
        '{"user_id": "u1", "business_id": "b1", "compliment_count": 1}', "{bad json",
        '{"user_id": "u2", "business_id": "b1", "compliment_count": "many"}', '{"user_id": "u3", "busi',
    ])
    kept = json_lines.read_json_lines(spark, path, schemas.TIP)
    assert sorted(r.user_id for r in kept.collect()) == ["u1", "u2"]
    assert kept.count() == 2  # also without reading any column
    assert kept.filter("user_id = 'u2'").first().compliment_count is None
    assert json_lines.json_reject_stats(spark, path, schemas.TIP).first().asDict() == {"kept": 2, "rejected": 2}


ATTRIBUTES = [
    '{"a": 1.10, "b": 1E5, "c": "x\\u00e9é"}', '{ "d":[ 1,{"e":"}\\"{"} ] , "n" : {"a":1}}', "{}", "[1.0 ,2]", "12.50", "true",
    '{%s}' % ", ".join(f'"k{i}":  "v{i}"' for i in range(3000)),
]


def test_nested_objects_keep_their_source_text(spark, tmp_path):
    lines = [f'{{"business_id": "b{i}", "z": {{"attributes": 1}}, "attributes": {a} , "name":"n", "hours":{{"Mon" : "8:0"}}}}'
             for i, a in enumerate(ATTRIBUTES)]
    path = write_lines(tmp_path / "b.json", lines)
    rows = json_lines.read_json_lines(spark, path, schemas.BUSINESS).orderBy(F.expr("int(substr(business_id, 2))")).collect()
    assert [r.attributes for r in rows] == ATTRIBUTES
    assert {(r.name, r.hours, r.categories) for r in rows} == {("n", '{"Mon" : "8:0"}', None)}


def test_text_fields_that_are_no_objects(spark, tmp_path):
    deep = '{"k":' * 12 + "1.0" + "}" * 12
    path = write_lines(tmp_path / "b.json", [
        '{"business_id":"b0","attributes":null}', '{"business_id":"b1","attributes":"a \\"q\\""}', '{"business_id":"b2"}',
        '{"business_id":"b3","attributes":{"x":1},"attributes": {"y": 2.0}}', f'{{"business_id":"b4","attributes": {deep}}}',
    ])
    rows = json_lines.read_json_lines(spark, path, schemas.BUSINESS).orderBy("business_id").collect()
    # the last of repeated fields counts; beyond the levels kept as they stand, text is compact JSON
    assert [r.attributes for r in rows] == [None, 'a "q"', None, '{"y": 2.0}', deep]


def test_typed_values_out_of_source_text(spark):
    frame = spark.createDataFrame([('{"a": 1.50, "b": {"c": "x"}, "d": [1, 2]}',), ("no json",), (None,), ('{"a": "many"}',)], "t string")
    value = json_lines.json_value
    rows = frame.select(value("t", "$.a", "double"), value("t", "$.b.c", "string"), value("t", "$.d[1]", "int")).collect()
    assert [tuple(r) for r in rows] == [(1.5, "x", 2), (None, None, None), (None, None, None), (None, None, None)]


def test_a_line_is_parsed_once(spark, tmp_path):
    path = write_lines(tmp_path / "t.json", ['{"user_id": "u1", "business_id": "b1"}'])
    rows = json_lines.read_json_lines(spark, path, schemas.TIP).filter("user_id = 'u1' and compliment_count is null")
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert rows.count() == 1


def test_missing_source_raises(spark, root, json_paths):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        json_lines.read_sources(spark, {**json_paths, "tip": f"{root}/nowhere"})


def test_staged_sources_equal_the_json(spark, json_paths, stored):
    for name, schema in schemas.SOURCES.items():
        staged = stored[1][name]
        assert staged.schema == schema
        assert staged.count() == spark.read.text(json_paths[name]).count()


def test_stored_tables_have_their_declared_schemas(spark, stored, root):
    counts, _ = stored
    assert set(counts) == set(schemas.STAR_TABLES)
    for name, ddl in schemas.STAR_TABLES.items():
        written = spark.read.parquet(f"{root}/star/{name}")
        declared = spark.read.schema(ddl).parquet(f"{root}/star/{name}")
        assert written.dtypes == declared.dtypes, name
        assert written.count() == counts[name] > 0, name
    assert row_counts(spark, counts).count() == len(counts)


def test_surrogate_keys_are_dense(spark, stored, root):
    tables = read_star_schema(spark, f"{root}/star")
    for name, key in [("investor/Dim_Location", "location_key"), ("investor/Dim_Category", "category_key"),
                      ("investor/Dim_Business", "business_key"), ("manager/Dim_Category", "category_id"),
                      ("investor/Fact_Business_Performance", "performance_key")]:
        row = tables[name].agg(F.min(key), F.max(key), F.count_distinct(key), F.count(F.lit(1))).first()
        assert row[0] == 1 and row[1] == row[2] == row[3], name


def test_facts_account_for_every_event(spark, stored, root):
    counts, sources = stored
    tables = read_star_schema(spark, f"{root}/star")
    monthly = tables["manager/Fact_Business_Performance"]
    totals = monthly.agg(F.sum("review_count"), F.sum("checkin_count"), F.sum("tip_count")).first()
    checkins = events.checkin_events(sources["checkin"]).count()
    assert tuple(totals) == (sources["review"].count(), checkins, sources["tip"].count())
    assert monthly.select("business_id", "month_id").distinct().count() == monthly.count()
    daily = tables["operations/Fact_Operational_Performance"]
    assert daily.select("business_id", "date_id").distinct().count() == daily.count()
    assert daily.agg(F.sum("daily_reviews")).first()[0] == sources["review"].count()
    bridge = tables["manager/Fact_Business_Categories"]
    assert bridge.join(tables["manager/Dim_Category"], "category_id", "left_anti").count() == 0


def test_dashboards_over_stored_tables(spark, stored, root):
    tables = read_star_schema(spark, f"{root}/star")
    sets = dash.marketing_dashboard(
        tables["marketing/FactCustomerEngagement"], tables["marketing/DimDate"],
        tables["marketing/DimBusiness"], tables["marketing/DimUser"],
    )
    write_results(sets, f"{root}/results")
    votes = spark.read.json(f"{root}/results/voteDistribution").first()
    assert votes.asDict() == first_row(sets["voteDistribution"])
    assert spark.read.text(f"{root}/results/reviewsByState").count() == 10
    assert first_row(sets["voteDistribution"].filter("false")) == {}
    combined = payload(sets, {"reviewsByState": [F.desc("review_count"), "state"]})
    assert combined.filter("result_set = 'reviewsByState'").count() == 10


def test_stored_tables_answer_sql(spark, stored, root):
    assert "FactCustomerEngagement" in register_views(spark, f"{root}/star", "marketing")
    by_sql = spark.sql("""
        select b.state, count(f.review_id) as review_count
        from FactCustomerEngagement f join DimBusiness b on f.business_id = b.business_id
        where b.state is not null group by b.state order by review_count desc, state limit 10""")
    tables = read_star_schema(spark, f"{root}/star")
    ours = dash.top_states(tables["marketing/FactCustomerEngagement"], tables["marketing/DimBusiness"])
    assert by_sql.collect() == ours.collect()


def test_write_table_counts_and_overwrites(spark, root):
    frame = spark.range(10).withColumn("part", F.col("id") % 2)
    assert write_table(frame, f"{root}/plain") == 10
    assert write_table(preview(frame, 3), f"{root}/plain") == 3
    assert spark.read.parquet(f"{root}/plain").count() == 3
    assert write_table(frame, f"{root}/parted", ["part"]) == 10
    assert spark.read.parquet(f"{root}/parted").filter("part = 1").count() == 5


def test_nulls_and_dates_in_results(spark, root):
    frame = spark.sql("select date '2020-01-06' as d, cast(null as double) as v")
    assert payload({"x": frame}, {}).first().row_json == '{"d":"2020-01-06","v":null}'
    write_results({"x": frame}, f"{root}/nulls")
    assert spark.read.text(f"{root}/nulls/x").first()[0] == '{"d":"2020-01-06","v":null}'
