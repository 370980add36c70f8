"""Versions, incremental refresh, keys that last, mergeable distinct counts, and daily counts as a stream."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import distinct, events, facts
from starmart.operators.keys import extend_keys
from starmart.plans import dashboards as dash, refresh
from starmart.sinks.versions import Warehouse
from starmart.sources.star_tables import read_star_schema, read_table, register_views
from starmart.streaming import daily_counts

SCHEMAS = {
    "business": "business_id string, name string, city string, state string, postal_code string, latitude double, longitude double, "
                "is_open int, categories string",
    "review": "review_id string, business_id string, stars double, score double, date string",
    "checkin": "business_id string, date string", "tip": "business_id string, date string",
}


@pytest.fixture(scope="module")
def given():
    rng = random.Random(9)

    def day():
        return f"20{rng.randint(19, 20)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 10:00:00"
    ids = [*[f"b{i}" for i in range(12)], None]
    return {
        "business": [(f"b{i}", f"n{i}", "c", "s", "p", 1.0, 2.0, 1, "x, y") for i in range(10)],
        "review": [(f"r{i}", rng.choice(ids), float(rng.randint(1, 5)), rng.random(), rng.choice([day(), day(), day(), "bad"])) for i in range(400)],
        "checkin": [(rng.choice(ids), f"{day()}, {day()}") for _ in range(120)],
        "tip": [(rng.choice(ids), day()) for _ in range(100)],
    }


def frames(spark, rows):
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}


def contents(spark, root):
    return {name: sorted(map(repr, frame.collect())) for name, frame in read_star_schema(spark, root).items()}


NEW = {
    "last_day": {"review": [("n1", "b1", 4.0, 0.5, "2020-12-31 09:00:00"), ("n2", "b11", 2.0, None, "2020-12-31 10:00:00")],
                 "checkin": [("b2", "2020-12-31 11:00:00")], "tip": [(None, "2020-12-31 12:00:00")]},
    "late": {"review": [("n1", "b1", 4.0, 0.5, "2019-06-15 09:00:00"), ("n3", None, 1.0, 0.1, "2019-07-15 09:00:00"), ("n4", "b3", 1.0, 0.1, "bad")],
             "checkin": [("b4", "2018-01-01 11:00:00")], "tip": []},
    "nothing": {"review": [], "checkin": [], "tip": []},
}


@pytest.mark.parametrize("kind", sorted(NEW))
def test_refresh_equals_a_full_build(spark, given, tmp_path, kind):
    new, root, whole = NEW[kind], str(tmp_path / "star"), str(tmp_path / "whole")
    sources = frames(spark, given)
    assert refresh.build(spark, sources, root, score_col="score") == 1
    warehouse = Warehouse(spark, root)
    before, first = warehouse.manifest(1), contents(spark, root)
    reader = read_table(spark, root, refresh.DAILY)  # opened before the refresh
    added = {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in new.items()}
    assert refresh.add_events(spark, root, sources["business"], **added, score_col="score") == 2
    together = {n: sources[n] if n == "business" else sources[n].unionByName(added[n]) for n in sources}
    refresh.build(spark, together, whole, score_col="score")
    assert contents(spark, root) == contents(spark, whole)
    assert sorted(map(repr, reader.collect())) == first[refresh.DAILY]  # still the version it was opened in
    after = warehouse.manifest(2)
    rewritten = {n: {p for p, folder in after[n].items() if before[n].get(p) != folder} for n in (refresh.MONTHLY, refresh.DAILY, refresh.ACTIVITY)}
    if kind == "last_day":
        assert set().union(*rewritten.values()) == {"202012"}
    if kind == "late":  # growth of the month behind the late reviews changes as well
        assert {"201906", "201907", "201801"} < rewritten[refresh.MONTHLY] and len(rewritten[refresh.MONTHLY]) < len(after[refresh.MONTHLY])
    assert after["manager/Dim_Location"] == before["manager/Dim_Location"]


def test_versions_are_published_once_and_expire(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.version() == 0 and warehouse.manifest() == {}
    frame = spark.createDataFrame([("b1", 1), (None, 2)], "business_id string, n int")
    one = {"t": warehouse.write("t", frame, F.col("n").cast("string")), "u": warehouse.write("u", frame)}
    assert warehouse.commit(one, 0) == 1 and set(one["t"]) == {"1", "2"}
    two = {"t": {**one["t"], **warehouse.write("t", frame.where("n = 2").withColumn("n", F.lit(5)), F.lit("2"))}}
    assert warehouse.commit(two, 1) == 2
    with pytest.raises(RuntimeError, match="someone else"):
        warehouse.commit(two, 1)
    read = lambda *a: sorted(r.n for r in warehouse.read("t", "business_id string, n int", *a).collect())
    assert read(1) == [1, 2] and read() == [1, 5] and read(2, ["2"]) == [5] and read(2, ["9"]) == []
    assert warehouse.expire(keep=1) == [one["t"]["2"]]
    assert read() == [1, 5] and sorted(warehouse.manifest()) == ["t", "u"]


def test_views_and_dashboards_over_a_version(spark, given, tmp_path):
    root = str(tmp_path / "star")
    refresh.build(spark, frames(spark, given), root, score_col="score")
    assert "Fact_Operational_Performance" in register_views(spark, root, "operations")
    kpis = dash.manager_kpis(read_table(spark, root, refresh.DAILY)).first()
    assert spark.sql("select count(distinct business_id) from Fact_Operational_Performance").first()[0] == kpis.num_businesses > 0


# --- keys

def test_keys_last(spark, tmp_path):
    def business(ids):
        return spark.createDataFrame([(i, None if i % 5 == 0 else f"c{i % 7}") for i in ids], "id long, city string")
    registry, kept = None, {}
    for n, ids in enumerate([range(0, 50), range(20, 80), [3, 90, 90], range(0, 100), []]):
        registry = extend_keys(registry, business(ids), "key", ["id", "city"])
        registry.write.parquet(str(tmp_path / str(n)))
        registry = spark.read.parquet(str(tmp_path / str(n)))
        keys = {(r.id, r.city): r.key for r in registry.collect()}
        assert kept.items() <= keys.items() and sorted(keys.values()) == list(range(1, len(keys) + 1))
        assert {(i, None if i % 5 == 0 else f"c{i % 7}") for i in ids} <= set(keys)
        kept = keys
    assert len(kept) == 100


# --- distinct counts

def test_bitmaps_count_any_range_of_months(spark, tmp_path):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("b"), F.pmod(F.xxhash64("id"), F.lit(70_000)))).alias("business_id"),
        F.concat(F.lit("2020"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("month_id"))
    rows.write.parquet(str(tmp_path / "monthly"))
    monthly = spark.read.parquet(str(tmp_path / "monthly"))
    keys = extend_keys(None, monthly.select("business_id").na.drop(), "business_key", ["business_id"])
    distinct.monthly_bitmaps(monthly, keys).write.parquet(str(tmp_path / "bitmaps"))
    bitmaps = spark.read.parquet(str(tmp_path / "bitmaps"))
    for first, last in (("202001", "202012"), ("202003", "202003"), ("202005", "202010"), ("202101", "202112")):
        expected = monthly.where(F.col("month_id").between(first, last)).agg(F.count_distinct("business_id")).first()[0]
        assert distinct.distinct_between(bitmaps, first, last).first()[0] == expected
    assert bitmaps.select("bucket").distinct().count() > 1
    halves = F.when(F.col("month_id") <= "202006", 1).otherwise(2)
    expected = {tuple(r) for r in monthly.groupBy(halves.alias("p")).agg(F.count_distinct("business_id")).collect()}
    assert {tuple(r) for r in distinct.distinct_by(bitmaps, halves).collect()} == expected


# --- stream

def test_stream_in_deliveries_equals_the_batch(spark, given, tmp_path):
    review = spark.createDataFrame(given["review"], SCHEMAS["review"])
    checkin = spark.createDataFrame(given["checkin"], SCHEMAS["checkin"])
    times = checkin.select("business_id", F.explode(F.split("date", ", ")).alias("time"))
    rows = daily_counts.event_rows(review, times).collect()
    rng, source, out = random.Random(2), str(tmp_path / "in"), str(tmp_path / "out")
    # Mostly in order of time; a fifth of the rows comes one delivery late.
    ordered = sorted(rows, key=lambda r: r.time)
    deliveries = [min(2, i * 3 // len(ordered) + (rng.random() < 0.2)) for i in range(len(ordered))]
    seen = 0
    for n in range(3):
        part = [r for r, d in zip(ordered, deliveries) if d == n]
        spark.createDataFrame(part, daily_counts.EVENT).coalesce(2).write.mode("append").parquet(source)
        told = daily_counts.run(daily_counts.read_events(spark, source, 1), out, str(tmp_path / "check"), "900 days")
        assert told == {"events": len(part), "late": 0}
        seen += len(part)
        if n == 1:  # started again without new files: nothing is counted twice
            assert daily_counts.run(daily_counts.read_events(spark, source, 1), out, str(tmp_path / "check"), "900 days")["events"] == 0
    batch = facts.daily_rollup(events.activity_rows(review, checkin)).select("business_id", "date", "review_count", "star_sum", "checkin_count")
    streamed = daily_counts.current(spark, out).select(*batch.columns)
    exact = [F.col("business_id"), F.col("date"), F.col("review_count"), F.coalesce("star_sum", F.lit(0)).cast("double").alias("s"), F.col("checkin_count")]
    assert seen == len(rows)
    assert sorted(map(repr, streamed.select(*exact).collect())) == sorted(map(repr, batch.select(*exact).collect()))


def test_rows_behind_the_watermark_are_told(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def deliver(*times):
        spark.createDataFrame([("b", t, "checkin", None, None) for t in times], daily_counts.EVENT).coalesce(1).write.mode("append").parquet(source)
        return daily_counts.run(daily_counts.read_events(spark, source), out, check, "10 days")
    deliver("2020-01-01 00:00:00", "2020-03-01 00:00:00", "no time")
    assert deliver("2020-02-25 00:00:00", "2020-01-01 05:00:00") == {"events": 2, "late": 1}
    assert {(str(r.date), r.checkin_count) for r in daily_counts.current(spark, out).collect()} == {
        ("2020-01-01", 1), ("2020-03-01", 1), ("2020-02-25", 1)}


def test_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    """A batch whose commit was lost runs again with its number, and counts once."""
    import os
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("b", "2020-01-01 00:00:00", "checkin", None, None)] * 3, daily_counts.EVENT).coalesce(1).write.parquet(source)
    daily_counts.run(daily_counts.read_events(spark, source), out, check)
    last = max(int(n) for n in os.listdir(f"{check}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{check}/commits/{name}")
    daily_counts.run(daily_counts.read_events(spark, source), out, check)
    assert [(str(r.date), r.checkin_count) for r in daily_counts.current(spark, out).collect()] == [("2020-01-01", 3)]


def test_state_lies_on_disk_and_older_checkpoints_go_on(spark, tmp_path):
    """State in RocksDB, whatever the session says; a checkpoint begun with the store on the heap keeps it."""
    import contextlib
    from pathlib import Path
    key = "spark.sql.streaming.stateStore.providerClass"
    said = spark.conf.get(key, None)

    def deliver(root):
        spark.createDataFrame([("b", "2020-01-01 00:00:00", "checkin", None, None)] * 3, daily_counts.EVENT).coalesce(1).write.mode("append").parquet(f"{root}/in")
        daily_counts.run(daily_counts.read_events(spark, f"{root}/in"), f"{root}/out", f"{root}/check")
        return {p.suffix for p in Path(f"{root}/check/state").rglob("[0-9]*.*") if not p.name.endswith(".crc")}

    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    assert deliver(new) == {".zip", ".sst"} and spark.conf.get(key, None) == said
    on_disk, daily_counts.state_on_disk = daily_counts.state_on_disk, lambda session: contextlib.nullcontext()
    try:
        assert ".delta" in deliver(old)
    finally:
        daily_counts.state_on_disk = on_disk
    for root in (new, old):
        assert (".delta" in deliver(root)) == (root == old)
        assert [r.checkin_count for r in daily_counts.current(spark, f"{root}/out").collect()] == [6]
