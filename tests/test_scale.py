"""Hot keys without a cap, audited builds, clustered tables, order of results, rows read at execution."""

import re

import pytest
from pyspark.sql import Window, functions as F

from starmart import schemas
from starmart.catalog import queries as catalog
from starmart.operators import events, facts
from starmart.operators.skew import heavy_keys, lookup_join
from starmart.plans import dashboards as dash
from starmart.plans.star_schema import build_star_schema
from starmart.sinks.tables import write_table
from starmart.sources import json_lines, samples


@pytest.fixture
def conf(spark):
    changed = []

    def put(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            changed.append((key, spark.conf.get(key, None)))
            spark.conf.set(key, value)
    yield put
    for key, value in reversed(changed):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_read(frame) -> int:
    """Rows that the executed plan's scans gave out; a reused exchange scans nothing again."""
    frame.collect()
    plan, total, seen = frame._jdf.queryExecution().executedPlan(), 0, set()

    def walk(node):
        nonlocal total
        name = node.nodeName()
        if name.startswith("ReusedExchange"):
            return
        if name.startswith("Scan parquet") and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("numOutputRows").value()
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        children = node.children()
        for child in [*inner, *[children.apply(i) for i in range(children.size())]]:
            walk(child)
        below = node.subqueries()
        for i in range(below.size()):
            walk(below.apply(i))
    walk(plan)
    return total


# ---- hot keys

def test_every_key_above_an_even_share_is_found(spark, conf):
    conf(spark__sql__shuffle__partitions="400")
    hot = spark.range(30_000).select(F.concat(F.lit("h"), F.col("id") % 300).alias("key"))
    rows = hot.union(spark.range(3000).select(F.concat(F.lit("rare"), "id").alias("key"))).repartition(8)
    heavy = heavy_keys(rows, ["key"])[0]
    found = rows.filter(F.array_contains(heavy, F.xxhash64("key"))).select("key").distinct().collect()
    assert {r.key for r in found} == {f"h{i}" for i in range(300)}


def test_each_hot_key_is_spread_over_tasks(spark, conf):
    conf(spark__sql__shuffle__partitions="400", spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(30_000).select(F.concat(F.lit("h"), F.col("id") % 300).alias("key"), "id").repartition(8)
    lookup = rows.select("key").distinct().withColumn("found", F.lit(1))
    joined = lookup_join(rows, lookup, ["key"], "inner")
    placed = joined.select("key", F.spark_partition_id().alias("task"))
    tasks = placed.groupBy("key").agg(F.count_distinct("task").alias("tasks"), F.count("*").alias("n"))
    assert all(r.tasks > 1 and r.n == 100 for r in tasks.collect()) and tasks.count() == 300


def test_known_keys_are_looked_up_by_a_join_that_can_be_split(spark, sf_dir, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = catalog.QUERIES["top_states"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"SortMergeJoin .*LeftSemi", plan)
    assert len(joins) == 2 and "approx_top_k" not in plan
    # the user join comes last, so the grouping by business has an exchange of its own
    assert "user_id" in joins[0] and "business_id" in joins[1]


# ---- nothing dropped uncounted

LINES = ['{"user_id":"u1"}', '{"user_id":"u2"} trailing', "42", "[1,2]", '"s"', "null", "{}"]
MORE = ['{"a":1}}', '{"a":1}{"b":2}', '{"a":1}],[{"b":2}', '{"a":1},{"b":2}', "{'a':1}", '{"user_id":']


def test_lines_that_hold_more_or_less_than_an_object_are_rejected(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text("\n".join([*LINES, "", "  "]) + "\n", encoding="utf-8")
    kept = json_lines.read_json_lines(spark, str(path), schemas.USER)
    assert sorted((r.user_id for r in kept.collect()), key=str) == [None, "u1"]
    assert json_lines.json_reject_stats(spark, str(path)).first().asDict() == {"kept": 2, "rejected": 5}
    path.write_text("\n".join([*MORE, '{"user_id":"a","user_id":"b"}', ' {"user_id":"x","fans":NaN} ']) + "\n", encoding="utf-8")
    assert json_lines.json_reject_stats(spark, str(path)).first().asDict() == {"kept": 2, "rejected": len(MORE)}


def test_staging_counts_kept_and_rejected_lines(spark, tmp_path):
    for name in schemas.SOURCES:
        (tmp_path / name).write_text("\n".join(LINES) + "\n", encoding="utf-8")
    audit = {}
    staged = json_lines.stage_sources(spark, {n: str(tmp_path / n) for n in schemas.SOURCES}, str(tmp_path / "out"), audit)
    assert audit == {name: {"kept": 2, "rejected": 5} for name in schemas.SOURCES}
    assert {frame.count() for frame in staged.values()} == {2}


@pytest.fixture
def small(spark, sf_dir):
    return {name: frame.limit(200) for name, frame in samples.sources(spark, sf_dir).items()}


def test_build_counts_what_it_drops_and_keeps_events_without_a_business(spark, small, tmp_path):
    line = F.row_number().over(Window.orderBy("review_id"))
    review = small["review"].withColumn("n", line)
    small["review"] = review.withColumn("date", F.when(F.col("n") <= 3, "bad").otherwise(F.col("date"))).withColumn(
        "business_id", F.when(F.col("n").between(3, 7), None).otherwise(F.col("business_id"))).drop("n")
    small["review"].write.parquet(str(tmp_path / "review"))
    small["review"] = spark.read.parquet(str(tmp_path / "review"))
    audit = {}
    build_star_schema(spark, small, str(tmp_path / "star"), audit=audit)
    assert audit["review"] == {"rows": 200, "bad_dates": 3, "no_business": 4}
    assert audit["tip"] == {"rows": 200, "bad_dates": 0, "no_business": 0}
    monthly = spark.read.parquet(str(tmp_path / "star/manager/Fact_Business_Performance"))
    assert monthly.agg(F.sum("review_count")).first()[0] == 200 - 3
    assert monthly.filter("business_id is null").agg(F.sum("review_count")).first()[0] == 4


def test_repeated_business_fails_the_build_and_leaves_the_old_tables(spark, small, tmp_path):
    out = str(tmp_path / "star")
    before = build_star_schema(spark, small, out)
    first = small["business"].limit(1)
    small["business"] = small["business"].union(first.withColumn("name", F.lit("another name")))
    with pytest.raises(ValueError, match="1 values of business_nk"):
        build_star_schema(spark, small, out)
    assert spark.read.parquet(f"{out}/investor/Dim_Business").count() == before["investor/Dim_Business"]


# ---- storage

def test_filter_by_business_reads_a_fraction_of_a_clustered_fact(spark, sf_dir, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    fact = facts.operational_daily_fact(catalog.Model(spark, sf_dir).activity("review", "checkin"))
    n = write_table(fact, str(tmp_path / "fact"), cluster_by=["business_id", "date_id"])
    stored = spark.read.parquet(str(tmp_path / "fact"))
    one = stored.select("business_id").first()[0]
    read = rows_read(dash.manager_kpis(stored, one))
    assert 0 < read < n / 3


def test_several_machines_need_a_shared_folder():
    from starmart.session import shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


# ---- order of results, as returned

def test_results_come_in_their_order(spark, sf_dir):
    run = lambda name: catalog.QUERIES[name](spark, sf_dir).collect()
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    got = [r.day_of_week for r in run("performance_by_day")]
    assert got == sorted(got, key=lambda d: days.index(d) if d in days else d) and len(got) > 1
    for name, key in {
        "weekly_performance": lambda r: r.week_start_date, "avg_stars_monthly": lambda r: (r.year, r.month),
        "investor_trend": lambda r: r.month_id, "top_states": lambda r: (-r.review_count, r.state),
        "top_categories": lambda r: (-r.review_count, r.category_name),
        "top_subcategories": lambda r: (-r.category_total_reviews, r.subcategory),
    }.items():
        got = run(name)
        assert got == sorted(got, key=key) and len(got) > 1, name


# ---- rows read

def test_rows_read_by_shared_paths(spark, sf_dir):
    pass_once = rows_read(catalog.QUERIES["monthly_fact"](spark, sf_dir))
    assert rows_read(catalog.QUERIES["avg_stars_monthly"](spark, sf_dir)) <= 1.2 * pass_once


def test_many_shared_reviews(spark):
    """300,000 review ids under two businesses each."""
    n = F.col("id")
    engagement = spark.range(600_000).select((n % 300_000).cast("string").alias("review_id"),
                                             F.concat(F.lit("b"), F.floor(n / 300_000) * 30 + n % 30).alias("business_id"))
    profile = spark.range(60).select(F.concat(F.lit("b"), "id").alias("business_id"),
                                     F.array(F.concat(F.lit("c"), n % 15), F.concat(F.lit("d"), n % 4)).alias("categories"))
    listed = profile.select("business_id", F.explode("categories").alias("category_name"))
    brute = (engagement.join(listed, "business_id").groupBy("category_name").agg(F.count_distinct("review_id").alias("review_count"))
             .orderBy(F.desc("review_count"), "category_name").limit(10))
    assert dash.top_categories(engagement, profile).collect() == brute.collect()


def test_events_without_a_business_have_their_own_month(spark):
    activity = events.activity_rows(spark.createDataFrame(
        [(None, "r1", 4.0, "2020-01-05 10:00:00"), ("b", "r2", 5.0, "2020-01-06 10:00:00")],
        "business_id string, review_id string, stars double, date string"))
    assert {(r.business_id, r.month_id, r.review_count) for r in facts.monthly_fact(activity).collect()} == {
        (None, "202001", 1), ("b", "202001", 1)}


def test_readers_of_engagement_share_its_shuffles(spark, tmp_path):
    """Reading the rows with and without asking for a business gives the same joins below, so Spark makes them once."""
    spark.range(60).selectExpr("id", "id % 7 as user", "id % 5 as business", "'2020-01-02 03:04:05' as date").write.parquet(f"{tmp_path}/review")
    spark.range(5).selectExpr("cast(id as string) as business_id", "'s' as state", "array('a') as categories").write.parquet(f"{tmp_path}/profile")
    spark.range(7).selectExpr("cast(id as string) as user_id").write.parquet(f"{tmp_path}/user")
    review, profile, user = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("review", "profile", "user"))
    review = review.selectExpr("cast(id as string) as review_id", "cast(user as string) as user_id", "cast(business as string) as business_id",
                               "1.0D as stars", "1L as useful", "1L as funny", "1L as cool", "date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = facts.engagement_rows(review, None, user, profile)
        both = rows.groupBy("business_id").agg(F.max("review_id")).union(
            rows.where("business_id is not null").groupBy("review_id").agg(F.max("business_id")))
        plan = both._jdf.queryExecution()
        assert len(both.collect()) == 5 + 60
        made = [line for line in plan.executedPlan().toString().split("Initial Plan")[0].splitlines()
                if "Exchange hashpartitioning(user_id" in line and "ReusedExchange" not in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(made) == 2  # the reviews and the users, once each


def test_days_that_are_rolled_up_need_no_shuffle(spark):
    rows = spark.createDataFrame([("r1", "b1", "2020-01-02 03:04:05", 4.0), ("r2", "b1", "2020-01-02 09:00:00", 2.0), ("r3", None, "x", 1.0)],
                                 "review_id string, business_id string, date string, stars double")
    daily = events.daily_activity(events.activity_rows(rows)).localCheckpoint()
    plain, rolled = facts.operational_daily_fact(daily), facts.operational_daily_fact(daily, rolled=True)
    assert plain.collect() == rolled.collect() and rolled.count() == 1
    assert "Exchange" not in rolled._jdf.queryExecution().executedPlan().toString()


def test_lines_are_joined_to_their_orders_once(spark, sf_dir, tmp_path):
    def keep(name, frame):
        kept.append(name)
        frame.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    kept = []
    found = samples.sources(spark, sf_dir, keep)
    assert kept == ["order_lines"]
    for name, frame in samples.sources(spark, sf_dir).items():
        assert frame.schema == found[name].schema and frame.exceptAll(found[name]).isEmpty() and frame.count() == found[name].count()
    assert "orders" not in found["review"]._jdf.queryExecution().executedPlan().toString().replace("order_lines", "")


@pytest.fixture
def made(spark, tmp_path):
    """Reviews, check-ins and tips of 40 businesses, one of them with a third of the events; some keys unknown, missing or bad."""
    n = F.col("id")
    business = F.when(n % 3 == 0, "b0").when(n % 50 == 1, None).otherwise(F.concat(F.lit("b"), n % 41))
    day = F.when(n % 60 == 7, "no date").otherwise(F.concat(F.lit("2020-0"), n % 9 + 1, F.lit("-1"), n % 7, F.lit(" 10:00:00")))
    rows = spark.range(3000).select(
        F.when(n % 45 != 2, F.concat(F.lit("r"), n)).alias("review_id"), F.when(n % 30 != 4, F.concat(F.lit("u"), n % 23)).alias("user_id"),
        business.alias("business_id"), F.when(n % 11 != 3, (n % 5 + 1).cast("double")).alias("stars"), n.alias("useful"), n.alias("funny"),
        n.alias("cool"), day.alias("date"), F.when(n % 4 != 0, (n % 8) / 8).alias("score"))
    frames = {"review": rows, "tip": rows.where(n % 2 == 0).select("user_id", "business_id", "date"),
              "checkin": rows.where(n % 5 == 0).select("business_id", F.concat("date", F.lit(", 2020-03-04 05:06:07")).alias("date")),
              "users": spark.range(20).select(F.concat(F.lit("u"), "id").alias("user_id")),
              "businesses": spark.range(38).select(F.concat(F.lit("b"), "id").alias("business_id"))}
    for name, frame in frames.items():
        frame.repartition(3).write.parquet(f"{tmp_path}/made/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/made/{name}") for name in frames}


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


def exchanges(frame) -> list[str]:
    """The exchanges of the plan as first made, without broadcasts."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range|Round|Single)[^\[]*", plan)


def test_days_that_lie_by_business_are_not_shuffled_again(spark, made, tmp_path, conf):
    from starmart.operators import dimensions as dims
    from starmart.sinks.tables import write_placed
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8")
    sources = [made[name] for name in ("review", "checkin", "tip")]
    plain = events.daily_activity(events.activity_rows(*sources, score_col="score"))
    days = events.placed_daily_activity(*sources, 8, "score")
    assert sum("business_id" in e and "date" not in e for e in exchanges(days)) == 1
    tables = spark.catalog.listTables()
    stored = write_placed(days, str(tmp_path / "days"), "business_id", 8)
    assert spark.catalog.listTables() == tables
    assert stored.schema.simpleString() == plain.schema.simpleString() and rows_of(stored) == rows_of(plain)
    for build in (facts.monthly_fact, lambda a: facts.operational_daily_fact(a, rolled=True), events.business_review_stats):
        assert exchanges(build(stored)) == [] and rows_of(build(stored)) == rows_of(build(plain))
    keys = made["businesses"].select(F.col("business_id").alias("business_nk"), (F.crc32("business_id") * 7).alias("business_key"))
    calendar = dims.dim_date(events.review_checkin_dates(stored), "investor")
    daily = facts.daily_fact(stored, keys, calendar, rolled=True)
    assert rows_of(daily) == rows_of(facts.daily_fact(plain, keys, calendar)) and daily.count() > 100
    assert not [e for e in exchanges(daily) if "date" in e and "bucket" in e]
    moved = [line for line in daily._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
             if "Exchange hashpartitioning(bucket" in line]
    assert moved  # the businesses, a row each, and not their days


def test_reviews_meet_businesses_and_tips_in_one_shuffle(spark, made, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8")
    review, tip, checkin, users, businesses = (made[n] for n in ("review", "tip", "checkin", "users", "businesses"))
    days = spark.sql("select explode(sequence(date '2020-01-01', date '2020-12-31')) as full_date")
    tipped = tip.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("tip_count"))
    listed = checkin.groupBy("business_id").agg(F.sum(F.size(F.split("date", ", "))).alias("checkin_count"))
    plain = (review.where("date != 'no date'").join(users, "user_id").join(businesses, "business_id")
             .join(tipped, ["user_id", "business_id"], "left").join(listed, "business_id", "left")
             .selectExpr("review_id", "user_id", "business_id", "cast(date_format(date, 'yyyyMMdd') as int) as date_id", "cast(stars as int) as stars",
                         "useful as useful_votes", "funny as funny_votes", "cool as cool_votes", "coalesce(tip_count, 0) as tip_count",
                         "cast(coalesce(checkin_count, 0) as bigint) as checkin_count"))
    unknown = facts.unknown_keys(review, users, "user_id")
    assert rows_of(unknown) == rows_of(spark.createDataFrame([("u20",), ("u21",), ("u22",)], "user_id string"))
    for dim, name in ((users, "some"), (review.select("user_id"), "none")):
        write_table(facts.unknown_keys(review, dim, "user_id"), str(tmp_path / name))
        known = spark.read.schema("user_id string").parquet(str(tmp_path / name))
        fact = facts.engagement_fact(review, tip, checkin, days, dim, businesses, known)
        if name == "some":
            assert rows_of(fact) == rows_of(plain)
    moves = [e for e in exchanges(fact) if "_salt" in e]
    assert len(moves) == 2 and not [e for e in exchanges(fact) if re.match(r"Exchange hashpartitioning\(user_id#\d+, \d+\)", e)]
    assert rows_of(facts.engagement_fact(review, tip, checkin, days, users, businesses)) == rows_of(plain)


def test_build_places_facts_and_counts_its_events(spark, made, tmp_path):
    """The build on skewed events: the audit counts each once, and a lookup of a business reads little of a fact."""
    n = F.col("id")
    business = spark.range(38).select(
        F.concat(F.lit("b"), "id").alias("business_id"), F.lit("n").alias("name"), F.lit("a").alias("address"), F.lit("c").alias("city"),
        F.lit("s").alias("state"), F.lit("p").alias("postal_code"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
        F.lit(3.0).alias("stars"), n.alias("review_count"), F.lit(1).alias("is_open"), F.lit("{}").alias("attributes"),
        F.lit("x, y").alias("categories"), F.lit(None).cast("string").alias("hours"))
    user = made["users"].select(
        "user_id", F.lit("n").alias("name"), F.lit("2010-01-02 03:04:05").alias("yelping_since"), F.lit(1).cast("bigint").alias("review_count"),
        F.lit(1.0).alias("average_stars"), F.lit(0).cast("bigint").alias("fans"), F.lit("").alias("elite"),
        *[F.lit(0).cast("bigint").alias(c) for c in schemas.COMPLIMENTS])
    review = made["review"].withColumn("text", F.lit("t"))
    audit = {}
    build_star_schema(spark, {"business": business, "user": user, "review": review, "tip": made["tip"], "checkin": made["checkin"]},
                      str(tmp_path / "star"), score_col="score", audit=audit)
    assert audit["review"]["rows"] == 3000 and audit["tip"]["rows"] == 1500
    assert audit["review"]["bad_dates"] == review.where("date = 'no date'").count()
    fact = spark.read.parquet(str(tmp_path / "star/marketing/FactCustomerEngagement"))
    known = review.where("date != 'no date'").join(made["users"], "user_id", "left_semi").join(made["businesses"], "business_id", "left_semi")
    assert fact.count() == known.count()
    for folder in ("manager/Fact_Business_Performance", "operations/Fact_Operational_Performance", "marketing/FactCustomerEngagement"):
        stored = spark.read.parquet(str(tmp_path / "star" / folder)).withColumn("file", F.input_file_name())
        assert stored.where("business_id is not null").groupBy("business_id").agg(F.count_distinct("file").alias("files")).agg(F.max("files")).first()[0] <= 8


def test_review_ids_are_stored_only_if_shared(spark, made, tmp_path):
    """What the dashboards store grows with businesses and days, and with review ids under several businesses."""
    review = made["review"].where("review_id is not null").withColumn("categories", F.array("business_id"))
    review = review.unionByName(review.where("review_id in ('r10', 'r11')").withColumn("business_id", F.lit("b5")))
    profile = made["businesses"].select("business_id", F.lit("s").alias("state"), F.array("business_id").alias("categories"))
    counts, kept = {}, {}

    def keep(name, frame):
        frame.write.parquet(f"{tmp_path}/kept/{name}")
        kept[name] = spark.read.schema(frame.schema).parquet(f"{tmp_path}/kept/{name}")
        counts[name] = kept[name].count()
        return kept[name]
    unknown = {key: keep(f"no_{key}", facts.unknown_keys(review, dim, key)) for key, dim in (
        ("user_id", made["users"]), ("business_id", made["businesses"]))}
    engagement = facts.engagement_rows_without(review, unknown["user_id"], unknown["business_id"])
    plain = facts.engagement_rows(review, None, made["users"], made["businesses"])
    assert rows_of(engagement) == rows_of(plain) and counts["no_user_id"] == 3 and counts["no_business_id"] == 3
    activity = events.activity_rows(review)
    users = made["users"].select("user_id", F.lit(1).alias("review_count"), F.lit(1.0).alias("average_stars"), F.lit(1).alias("fans"),
                                 F.lit(1).alias("compliment_count"))
    labels = made["businesses"].select("business_id", F.lit("l").alias("subcategory"))
    from starmart.operators import dimensions as dims
    sets = dash.all_dashboards(facts.operational_daily_fact(activity), dims.dim_date(events.review_checkin_dates(activity), "operations"),
                               engagement, facts.monthly_fact(activity), labels, profile, users, keep)
    assert sets["marketing"]["topCategories"].collect() == dash.top_categories(plain, profile).collect()
    assert sets["marketing"]["reviewsByState"].collect() == dash.top_states(plain, profile).collect()
    assert kept["owners"].where("review_id is not null").count() == 2 and counts["owners"] <= 38 + 2
    assert counts["engagement"] <= 38 + 63  # businesses and days
