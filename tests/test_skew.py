"""Skewed inputs: results must be those of the plain operators, and heavy keys must be spread."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import events, facts
from starmart.operators.keys import dense_key, duplicate_keys
from starmart.operators.skew import heavy_keys, lookup_join
from starmart.plans import dashboards as dash


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; a third has the key ``hot``, some are exact copies, some have no key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(F.concat(F.lit("k"), n % 997))
    rows = spark.range(20000).repartition(8, "id").select(
        key.alias("key"), F.when(n % 3 == 0, 0).otherwise(n).alias("value"))
    rows.write.mode("overwrite").parquet(spark.conf.get("spark.checkpoint.dir") + "/skewed")
    return spark.read.parquet(spark.conf.get("spark.checkpoint.dir") + "/skewed")


@pytest.fixture(scope="module")
def lookup(spark):
    names = spark.range(0, 997, 2).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("found"))
    return names.unionByName(spark.sql("select 'hot' as key, -1L as found"))


def ordered(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_heavy_keys_finds_the_hot_one(skewed):
    heavy = heavy_keys(skewed, ["key"])[0]
    found = skewed.filter(F.array_contains(heavy, F.xxhash64("key"))).select("key").distinct()
    assert ("hot",) in ordered(found)


def test_heavy_keys_of_nothing(skewed, lookup):
    assert lookup_join(skewed.filter("false"), lookup, ["key"], "inner").count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_lookup_join_equals_plain_join(spark, skewed, lookup, how, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        ours = lookup_join(skewed, lookup, ["key"], how)
        plain = skewed.join(lookup, "key", how)
        assert ours.columns == plain.columns
        assert ordered(ours) == ordered(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_lookup(spark, skewed, lookup):
    with_null = lookup.unionByName(spark.sql("select cast(null as string) as key, -2L as found"))
    ours = lookup_join(skewed, with_null, ["key"], "left", null_safe=True)
    assert ours.count() == skewed.count()
    assert ours.filter("key is null").select("found").distinct().collect() == [(-2,)]


def test_hot_key_rows_land_in_many_partitions(spark, skewed, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup_join(skewed, lookup, ["key"], "inner")
        spread = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert spread > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_categories_with_shared_reviews_equals_brute_force(spark):
    """A third of the rows is one review id, and many ids belong to several businesses."""
    n = F.col("id")
    engagement = spark.range(6000).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), n % 2500)).alias("review_id"),
        F.concat(F.lit("b"), F.pmod(n * 7, F.lit(60))).alias("business_id"),
    )
    profile = spark.range(60).select(
        F.concat(F.lit("b"), "id").alias("business_id"),
        F.array(F.concat(F.lit("c"), n % 15), F.concat(F.lit("d"), n % 4), F.lit("")).alias("categories"),
    )
    listed = profile.select("business_id", F.explode("categories").alias("category_name")).filter("category_name != ''")
    brute = (
        engagement.join(listed, "business_id").groupBy("category_name")
        .agg(F.count_distinct("review_id").alias("review_count"))
        .orderBy(F.desc("review_count"), "category_name").limit(10)
    )
    assert dash.top_categories(engagement, profile).collect() == brute.collect()


def test_engagement_fact_with_a_hot_pair_equals_plain_joins(spark):
    """A third of the reviews is one user's for one business; some keys are unknown or missing."""
    n = F.col("id")
    hot = n % 3 == 0
    review = spark.range(9000).repartition(8, "id").select(
        F.concat(F.lit("r"), "id").alias("review_id"),
        F.when(hot, "u0").when(n % 40 == 1, None).otherwise(F.concat(F.lit("u"), n % 301)).alias("user_id"),
        F.when(hot, "b0").otherwise(F.concat(F.lit("b"), n % 97)).alias("business_id"),
        (n % 5 + 1).cast("double").alias("stars"),
        n.alias("useful"), n.alias("funny"), n.alias("cool"),
        F.when(n % 70 == 2, "bad").otherwise("2020-01-15 10:00:00").alias("date"),
    )
    tip = review.filter(n % 2 == 0).select("user_id", "business_id", "date")
    checkin = spark.range(300).select(
        F.concat(F.lit("b"), n % 60).alias("business_id"), F.lit("2020-01-15 10:00:00,2020-01-16 10:00:00").alias("date"))
    users = spark.range(250).select(F.concat(F.lit("u"), "id").alias("user_id"))
    businesses = spark.range(80).select(F.concat(F.lit("b"), "id").alias("business_id"))
    days = spark.sql("select date '2020-01-15' as full_date, 20200115 as date_id")

    plain = (
        review.filter("date != 'bad'").join(users, "user_id").join(businesses, "business_id")
        .join(tip.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("tip_count")),
              ["user_id", "business_id"], "left")
        .join(checkin.groupBy("business_id").agg((2 * F.count(F.lit(1))).alias("checkin_count")),
              "business_id", "left")
        .select("review_id", "user_id", "business_id", F.lit(20200115).alias("date_id"),
                F.col("stars").cast("int"), "useful", "funny", "cool",
                F.coalesce("tip_count", F.lit(0)), F.coalesce("checkin_count", F.lit(0)))
    )
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            ours = facts.engagement_fact(review, tip, checkin, days, users, businesses)
            assert ordered(ours) == ordered(plain)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dense_keys(spark):
    names = spark.range(5000).select(F.concat(F.lit("Customer#"), "id").alias("name"))
    keyed = dense_key(names, "key", ["name"])
    assert [r.key for r in keyed.orderBy("key").collect()] == list(range(1, 5001))
    again = dense_key(names.repartition(3), "key", ["name"])
    assert ordered(keyed) == ordered(again)
    assert duplicate_keys(keyed, ["key"]).count() == 0
    assert duplicate_keys(names.union(names), ["name"]).count() == 5000


def test_facts_from_stored_activity_equal_facts_from_events(spark, sf_dir):
    from starmart.sources import samples

    sources = samples.sources(spark, sf_dir)
    rows = events.activity_rows(sources["review"], sources["checkin"], sources["tip"])
    daily = events.daily_activity(rows)
    for build in (facts.monthly_fact, facts.operational_daily_fact, events.business_review_stats,
                  events.activity_dates, events.review_checkin_dates):
        assert ordered(build(rows)) == ordered(build(daily))
