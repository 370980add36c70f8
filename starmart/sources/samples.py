"""The five sources derived from an order-processing data set.

``part`` plays the businesses, ``customer`` the users, line items are reviews,
returned line items tips, and open line items and page events check-ins.
Everything is computed from the given tables, row by row or by their own keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.schemas import COMPLIMENTS

TEXT_TIME = "yyyy-MM-dd HH:mm:ss"
LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag",
         "o_custkey", "o_orderdate"]
Keep = Callable[[str, DataFrame], DataFrame]


class Tables:
    """The given tables; each is opened once.

    ``keep(name, frame)``, if given, stores a frame and returns it as stored. Lines are then joined to their orders once,
    here, for callers that read reviews and tips many times; without it every reader joins just the columns it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep: Keep | None = None):
        self._spark, self._sf_dir, self._open, self._keep = spark, sf_dir, {}, keep

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._open[name]

    def order_lines(self) -> DataFrame:
        if "order_lines" not in self._open:
            orders = self["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
            lines = self["lineitem"].join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*LINES)
            self._open["order_lines"] = self._keep("order_lines", lines) if self._keep else lines
        return self._open["order_lines"]


def _text(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("string")


def _time(column: str | Column) -> Column:
    return F.date_format(column, TEXT_TIME)


def business(tables: Tables) -> DataFrame:
    part = tables["part"]
    # a fixed list of 25 nations
    nation = F.broadcast(tables["nation"].select("n_nationkey", "n_name"))
    size, key = F.col("p_size"), F.col("p_partkey")
    listed = F.concat_ws(", ", "p_type", "p_brand", F.translate("p_name", " ", ","))
    return part.join(nation, F.col("n_nationkey") == key % 25).select(
        _text("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("address"),
        F.col("p_name").alias("city"),
        F.col("n_name").alias("state"),
        _text("p_size").alias("postal_code"),
        F.when(size % 7 != 0, size.cast("double") / 2).alias("latitude"),
        F.when(size % 7 != 0, size.cast("double") / -4).alias("longitude"),
        (size % 5 + 1).cast("double").alias("stars"),
        size.cast("bigint").alias("review_count"),
        F.when(size % 5 == 0, 0).otherwise(1).alias("is_open"),
        F.struct(F.col("p_brand").alias("brand"), F.when(size % 3 != 0, size).alias("size")).alias("attributes"),
        F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, F.col("p_type")).otherwise(listed)
        .alias("categories"),
        F.lit(None).cast("string").alias("hours"),
    )


def review(tables: Tables) -> DataFrame:
    """Reviews with one extra column, ``score``, the optional per-review score."""
    review_id = F.concat_ws(
        "-", *[_text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    )
    return tables.order_lines().select(
        review_id.alias("review_id"),
        _text("o_custkey").alias("user_id"),
        _text("l_partkey").alias("business_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("double").alias("stars"),
        F.col("l_linenumber").cast("bigint").alias("useful"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("funny"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("cool"),
        F.concat(F.lit("r "), review_id).alias("text"),
        _time("l_shipdate").alias("date"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount") - F.col("l_tax")).alias("score"),
    )


def tip(tables: Tables) -> DataFrame:
    return tables.order_lines().filter("l_returnflag = 'R'").select(
        _text("o_custkey").alias("user_id"),
        _text("l_partkey").alias("business_id"),
        F.concat(F.lit("t "), _text("l_orderkey")).alias("text"),
        _time("o_orderdate").alias("date"),
        F.col("l_linenumber").cast("bigint").alias("compliment_count"),
    )


def checkin(tables: Tables) -> DataFrame:
    """Check-in lists of one to three times. A business has many rows, so no list grows with the data."""
    shipped, line = F.col("l_shipdate"), F.col("l_linenumber")
    from_lines = tables["lineitem"].filter("l_linestatus = 'O'").select(
        _text("l_partkey").alias("business_id"),
        F.concat_ws(
            ", ",
            _time(shipped),
            F.when(line % 3 >= 1, _time(shipped + F.expr("interval 1 day"))),
            F.when(line % 3 == 2, _time(shipped + F.expr("interval 9 days"))),
        ).alias("date"),
    )
    from_events = tables["events"].select(
        _text("user_id").alias("business_id"), _time("ts").alias("date")
    )
    return from_lines.unionByName(from_events)


def user(tables: Tables) -> DataFrame:
    key = F.col("c_custkey")
    compliments = [
        F.nullif(key % modulus, F.lit(0)).cast("bigint").alias(name)
        for name, modulus in zip(COMPLIMENTS, range(5, 5 + len(COMPLIMENTS)))
    ]
    return tables["customer"].select(
        _text("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(_text(F.lit(2005) + key % 15), F.lit("-01-15 08:30:00")).alias("yelping_since"),
        F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("review_count"),
        ((key % 41).cast("double") / 10 + 1).alias("average_stars"),
        (key % 97).cast("bigint").alias("fans"),
        F.when(key % 3 == 0, "2018,2019").otherwise("").alias("elite"),
        *compliments,
    )


def sources(spark: SparkSession, sf_dir: str, keep: Keep | None = None) -> dict[str, DataFrame]:
    tables = Tables(spark, sf_dir, keep)
    return {make.__name__: make(tables) for make in (business, review, checkin, tip, user)}
