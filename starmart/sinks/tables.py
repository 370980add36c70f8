"""Parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, functions as F


def write_table(
    table: DataFrame, path: str, partition_by: list[str] | None = None, cluster_by: list[str] | None = None, placed: bool = False
) -> int:
    """Overwrite the table at ``path`` and return its row count, taken during the write.

    ``cluster_by`` ranges and sorts the rows by these columns, so that the
    statistics of files and row groups let a filter on the first of them skip
    most of the table. ``placed`` says that the rows of a value of the first
    one lie together already: they are sorted where they lie, and Bloom filters
    on it let a lookup skip the files that do not hold the value.
    """
    seen = Observation()
    if cluster_by:
        table = (table if placed else table.repartitionByRange(*cluster_by)).sortWithinPartitions(*cluster_by)
    writer = table.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
    if cluster_by and placed:
        # of a few sizes the smallest that serves the values of a row group
        writer = writer.option(f"parquet.bloom.filter.enabled#{cluster_by[0]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_bucketed(table: DataFrame, name: str, path: str, key: str = "business_id", buckets: int = 64) -> DataFrame:
    """Store the table under ``name`` in the session's catalog, bucketed and sorted by ``key``; the stored table.

    Tables with the same number of buckets are grouped and joined by their key where they lie, without an exchange. The
    rows are dealt to the buckets once, here, so that every bucket is one file.
    """
    spark = table.sparkSession
    (table.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def write_placed(table: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store rows that lie in ``buckets`` hash partitions of ``key`` as they lie; the stored table.

    Spark knows of what it returns that the rows of a key lie together, so groupings by it and joins need no exchange.
    The session's catalog, which holds that knowledge, is told of the table for a moment only.
    """
    spark, name = table.sparkSession, f"placed_{uuid.uuid4().hex}"
    try:
        (table.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
         .option("path", path).saveAsTable(name))
        return spark.table(name)
    finally:
        spark.sql(f"drop table if exists {name}")  # the files stay


def write_by_year(table: DataFrame, path: str, date_id: str = "date_id", key: str = "business_id") -> DataFrame:
    """Store the fact in a folder per year of its date key (yyyyMMdd), with Bloom filters on ``key``; the stored fact.

    ``year`` becomes a column of the fact. A join with a calendar on date and year is pruned at run time to the years
    that the calendar's filter leaves, and a lookup of one key skips row groups whose filter does not know it.
    """
    year = F.floor(F.col(date_id).cast("int") / 10000).cast("int")
    (table.withColumn("year", year).repartition("year", key).sortWithinPartitions("year", key)
     .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true").partitionBy("year").parquet(path))
    return table.sparkSession.read.schema(table.withColumn("year", year).schema).parquet(path)


def preview(table: DataFrame, rows: int = 5) -> DataFrame:
    return table.limit(rows)
