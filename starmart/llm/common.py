"""Helpers shared by the corpus operators: given tables, tables stored in the shared folder, ranks in a global order."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starmart.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """The frame written once to the shared folder and read back.

    Later plans start from the files, so a lost executor costs one task and not the stages before it.
    """
    path = scratch_path(frame.sparkSession, tag)
    frame.write.option("compression", compression).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def bucketed(frame: DataFrame, key: str, tag: str) -> Iterator[DataFrame]:
    """The frame, grouped by ``key`` and so dealt by it already, stored in one bucket for each partition of a shuffle.

    Joins by ``key`` leave these rows where they lie. Buckets are known by a name in the session's catalog, which goes
    when the block ends.
    """
    spark, path = frame.sparkSession, scratch_path(frame.sparkSession, tag)
    name = f"llm_{tag}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        frame.write.format("parquet").bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"drop table if exists {name}")


def release() -> None:
    """Gives back the memory that this process freed and its allocators keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def releasing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, with freed memory given back before its task begins and when it ends.

    A worker stays for later tasks; what its allocators keep would stand beside the sorts and joins of later stages.
    """
    def held(batches):
        release()
        yield from run(batches)
        release()
    return held


def ranked(frame: DataFrame, order: list[Column], rank: str, tag: str) -> DataFrame:
    """``frame`` with a dense position from 0 in the given order, by a range exchange and per-range counts.

    No task sees more than one range; only one row per range (a count) meets in a single task.
    """
    placed = stored(
        frame.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__range", F.spark_partition_id())
        .withColumn("__within", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        tag)
    counts = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (placed.join(starts, "__range")
            .withColumn(rank, F.col("__start") + F.col("__within"))
            .drop("__range", "__within", "__start"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit. Works on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))
