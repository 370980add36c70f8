"""Daily counts per business as a stream.

Events arrive as files, some of them late. A stream groups them by business and day of the event; its state holds the
days that may still change, and a watermark closes days older than ``delay`` behind the newest event, so state stays
bounded. Each micro-batch writes the counts that it changed to a folder of its own, named by the batch: a batch that is
repeated after a failure overwrites what it wrote, so every event counts once. ``current`` reads the last value of each
business and day.

State lives in RocksDB, on the executors' disks and in the checkpoint: a delivery of any size keeps one row per business
and day there, and an executor's memory for all its partitions of state is bounded together. A checkpoint that an earlier
version began keeps the store it was begun with.

Events behind the watermark are no longer counted; ``run`` returns how many there were. Unreadable dates are left out,
as they are in the batch facts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.functions.dates import parse_timestamp
from starmart.functions.measures import EXACT, exact

#: One row per review or check-in, as ``event_rows`` makes them.
EVENT = StructType([
    StructField("business_id", StringType()), StructField("time", StringType()), StructField("kind", StringType()),
    StructField("event_id", StringType()), StructField("stars", StringType())])

_STORE = "spark.sql.streaming.stateStore."
#: The default store holds every row of state, twice after a batch, on the heap.
STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.compression": "zstd",
    f"{_STORE}rocksdb.blockSizeKB": "32",  # larger blocks compress better; keys that are new are told by a filter
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",  # the total would cost a read before every write
}


def event_rows(review: DataFrame | None, checkin_times: DataFrame | None) -> DataFrame:
    """Reviews and single check-ins (business_id, time) as events."""
    none = F.lit(None).cast("string")
    parts = []
    if review is not None:
        parts.append(review.select("business_id", F.col("date").alias("time"), F.lit("review").alias("kind"),
                                   F.col("review_id").alias("event_id"), F.col("stars").cast("string").alias("stars")))
    if checkin_times is not None:
        parts.append(checkin_times.select("business_id", "time", F.lit("checkin").alias("kind"), none.alias("event_id"), none.alias("stars")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the Parquet files that appear below ``path``."""
    reader = spark.readStream.schema(EVENT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def daily_counts(events: DataFrame, delay: str = "30 days") -> DataFrame:
    """Counts by business and day; works on a stream and on a table."""
    review, stars = F.col("kind") == "review", exact("stars")
    return (
        events.withColumn("moment", parse_timestamp("time")).where("moment is not null")
        .withWatermark("moment", delay)
        .groupBy("business_id", F.window("moment", "1 day").alias("day"))
        .agg(
            F.count(F.when(review, F.col("event_id"))).alias("review_count"),
            F.sum(F.when(review, stars)).alias("star_sum"), F.count(F.when(review, stars)).alias("star_count"),
            F.count_if(F.col("kind") == "checkin").alias("checkin_count"),
        )
        .select("business_id", F.col("day.start").cast("date").alias("date"), "review_count", "star_sum", "star_count", "checkin_count")
    )


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state by ``STATE``; it takes a copy of the session, whose settings are then put back."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    try:
        for key, value in STATE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(events: DataFrame, out: str, checkpoint: str, delay: str = "30 days") -> dict[str, int]:
    """Process what is there and stop: the number of events read, and of those that came behind the watermark."""
    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch}")

    with state_on_disk(events.sparkSession):
        query = (daily_counts(events, delay).writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return {"events": sum(p["numInputRows"] for p in progress), "late": late}


def current(spark: SparkSession, out: str) -> DataFrame:
    """The last counts of each business and day."""
    kinds = "business_id string, date date, review_count long, star_sum " + EXACT + ", star_count long, checkin_count long, batch long"
    latest = Window.partitionBy("business_id", "date").orderBy(F.desc("batch"))
    return (spark.read.schema(kinds).parquet(out).withColumn("_turn", F.row_number().over(latest))
            .where("_turn = 1").drop("_turn", "batch"))
