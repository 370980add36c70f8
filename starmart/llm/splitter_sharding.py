"""Sharding by sampled splitters.

The sort key of a document is the hash of its text, so equal texts lie side by side. Keys are sampled with a chance
proportional to the documents' sizes, the sample's quantiles cut the key space into many more ranges than shards,
and every record goes to the range of its key. A key that the sample holds again and again (a large group of copies)
becomes a range of its own. Exact sizes of all ranges are then summed; an overfull range of several keys is cut again
by splitters sampled inside it, and an overfull range of one key is cut into pieces by document. Ranges, whose number
depends on the shard count alone, are dealt to shards: groups too large for one shard fill shards in turn, the rest
goes from the largest to the smallest to the emptiest shard. So sizes are near equal, and equal texts share a shard
unless they exceed one.

Law: ``bytes``. Defined results: null text has the size of the overhead alone and the crc of no bytes; ties and
repeated rows are separate records; null ids are ordinary ids, first in order; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.common import stored

OVERHEAD = 16
RANGES_PER_SHARD = 64
OVERSAMPLE = 16


def in_range(splitters: np.ndarray):
    """Number of splitters at or below a key, as a column function."""
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), side="right").astype(np.int32))
    return find


def draw(rows: DataFrame, sample: int, total: int, seed: int) -> np.ndarray:
    """Keys of about ``sample`` rows, drawn with chances proportional to size by a hash of the row's number; sorted."""
    chance = F.pmod(F.xxhash64("row", "key", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    taken = rows.where(chance * total < F.col("size") * sample).select("key")
    return np.sort(np.array([r["key"] for r in taken.collect()], dtype=np.int64))


def splitters_of(keys: np.ndarray, every: int) -> np.ndarray:
    """Every ``every``-th sampled key; a key met twice in a row is bounded on both sides."""
    picked = keys[every - 1::every]
    again = picked[1:][picked[1:] == picked[:-1]]
    after = again[again < np.iinfo(np.int64).max] + 1
    return np.unique(np.concatenate([picked, after]))


def assign(units: pd.DataFrame, n_shards: int) -> dict[tuple[int, int], int]:
    """Shard of each (range, piece): oversized groups fill shards in turn, then largest first to the emptiest."""
    load = np.zeros(n_shards)
    goal = units["bytes"].sum() / n_shards
    placed: dict[tuple[int, int], int] = {}
    whole = units.groupby("range")["bytes"].sum().sort_values(ascending=False, kind="stable")
    pieces = {r: g for r, g in units.sort_values("piece").groupby("range")}
    for r, size in whole.items():
        shard = int(load.argmin())
        for row in pieces[r].itertuples():
            if size > goal and load[shard] + row.bytes / 2 > goal:
                shard = int(load.argmin())
            placed[(row.range, row.piece)] = shard
            load[shard] += row.bytes
    return placed


def shard(docs: DataFrame, n_shards: int = 40, doc_id: str = "doc_id", text: str = "text", overhead: int = OVERHEAD,
          ranges_per_shard: int = RANGES_PER_SHARD, seed: int = 23) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard")  # stored, so that a retried task sees the same numbers
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    n_ranges = n_shards * ranges_per_shard
    limit = max(1.0, 2.0 * total / n_ranges)
    splitters = splitters_of(draw(rows, n_ranges * OVERSAMPLE, total, seed), OVERSAMPLE) if total else np.array([], np.int64)
    for turn in range(1, 64):
        ranges = rows.withColumn("range", in_range(splitters)("key"))
        sizes = ranges.groupBy("range").agg(F.sum("size").alias("bytes"), F.min("key").alias("low"),
                                            F.max("key").alias("high")).toPandas()  # as many rows as ranges
        over = sizes[(sizes["bytes"] > limit) & (sizes["low"] < sizes["high"])]
        if over.empty:
            break
        inside = ranges.join(F.broadcast(rows.sparkSession.createDataFrame(
            [(int(r),) for r in over["range"]], "range int")), "range")
        keys = draw(inside, n_ranges * OVERSAMPLE, total, seed + turn)
        finer = splitters_of(keys, max(1, OVERSAMPLE // 2 ** turn))
        middle = ((over["low"].astype(object) + over["high"].astype(object) + 1) // 2).astype(np.int64).to_numpy()
        splitters = np.unique(np.concatenate([splitters, finer, middle]))
    heavy = {int(r): int(np.ceil(b / limit * 2)) for r, b in zip(sizes["range"], sizes["bytes"]) if b > limit}
    cuts = rows.sparkSession.createDataFrame(list(heavy.items()), "range int, cuts int")  # at most one row per range
    pieces = ranges.join(F.broadcast(cuts), "range", "left").withColumn(
        "piece", F.when(F.col("cuts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64("row", F.lit(seed)), F.col("cuts"))).cast("int"))
    counts = pieces.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).toPandas()
    counts = counts.sort_values(["range", "piece"]).reset_index(drop=True)
    placed = assign(counts, n_shards)
    counts["shard"] = [placed[k] for k in zip(counts["range"], counts["piece"])]
    counts["start"] = counts.groupby("shard")["n"].cumsum() - counts["n"]
    layout = rows.sparkSession.createDataFrame(
        [(int(r.range), int(r.piece), int(r.shard), int(r.start)) for r in counts.itertuples()],
        "range int, piece int, shard int, start long")
    order = Window.partitionBy("range", "piece").orderBy("key", "doc_id", "row")
    return (pieces.withColumn("__n", F.row_number().over(order)).join(F.broadcast(layout), ["range", "piece"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("__n") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
