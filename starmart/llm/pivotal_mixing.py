"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets the copy rate ``target of its source / size of its source``. The whole part of the rate is
taken as it is. The fractional parts are rounded dependently: a document meets the next one of its source, and words move from
one to the other until the first is taken wholly or not at all. Where the next one alone has too few words to give or
too little room, those after it join its side. The direction is drawn so that each document's chance equals its
fraction, and the words taken by both sides stay the same throughout. Large documents are decided first, so a source
ends with a few small undecided ones and its words differ from the target by less than these.

Documents meet inside blocks of bounded size, drawn by a hash of the document, so a source with a third of all rows
spreads over all blocks. The few documents that a block leaves undecided meet in further rounds
that join ``FAN_IN`` blocks each, a reduction tree whose every round is a distributed grouping.

Defined results: null text counts no words and takes none; a null source is a source of its own, last in order;
an empty table gives an empty result; documents of no words are never undecided; rows with equal ids and sizes are
separate documents; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import ranked, release, stored

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK_ROWS = 2000
FAN_IN = 64

STATE = "doc_key string, doc_id {kind}, source string, size long, source_size long, target double, block long, copies int, mass double, open boolean"


def word_count(text: str):
    """Words between ASCII white space; none for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """source, source_size, target: shares of all sizes by weight, none above ``max_repeat`` times its source.

    ``sizes`` has one row per source. The weights repeat along the sources in code-point order, null last. What a
    source cannot take is shared among the others by weight, again and again until no source is above its limit;
    each turn is one aggregate over the sources and caps at least one more.
    """
    spread = ranked(sizes, [F.col("source").asc_nulls_last()], "position", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    sources = stored(spread.select("source", "source_size", weight.alias("weight"),
                                   (F.col("source_size") * float(max_repeat)).alias("most")), "weights")
    level, total = 0.0, None
    while True:
        capped = F.col("weight") * level > F.col("most") if total is not None else F.lit(False)
        row = sources.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(capped, F.col("most"))).alias("fixed"),
            F.sum(F.when(~capped, F.col("weight"))).alias("free")).first()
        total = float(row["total"] or 0)
        new = (total - (row["fixed"] or 0.0)) / row["free"] if row["free"] else level
        if new <= level:
            break
        level = new
    return stored(sources.select("source", "source_size", F.least(F.col("weight") * level, "most").alias("target")), "targets")


def settle(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Run the pairs of one group, source by source, large documents first; few rows stay open."""
    rows = rows.sort_values(["source", "size", "doc_key"], ascending=[True, False, True], na_position="last", kind="stable").reset_index(drop=True)
    copies, mass, still = rows["copies"].to_numpy().copy(), rows["mass"].to_numpy().copy(), rows["open"].to_numpy().copy()
    size = rows["size"].to_numpy()
    source = rows["source"].where(rows["source"].notna(), None).tolist()
    first = rows["doc_key"].iloc[0] if len(rows) else ""
    draws = np.random.default_rng([seed, len(rows), *first.encode()]).random(len(rows))
    live = np.flatnonzero(still)
    for group in np.split(live, np.flatnonzero([source[i] != source[j] for i, j in zip(live, live[1:])]) + 1) if len(live) else []:
        for at, a in enumerate(group[:-1]):
            later = group[at + 1:]
            need, gift = size[a] - mass[a], mass[a]
            if need <= 1e-9 * size[a] or gift <= 1e-9 * size[a]:
                continue
            # What each later document can give and take, as a share of what a needs and gives.
            able = np.minimum(mass[later] / need, (size[later] - mass[later]) / gift)
            enough = int(np.searchsorted(np.cumsum(able), 1.0)) + 1
            partners, share = later[:enough], able[:enough]
            total = share.sum()
            if total >= 1:
                move = (need if draws[a] * size[a] < mass[a] else -gift) * share / total
                mass[partners] -= move
                mass[a] += move.sum()
                continue
            for b in later:  # too few words are left beside a: pair by pair, and a may stay open
                up, down = min(size[a] - mass[a], mass[b]), min(mass[a], size[b] - mass[b])
                if up + down > 0:
                    move = up if draws[b] * (up + down) < down else -down
                    mass[a] += move
                    mass[b] -= move
        for a in group:
            if mass[a] <= 1e-9 * size[a]:
                still[a], mass[a] = False, 0.0
            elif mass[a] >= size[a] * (1 - 1e-9):
                still[a], mass[a] = False, 0.0
                copies[a] += 1
    rows["copies"], rows["mass"], rows["open"] = copies, mass, still
    return rows


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        max_repeat: float = MAX_REPEAT, seed: int = 17, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: how often the mix takes each document."""
    base = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                              word_count(text).alias("size"),
                              F.sha1(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                                                 F.xxhash64(text).cast("string"),
                                                 F.monotonically_increasing_id().cast("string"))).alias("doc_key")), "sizes")
    per_source = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = source_targets(per_source.select("source", "source_size"), weights, max_repeat)
    blocks = max(1, -(-base.count() // block_rows))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    part = rate - F.floor(rate)
    near = F.when(part > 1 - 1e-12, 1).otherwise(0)
    schema = STATE.format(kind=base.schema["doc_id"].dataType.simpleString())
    names = [field.split()[0] for field in schema.split(", ")]
    state = (
        base.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("block", F.pmod(F.xxhash64("doc_key", F.lit(seed)), F.lit(blocks)))
        .withColumn("copies", (F.floor(rate) + near).cast("int"))
        .withColumn("mass", F.when((part <= 1e-12) | (part > 1 - 1e-12), 0.0).otherwise(part * F.col("size")))
        .withColumn("open", F.col("mass") > 0).select(*names)
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        made = settle(rows, seed)
        release()
        return made

    state = stored(state.groupBy("block").applyInPandas(run, schema), "mix")
    done, left = state.where("not open"), state.where("open")
    while blocks > 1:
        blocks = -(-blocks // fan_in)
        level = stored(left.withColumn("block", F.floor(F.col("block") / fan_in)).withColumn("__source", F.col("source"))
                       .groupBy("__source", "block").applyInPandas(lambda rows: run(rows[names]), schema), "mix")
        done, left = done.unionByName(level.where("not open")), level.where("open")
    # What the root leaves is taken with the chance that is left to it.
    chance = F.pmod(F.xxhash64("doc_key", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    last = left.withColumn("copies", F.col("copies") + (chance * F.col("size") < F.col("mass")).cast("int"))
    return done.unionByName(last).select("doc_id", "source", "size", "source_size", "target", "copies",
                                         (F.col("copies") * F.col("size")).alias("taken"))
