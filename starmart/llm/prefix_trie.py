"""Prefix trie of conversations, with the totals of every subtree by parallel tree contraction.

Conversations that begin alike share nodes: a node is a distinct sequence of first turns. Its key is the exclusive-or of
128-bit hashes of (depth, role, text) along the way, so keys are formed block by block without one task walking a whole
conversation, and the parent's key is the node's key without its own turn.

Contraction alternates two steps, each a join on node ids. Rake: leaves give their sums to their parents and go.
Compress: of the nodes with one child, those whose random priority of the round is below their child's and their
parent's are spliced out, which takes a third of a chain at a time and never two neighbours; the child inherits the
parent and carries the sums of what lies between. Live nodes shrink by a constant factor a round, so the rounds grow
with the logarithm of the number of nodes and all work together with their number. Expansion runs the rounds backward:
a spliced node's total is its child's total and what it carried then.

Hot places: a range exchange orders the turns, so a long conversation is split; children are counted and summed before
they are exchanged, so a node with countless children meets partial sums only; the ids that end at a node are joined to
texts of up to 4,096 ids before they stream through the node's digest, which has to see them in order.

Defined results: rows without a conversation id take no part; null role or text is empty; null turns come first; rows of
one turn are ordered by role and text; ``c % 5`` has the sign of c; an empty table has no node; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starmart.llm.common import ranked, stored

BLOCK_BITS = 10
PARTS_BITS = 6
KEY = ["depth", "k1", "k2"]
SUMS = ["leaves", "saved"]


# --- turns and their place in the rebuilt conversations

def turns(conversations: DataFrame, share: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """(convs, turns) of the rebuilt conversations.

    A rebuilt conversation has the first ``share`` (8 at most) turns of conversation ``base``, then its own beyond the
    first ``share``; both are expressions over ``conv_id``. convs: conv_id, length, ordinal. turns: conv_id, ordinal, depth,
    x1, x2 (hashes of the turn at its depth), bytes, ends.
    """
    given = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    lengths = given.groupBy("conv_id").agg(F.count("*").alias("n"))
    planned = (lengths.withColumn("base_id", base).withColumn("share", share)
               .join(lengths.select(F.col("conv_id").alias("base_id"), F.col("n").alias("n_base")), "base_id", "left")
               .withColumn("shared", F.least("share", F.coalesce("n_base", F.lit(0))))
               .withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("share"), F.lit(0)))
               .select("conv_id", "base_id", "share", "shared", "length"))
    convs = stored(ranked(planned, [F.col("conv_id")], "ordinal", "trie-convs-range"), "trie-convs")

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    said = F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)
    rows = stored(given.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.unhex(F.substring(said, 1, 32)).alias("said"), F.octet_length("text").cast("long").alias("bytes"),
        F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "trie-rows")
    # A conversation's place in each range it lies in; ranges of a conversation are few, rows are many.
    parts = rows.groupBy("conv_id", "range").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n").join(convs, "conv_id")
    placed = stored(rows.join(parts, ["conv_id", "range"])
                    .withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "first", "before", "range"), "trie-placed")

    columns = ["conv_id", "ordinal", "length", "depth", "said", "bytes"]
    own = (placed.where("place >= share")
           .withColumn("depth", F.col("place") - F.col("share") + F.col("shared") + 1).select(*columns))
    heads = placed.where("conv_id = base_id and place < 8").select("base_id", "place", "said", "bytes")
    borrowed = (convs.where("shared > 0").join(heads, "base_id").where("place < shared")
                .withColumn("depth", F.col("place") + 1).select(*columns))
    depth = F.col("depth")
    return convs.select("conv_id", "length", "ordinal"), own.unionByName(borrowed).select(
        "conv_id", "ordinal", "depth", F.xxhash64(depth, "said").alias("x1"), F.xxhash64("said", depth).alias("x2"), "bytes",
        (depth == F.col("length")).alias("ends"))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with k1, k2: the key of the node that each turn leads to."""
    rows = stored(rows.withColumn("block", F.shiftright("depth", BLOCK_BITS)), "trie-turns")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    xor = lambda c: F.expr(f"bit_xor({c})")
    run = rows.withColumns({"k1": xor("x1").over(inside), "k2": xor("x2").over(inside)})
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy("conv_id", "block").agg(xor("x1").alias("c1"), xor("x2").alias("c2"))
               .withColumns({"c1": xor("c1").over(earlier), "c2": xor("c2").over(earlier)}).where("block > 0"))
    return run.join(carried, ["conv_id", "block"], "left").withColumns(
        {k: F.col(k).bitwiseXOR(F.coalesce(c, F.lit(0))) for k, c in (("k1", "c1"), ("k2", "c2"))}).drop("c1", "c2", "block")


def trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """The nodes: conv_id (smallest member), depth, k1, k2, parent_conv_id, n_convs, bytes (of the last text)."""
    root = (convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
            .select("conv_id", "n_convs", *[F.lit(0).cast("long").alias(c) for c in ("bytes", "depth", "k1", "k2", "p1", "p2")]))
    below = steps.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min("x1").alias("x1"), F.min("x2").alias("x2")).select(
        "conv_id", "n_convs", "bytes", *KEY, F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"))
    nodes = stored(root.unionByName(below), "trie-nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2")


# --- contraction

def with_children(live: DataFrame) -> DataFrame:
    """Live nodes with the number of live children and, for those with one, that child."""
    children = (live.where("up_conv is not null").groupBy("up_conv", "up_depth")
                .agg(F.count("*").alias("children"), F.max(F.struct("conv", "level", *[f"edge_{s}" for s in SUMS])).alias("child"))
                .withColumnsRenamed({"up_conv": "conv", "up_depth": "level"}))
    return live.join(children, ["conv", "level"], "left").fillna(0, ["children"])


def spliced(turn: int) -> Column:
    """True for the nodes that this round's compress step takes out."""
    drawn = lambda conv, level: F.xxhash64(conv, level, F.lit(turn))
    mine = drawn(F.col("conv"), F.col("level"))
    return ((F.col("children") == 1) & F.col("up_conv").isNotNull() & (mine < drawn(F.col("child.conv"), F.col("child.level")))
            & ((F.col("up_depth") == 0) | (mine < drawn(F.col("up_conv"), F.col("up_depth")))))


def subtree_sums(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(children, totals) by node id (conv, level): number of children, and the sums of ``SUMS`` over each subtree.

    ``nodes``: conv_id, depth, parent_conv_id, saved. The sum ``leaves`` counts nodes without a child.
    """
    zero = F.lit(0).cast("long")
    live = nodes.select(
        F.col("conv_id").alias("conv"), F.col("depth").alias("level"), F.col("parent_conv_id").alias("up_conv"),
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"), zero.alias("leaves"), F.col("saved").cast("long").alias("saved"),
        *[zero.alias(f"edge_{s}") for s in SUMS])
    columns, rounds, counted = live.columns, [], None
    while True:
        turn = len(rounds)
        seen = with_children(live)
        if turn == 0:
            seen = seen.withColumn("leaves", (F.col("children") == 0).cast("long"))
        seen = stored(seen.withColumn("out", F.coalesce(spliced(turn), F.lit(False))), "trie-compress")
        if turn == 0:
            counted = seen.select("conv", "level", "children")
        if seen.count() <= 1:
            return counted, expand(seen, rounds)
        gone = seen.where("out")
        heirs = gone.select(
            F.col("child.conv").alias("conv"), F.col("child.level").alias("level"), F.col("up_conv").alias("new_conv"),
            F.col("up_depth").alias("new_depth"), *[(F.col(s) + F.col(f"edge_{s}")).alias(f"new_{s}") for s in SUMS])
        left = seen.where("not out").drop("out", "child").join(heirs, ["conv", "level"], "left")
        inherits = F.col("new_conv").isNotNull()
        left = left.withColumns({
            "up_conv": F.coalesce("new_conv", "up_conv"), "up_depth": F.when(inherits, F.col("new_depth")).otherwise(F.col("up_depth")),
            **{f"edge_{s}": F.col(f"edge_{s}") + F.coalesce(f"new_{s}", zero) for s in SUMS}})
        left = stored(left.withColumn("leaf", (F.col("children") == 0) & F.col("up_conv").isNotNull())
                      .select(*columns, "leaf"), "trie-rake")
        leaf = left.where("leaf")
        given = (leaf.groupBy("up_conv", "up_depth").agg(*[F.sum(F.col(s) + F.col(f"edge_{s}")).alias(f"given_{s}") for s in SUMS])
                 .withColumnsRenamed({"up_conv": "conv", "up_depth": "level"}))
        live = (left.where("not leaf").join(given, ["conv", "level"], "left")
                .withColumns({s: F.col(s) + F.coalesce(f"given_{s}", zero) for s in SUMS}).select(*columns))
        rounds.append((leaf, gone))


def expand(root: DataFrame, rounds: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Totals of all nodes, from the last round to the first."""
    known = root.select("conv", "level", *SUMS)
    for leaf, gone in reversed(rounds):
        known = known.unionByName(leaf.select("conv", "level", *SUMS))
        below = known.select(F.col("conv").alias("child_conv"), F.col("level").alias("child_level"), *[F.col(s).alias(f"below_{s}") for s in SUMS])
        back = gone.select(
            "conv", "level", F.col("child.conv").alias("child_conv"), F.col("child.level").alias("child_level"),
            *[(F.col(s) + F.col(f"child.edge_{s}")).alias(s) for s in SUMS])
        back = back.join(below, ["child_conv", "child_level"]).select("conv", "level", *[(F.col(s) + F.col(f"below_{s}")).alias(s) for s in SUMS])
        known = stored(known.unionByName(back), "trie-expand")
    return known


# --- conversations that end at a node

def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per node of its parts, which come in order."""
    names = [*KEY, "ends_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    node, digest = None, None
    for batch in batches:
        done = []
        for *key, part in zip(*[batch.column(n).to_pylist() for n in (*KEY, "part")]):
            if key != node:
                if digest:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(part.encode())
            else:
                digest.update(b"," + part.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*node, digest.hexdigest()), types)], names)


def endings(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """Node key and the digest of the ids that end there, ascending and joined by commas."""
    zero = [F.lit(0).cast("long").alias(k) for k in KEY]
    ends = steps.where("ends").select(*KEY, "conv_id", "ordinal").unionByName(
        convs.where("length = 0").select(*zero, "conv_id", "ordinal"))
    parts = ends.select(*KEY, F.col("ordinal").alias("at"), F.col("conv_id").cast("string").alias("part"))
    for _ in range(2):  # runs of ordinals, 64 and then 4,096 wide
        parts = (parts.groupBy(*KEY, F.shiftright("at", PARTS_BITS).alias("run"))
                 .agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
                 .select(*KEY, F.col("run").alias("at"), F.array_join("parts.part", ",").alias("part")))
    schema = T.StructType([*[T.StructField(k, T.LongType()) for k in KEY], T.StructField("ends_sha256", T.StringType())])
    return parts.repartition(*KEY).sortWithinPartitions(*KEY, "at").mapInArrow(digests, schema)


def prefix_trie(conversations: DataFrame, share: Column | None = None, base: Column | None = None) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations; by default each begins with the first
    ``crc32(conv_id) % 9`` turns of the conversation whose id is the next lower multiple of five."""
    conv = F.col("conv_id")
    share = F.crc32(conv.cast("string")) % 9 if share is None else share
    convs, steps = turns(conversations, share, conv - conv % 5 if base is None else base)
    steps = stored(keyed(steps), "trie-keyed")
    nodes = stored(trie(convs, steps).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-linked")
    children, totals = subtree_sums(nodes)
    ids = lambda f: f.withColumnsRenamed({"conv": "conv_id", "level": "depth"})
    return (nodes.join(ids(children), ["conv_id", "depth"]).join(ids(totals.withColumnRenamed("saved", "saved_tokens")), ["conv_id", "depth"])
            .join(endings(convs, steps), KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
