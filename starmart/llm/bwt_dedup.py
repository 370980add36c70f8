"""Removal of repeated byte strings by anchors, radix refinement of their contexts, and counts of hashes.

This stands in for merging Burrows-Wheeler transforms of shards: no shard builds a transform.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus. Sorting all suffixes
of a corpus is out of the question, and needless: of each text only sampled suffixes take part. Every stretch of
``SPAN`` positions samples the position whose next ``GRAM`` bytes have the least hash, so equal strings of ``LENGTH``
bytes sample the same position inside them, their anchor, however they lie in their texts.

1. Anchors are counted by a hash of the bytes that every string of the anchor shares. An anchor met once has no
   repeated strings, and with it goes most of the corpus.
2. An anchor's context is all strings it stands for. Contexts met twice as a whole are repeated; each distinct context
   is a sampled suffix (from the anchor on) with what precedes it, as a transform's column would give it.
3. Distinct contexts of one anchor meet in a task, unsorted, and are sorted by a radix sort from the first byte on:
   eight bytes a turn, rows that still agree are parted by the next eight, and where neighbours part is their common
   prefix. What precedes the anchor is sorted the same way, from the anchor backwards. A string that starts n bytes
   before the anchor is repeated where an interval of rows with a common prefix of ``LENGTH - n`` holds two rows that
   also agree in the n bytes before. No pair of rows is compared.
4. An anchor with more than ``HOT`` distinct contexts, such as the edge of a very common passage, is not brought
   together: its strings are counted with partial counts, which gives the same answer. They are taken in buckets of
   ``STEP`` neighbours first: a bucket whose whole stretch is met twice is repeated, one whose common part is met once
   is not, and only the strings of the few buckets in between are counted one by one.

Rows of equal texts are told by a 64-bit hash and the length, and carry one verdict. Contexts are compared by two
64-bit hashes made with different bases, strings in step 3 byte by byte.

Defined results: null text is empty; a text shorter than ``LENGTH`` keeps all its bytes; equal rows repeat each other;
rows with equal or null ids are separate texts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from starmart.llm.common import mix64, stored
from starmart.llm.words import BASE, BYTE, INVERSE, power, raw, slices

LENGTH, SPAN, GRAM = 400, 192, 32
SHARED = LENGTH - SPAN + 1
HOT = 256
STEP = 24
BLOCK = 4096
BASE2 = 0x2545F4914F6CDD1D
INVERSE2 = pow(BASE2, -1, 1 << 64)
HIGH = np.uint64(0xFFFFFFFF00000000)


class Hashed:
    """Hashes of any stretch of some bytes, from running sums."""

    def __init__(self, data: np.ndarray, base: int, inverse: int):
        value = BYTE[data]
        value *= power(base, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value, out=self.sums[1:])
        self.inverse = power(inverse, len(data) + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))


def anchors(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of texts that lie one after another: text, place in it, range of string starts before it, two hashes."""
    n = len(data)
    first = Hashed(data, BASE, INVERSE)
    grams = mix64((first.sums[GRAM:] - first.sums[:n + 1 - GRAM]) * first.inverse[:n + 1 - GRAM])
    least = (grams & HIGH) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:len(least) - (SPAN - width)], least[SPAN - width:])
    room = np.maximum(np.diff(at) - LENGTH + 1, 0)  # string starts in each text
    text = np.repeat(np.arange(len(room)), room)
    start = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room) + at[text]
    anchor = (least[start] & ~HIGH).astype(np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(start)) - 1
    a, low, high = anchor[begin], start[begin], start[end]
    context = Hashed(data, BASE2, INVERSE2).of(low, high + LENGTH)
    return {"text": text[begin], "pos": a - at[text[begin]], "lo": a - high, "hi": a - low,
            "a": first.of(a, a + SHARED).view(np.int64), "c": mix64(context ^ (a - low).astype(np.uint64)).view(np.int64)}


def refine(words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by group and then by their words, and the bytes each row shares with the one before (-1: other group).

    The rows of a group come in any order and are sorted a word at a time; only rows that still have a neighbour like
    them take part.
    """
    order = np.argsort(groups, kind="stable")
    n = len(order)
    common = np.full(n, -1, np.int64)
    same = groups[order][1:] == groups[order][:-1]
    common[1:][same] = words.shape[1] * 8  # until a word parts them
    block = np.concatenate([[0], np.cumsum(~same)])
    for k in range(words.shape[1]):
        tied = np.zeros(n, bool)
        tied[1:] = block[1:] == block[:-1]
        tied[:-1] |= tied[1:]
        live = np.flatnonzero(tied)
        if not len(live):
            break
        value = words[order[live], k]
        moved = np.lexsort((value, block[live]))
        order[live], value = order[live][moved], value[moved]
        mine = block[live]
        parts = np.zeros(len(live), bool)
        parts[1:] = (mine[1:] == mine[:-1]) & (value[1:] != value[:-1])
        differ = value[1:] ^ value[:-1]
        shared = sum((differ < np.uint64(1 << (64 - 8 * b))).astype(np.int64) for b in range(1, 8))
        at = live[parts]
        common[at] = 8 * k + shared[parts[1:]]
        cut = np.zeros(n, bool)
        cut[1:] = block[1:] != block[:-1]
        cut[at] = True
        block = np.cumsum(cut)
    return order, common


def as_words(parts: list[bytes], width: int) -> np.ndarray:
    """Rows of big-endian words, filled with zeros."""
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), ">u8").reshape(len(parts), -1).astype(np.uint64)


def repeated(groups: np.ndarray, lo: np.ndarray, hi: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For each context and n below SPAN: does the string from n bytes before the anchor lie in another context too?"""
    m = len(contexts)
    after = as_words([c[h:] for c, h in zip(contexts, hi)], LENGTH)
    before = as_words([c[:h][::-1] for c, h in zip(contexts, hi)], SPAN)
    by_after, prefix = refine(after, groups)
    by_before, suffix = refine(before, groups)
    found = np.zeros((m, SPAN), bool)
    right, left = np.empty(m, np.int64), np.empty(m, np.int64)
    for n in range(SPAN):
        mine = np.flatnonzero((lo <= n) & (n <= hi))
        if len(mine) < 2:
            continue
        right[by_after] = np.cumsum(prefix < LENGTH - n)
        left[by_before] = np.cumsum(suffix < n)
        key = right[mine] * (m + 1) + left[mine]
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(mine), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        found[mine[order[twice]], n] = True
    return found


ANCHORS = "key long, size long, pos long, lo long, hi long, a long, c long"
VERDICT = "a long, c long, marks binary"


def find_anchors(batches):
    for batch in batches:
        for i, j in slices(batch.column(2)):
            data, at = raw(batch.column(2).slice(i, j - i))
            if len(data) < LENGTH:
                continue
            found = anchors(data, at)
            of = pa.array(found.pop("text") + i)
            yield from pa.table([batch.column(0).take(of), batch.column(1).take(of), *map(pa.array, found.values())],
                                ["key", "size", *found]).to_batches()


def cut_contexts(batches):
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            body = text.encode()
            out += [(w["a"], w["c"], w["lo"], w["hi"], w["hot"], body[w["pos"] - w["hi"]:w["pos"] - w["lo"] + LENGTH]) for w in wanted]
        kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["a", "c", "lo", "hi", "hot", "context"])


def merge_runs(batches):
    """Rows come ordered by anchor; whole anchors are gathered to blocks of bounded size."""
    held: list[tuple] = []

    def flush(rows):
        a, c, lo, hi = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        found = repeated(np.unique(a, return_inverse=True)[1], lo, hi, [r[4] for r in rows])
        some = np.flatnonzero(found.any(axis=1))
        marks = [np.packbits(found[i]).tobytes() for i in some]
        return pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(c[some]), pa.array(marks, pa.binary())], ["a", "c", "marks"])

    for batch in batches:
        held += zip(*(batch.column(k).to_pylist() for k in ("a", "c", "lo", "hi", "context")))
        while len(held) > BLOCK:
            at = BLOCK
            while at and held[at - 1][0] == held[at][0]:
                at -= 1
            if not at:
                break
            yield flush(held[:at])
            held = held[at:]
    if held:
        yield flush(held)


def bucket_hashes(batches):
    """Buckets of the contexts' strings: hashes of what all strings of a bucket share, and of all that they cover."""
    for batch in batches:
        for a, c, lo, hi, context in zip(*(batch.column(k).to_pylist() for k in ("a", "c", "lo", "hi", "context"))):
            data = np.frombuffer(context, np.uint8)
            bucket = np.arange(lo // STEP, hi // STEP + 1)
            low, high = np.maximum(bucket * STEP, lo), np.minimum(bucket * STEP + STEP - 1, hi)
            one, two = Hashed(data, BASE, INVERSE), Hashed(data, BASE2, INVERSE2)
            shared = one.of(hi - bucket * STEP, hi + LENGTH - (bucket + 1) * STEP + 1).view(np.int64)
            whole = [h.of(hi - high, hi + LENGTH - low).view(np.int64) for h in (one, two)]
            n = len(bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.full(n, a), np.full(n, c), low, high, shared, *whole)], ["a", "c", "low", "high", "shared", "h1", "h2"])


def window_hashes(batches):
    """One row per string of the contexts between ``low`` and ``high``."""
    for batch in batches:
        for a, c, hi, context, low, high in zip(*(batch.column(k).to_pylist() for k in ("a", "c", "hi", "context", "low", "high"))):
            data = np.frombuffer(context, np.uint8)
            start = np.arange(hi - high, hi - low + 1)
            one, two = (Hashed(data, b, i).of(start, start + LENGTH).view(np.int64) for b, i in ((BASE, INVERSE), (BASE2, INVERSE2)))
            n = len(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, a)), pa.array(np.full(n, c)), pa.array(hi - start), pa.array(one), pa.array(two)], ["a", "c", "n", "h1", "h2"])


def marks_of(batches):
    for batch in batches:
        marks = []
        for places in batch.column(2).to_pylist():
            bits = np.zeros(SPAN, bool)
            bits[places] = True
            marks.append(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.binary())], ["a", "c", "marks"])


def removed_runs(text: bytes, anchors: list[dict]) -> list[tuple[int, int]]:
    """Stretches covered by repeated strings."""
    edge = np.zeros(len(text) + 1, np.int64)
    for x in anchors:
        n = np.arange(x["lo"], x["hi"] + 1)
        if x["marks"] is not None:
            n = n[np.unpackbits(np.frombuffer(x["marks"], np.uint8))[n] > 0]
        edge[x["pos"] - n] += 1
        edge[x["pos"] - n + LENGTH] -= 1  # distinct places, so each counts once
    inside = np.cumsum(edge) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    return list(zip(change[::2].tolist(), change[1::2].tolist()))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, text: what is left of each text.

    ``kept`` has its bytes (null where it is the whole text), ``text`` the same as a string; where a run ends inside a
    character, the bytes left of it show as replacement characters.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(body).alias("key"), F.octet_length(body).cast("long").alias("size"), body.alias("text"),
                       F.col(doc_id).alias("doc_id"))
    every = stored(rows.where(F.col("size") >= LENGTH).select("key", "size", "text").mapInArrow(find_anchors, ANCHORS), "anchors")
    twice = stored(every.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "twice")
    # Stored before grouping, so that adaptive execution can split the join's hot anchors.
    # No side of these joins has a bound on its size, so none may be broadcast.
    met = stored(every.join(twice.hint("merge"), "a"), "candidates")
    met = stored(met.groupBy("key", "size", "a", "c", "pos", "lo", "hi").agg(F.count("*").alias("n")), "met")

    contexts = stored(met.groupBy("a", "c", "lo", "hi").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "size", "pos")).alias("at")), "contexts")
    several = stored(contexts.groupBy("a").agg(F.count("*").alias("d"), F.min("n").alias("least")).where("d > 1 and least = 1"), "several")
    wanted = (contexts.join(several.hint("merge"), "a").select("a", "c", "lo", "hi", (F.col("d") > HOT).alias("hot"), "at.*")
              .groupBy("key", "size").agg(F.collect_list(F.struct("a", "c", "lo", "hi", "hot", "pos")).alias("wanted")))
    keys = stored(met.select("key", "size").distinct().withColumn("met", F.lit(True)), "keys")
    texts = stored(rows.join(keys.hint("merge"), ["key", "size"], "left").select(
        "doc_id", "key", "size", "text", "met", F.when(F.col("met").isNull(), F.sha2(F.col("text"), 256)).alias("sha"))
        .withColumn("row", F.monotonically_increasing_id()), "texts")
    touched = texts.where("met")
    one = touched.groupBy("key", "size").agg(F.min("row").alias("row"))
    runs = stored(touched.join(one.join(wanted.hint("merge"), ["key", "size"]).select("row", "wanted").hint("merge"), "row").select("text", "wanted")
                  .mapInArrow(cut_contexts, "a long, c long, lo long, hi long, hot boolean, context binary"), "runs")
    merged = (runs.where("not hot").select("a", "c", "lo", "hi", "context").repartition("a").sortWithinPartitions("a", "c")
              .mapInArrow(merge_runs, VERDICT))
    hot = runs.where("hot").select("a", "c", "lo", "hi", "context")
    buckets = stored(hot.mapInArrow(bucket_hashes, "a long, c long, low long, high long, shared long, h1 long, h2 long"), "buckets")

    def met_twice(frame: DataFrame, by: list[str]) -> DataFrame:
        return stored(frame.groupBy(*by).agg(F.count("*").alias("t")).where("t > 1").drop("t"), "again")

    whole = ["a", "low", "high", "h1", "h2"]
    # One of the contexts that share a whole bucket stands for them; of the others each stands for itself.
    classes = stored(buckets.groupBy(*whole, "shared").agg(F.count("*").alias("t"), F.min("c").alias("c")), "classes")
    full = stored(buckets.select("a", "c", "low", "high", "h1", "h2").join(
        classes.where("t > 1").select(*whole).hint("merge"), whole), "full")
    stretch = ["a", "bucket", "shared"]
    numbered = classes.withColumn("bucket", F.floor(F.col("low") / STEP))
    between = stored(numbered.groupBy(*stretch).agg(F.count("*").alias("n"), F.min("t").alias("least")).where("n > 1 and least = 1")
                     .select(*stretch), "between")
    partly = numbered.join(between.hint("merge"), stretch).select("a", "c", "low", "high")
    strings = stored(hot.join(stored(partly, "partly").hint("merge"), ["a", "c"]).select("a", "c", "hi", "context", "low", "high")
                     .mapInArrow(window_hashes, "a long, c long, n long, h1 long, h2 long"), "strings")
    each = ["a", "n", "h1", "h2"]
    places = strings.join(met_twice(strings, each).hint("merge"), each).select("a", "c", F.array("n").alias("at")).unionByName(
        full.select("a", "c", F.sequence("low", "high").alias("at")))
    counted = (places.groupBy("a", "c").agg(F.flatten(F.collect_list("at")).alias("places")).mapInArrow(marks_of, VERDICT))
    marks = stored(merged.unionByName(counted), "marks")
    verdict = stored(contexts.join(marks.hint("merge"), ["a", "c"], "left").where("n > 1 or marks is not null").select(
        "a", "c", F.when(F.col("n") == 1, F.col("marks")).alias("marks")), "verdict")
    per_text = stored(met.join(verdict.hint("merge"), ["a", "c"]).groupBy("key", "size").agg(
        F.collect_list(F.struct("pos", "lo", "hi", "marks")).alias("anchors")), "spans")

    schema = StructType([rows.schema["doc_id"], *[StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                         StructField("kept_sha256", StringType()), StructField("kept", BinaryType()), StructField("text", StringType())])
    arrow = to_arrow_schema(schema)

    def cut(batches):
        for batch in (b.slice(x, y - x) for b in batches for x, y in slices(b.column(1))):
            out = []
            for t, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                whole = t.encode()
                spans = removed_runs(whole, found or [])
                edges = [0, *(x for s in spans for x in s), len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(whole), len(whole) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            kept if spans else None, kept.decode(errors="replace") if spans else t))
            columns = [pa.array([r[k] for r in out], f.type) for k, f in zip(range(6), list(arrow)[1:])]
            yield from pa.Table.from_arrays([batch.column(0), *columns], names=schema.names).cast(arrow).to_batches()

    changed = touched.join(per_text.hint("merge"), ["key", "size"], "left").select("doc_id", "text", "anchors").mapInArrow(cut, schema)
    zero = F.lit(0).cast("long")
    same = texts.where("met is null").select("doc_id", F.col("size").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                                              F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"), "text")
    return changed.unionByName(same)
