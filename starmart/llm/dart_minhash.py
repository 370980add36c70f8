"""Near-duplicates by DartMinHash.

A text is a weighted set of five-word shingles. Imagine the plane of weight and rank of each shingle: darts fall on it
at random, one per unit of area on average, at places that a hash of the shingle fixes. The darts below a shingle's
weight are those it throws. A dart's hash names one of ``DARTS`` coordinates, and each coordinate keeps its earliest
dart, the one of least rank. Two sets keep the same dart with a chance equal to their weighted Jaccard similarity.
Only darts up to a rank at which all coordinates are expected to be filled are thrown, about ``DARTS * ln(DARTS)`` in
all however many shingles there are; where a coordinate stays empty the rank is raised. To enumerate the darts, weights
are cut into dyadic slabs and ranks into cells of unit area in each slab; a cell holds a Poisson number of darts.

Sets with equal signatures in one of ``BANDS`` bands of ``ROWS`` coordinates are candidates. A pair of similarity 0.8
shares no band with a chance of 5e-8. Equal sets are joined first, by a 128-bit digest, and stand for all their
copies. First every set is compared with the centre of each of its buckets only, the set that shares most buckets. Buckets
whose sets are then still in several components are taken up again: small ones compare all pairs of different
components, large ones compare with a centre outside the first component. The sets of large buckets that are still in
several components after that are joined exactly, so every pair that shares a bucket is either in one component or
compared. Pairs are decided by the similarity of
their shingles' hashes, 32 bits each; a class is a connected component.

The exact join orders each set's shingles from rare to common. The first shingle that two similar sets share lies among
the first ``(1 - t) n + 1`` of the larger set and the first ``(1 - t) / (1 + t) n + 1`` of the smaller, so only sets that
agree there, at places that leave enough shingles to share, are compared. Texts of one template differ in their rare
shingles and do not meet unless they are close to the limit. Any order common to all sets is exact; counts in ``CELLS``
cells are close enough. A hot shingle's sets are dealt in blocks of ``BLOCK``.

A hot centre's comparisons are split into chunks, and no group is collected.

Defined results: null, empty and wordless texts are nobody's duplicates, each a class of its own; shorter texts than
five words are one shingle of all their words; a class is named by its least document id (nulls last); documents with
a null id can be members; repeated rows are copies of each other; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from starmart.llm.common import bucketed, mix64, releasing, stored, unit
from starmart.llm.graph import components
from starmart.llm.words import shingles, slices, words

DARTS, BANDS, ROWS = 128, 32, 4
WORDS = 5
SIMILAR = 0.8
SMALL = 16
CHUNK = 64
CELLS = 1 << 18
BLOCK = 256
TOGETHER = 128

POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, n + 1, dtype=float)) for n in range(16)])
ODD = np.uint64(0x9E3779B97F4A7C15)


def darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, limits: np.ndarray, k: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, coordinate, rank and hash of every dart up to its owner's rank limit and below its element's weight."""
    found = []
    slab, low, width = 0, 0.0, 1.0
    while True:
        in_slab = np.flatnonzero(weights > low)
        if not len(in_slab):
            break
        cells = np.ceil(limits[owner[in_slab]] * width).astype(np.int64)
        element = np.repeat(in_slab, cells)
        cell = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mix64(elements[element] ^ mix64(cell.astype(np.uint64) * ODD + np.uint64(slab)))
        count = np.searchsorted(POISSON, unit(seed), side="right")
        which = np.repeat(np.arange(len(element)), count)
        number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix64(seed[which] + (number.astype(np.uint64) + np.uint64(1)) * ODD)
        rank = (cell[which] + unit(mix64(dart ^ np.uint64(1)))) / width
        keep = rank <= limits[owner[element[which]]]
        if slab or (weights[in_slab] < 1).any():
            keep &= low + unit(mix64(dart ^ np.uint64(2))) * width < weights[element[which]]
        found.append((owner[element[which]][keep], rank[keep], dart[keep]))
        slab, low, width = slab + 1, low + width, low + width
    owners, ranks, hashes = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64))
    return owners, (hashes >> np.uint64(33)).astype(np.int64) % k, ranks, hashes


def signatures(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, k: int = DARTS) -> np.ndarray:
    """One row of ``k`` dart hashes per set; ``counts`` gives the number of elements of each set, none empty.

    However short, a set throws about ``k * ln(k)`` darts, so sets are taken ``TOGETHER`` at a time.
    """
    ends = np.cumsum(counts)
    made = [np.zeros((0, k), np.uint64)]
    for i in range(0, len(counts), TOGETHER):
        some = counts[i:i + TOGETHER]
        part = slice(int(ends[i] - counts[i]), int(ends[i + len(some) - 1]))
        made.append(earliest(elements[part], weights[part], some, k))
    return np.concatenate(made)


def earliest(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """``signatures`` of a few sets, all darts of which are held at once."""
    sets = len(counts)
    owner = np.repeat(np.arange(sets), counts)
    total = np.bincount(owner, weights, minlength=sets)
    limit = k * (np.log(k) + 3) / total
    best, kept = np.full(sets * k, np.inf), np.zeros(sets * k, np.uint64)
    todo = np.ones(sets, bool)
    while todo.any():
        mine = todo[owner]
        owners, coordinate, rank, dart = darts(elements[mine], weights[mine], owner[mine], limit, k)
        at = owners * k + coordinate
        np.minimum.at(best, at, rank)
        first = rank == best[at]
        kept[at[first]] = dart[first]
        todo = np.isinf(best).reshape(sets, k).any(axis=1)
        limit = limit * 2
    return kept.reshape(sets, k)


def weighted(texts: pa.Array, size: int, by_count: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, their weights, and how many each text has."""
    made, counts = shingles(*words(texts), size)
    if not len(made):
        return made, np.zeros(0), counts
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((made, owner))
    made, owner = made[order], owner[order]
    first = np.ones(len(made), bool)
    first[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    weights = np.diff(np.append(at, len(made))).astype(float) if by_count else np.ones(len(at))
    return made[at], weights, np.bincount(owner[at], minlength=len(counts))


def digests(made: np.ndarray, weights: np.ndarray, counts: np.ndarray, by_count: bool) -> list[bytes | None]:
    """128 bits that name each set; null for the empty one."""
    ends = np.cumsum(counts)
    data, heavy = made.tobytes(), weights.astype("<u4").tobytes() if by_count else b""
    return [hashlib.blake2b(data[8 * (e - n):8 * e] + heavy[4 * (e - n):4 * e], digest_size=16).digest() if n else None
            for e, n in zip(ends.tolist(), counts.tolist())]


def set_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, by_count: bool = False) -> DataFrame:
    """doc_id, key: the digest of each document's set, null without words."""
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([inner.schema["doc_id"], StructField("key", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                keys = digests(*weighted(batch.column(1).slice(a, b - a), size, by_count), by_count)
                yield from pa.table([batch.column(0).slice(a, b - a), pa.array(keys, pa.binary())], schema.names).cast(arrow).to_batches()
    return inner.mapInArrow(releasing(run), schema)


def sketch(docs: DataFrame, text: str = "text", size: int = WORDS, by_count: bool = False) -> DataFrame:
    """key, bands, shingles (32 bits each) and their weights if counted: one row for each text that has words."""
    inner = docs.select(F.col(text).alias("text"))
    schema = StructType([StructField("key", BinaryType()), StructField("bands", ArrayType(LongType())),
                         StructField("shingles", BinaryType()), StructField("weights", BinaryType())])
    salt = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(0)):
                made, weights, counts = weighted(batch.column(0).slice(a, b - a), size, by_count)
                keys = [key for key in digests(made, weights, counts, by_count) if key]
                counts = counts[counts > 0]
                sig = signatures(made, weights, counts)
                band = np.tile(salt, (len(counts), 1))
                for row in range(ROWS):
                    band = mix64(band * ODD + sig.reshape(-1, BANDS, ROWS)[:, :, row])
                data, heavy = (made >> np.uint64(32)).astype("<u4").tobytes(), weights.astype("<u4").tobytes() if by_count else b""
                parts = [slice(4 * (e - n), 4 * e) for e, n in zip(np.cumsum(counts).tolist(), counts.tolist())]
                bands = pa.ListArray.from_arrays(np.arange(len(counts) + 1, dtype=np.int32) * BANDS, pa.array(band.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.binary()), bands, pa.array([data[p] for p in parts], pa.binary()),
                    pa.array([heavy[p] for p in parts], pa.binary())], schema.names)
    return inner.mapInArrow(releasing(run), schema)


def jaccard(a: bytes, b: bytes, wa: bytes = b"", wb: bytes = b"", least: float = 0.0) -> float:
    """Similarity of two sorted sets; with weights, shared minima over maxima. 0 where sizes alone keep it below ``least``."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    if not wa:
        if min(len(x), len(y)) < least * max(len(x), len(y)):
            return 0.0
        both = len(np.intersect1d(x, y))
        return both / (len(x) + len(y) - both)
    u, v = np.frombuffer(wa, "<u4"), np.frombuffer(wb, "<u4")
    _, i, j = np.intersect1d(x, y, return_indices=True)
    low = np.minimum(u[i], v[j]).sum()
    return low / (u.sum(dtype=np.int64) + v.sum(dtype=np.int64) - low)


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs of at least the given similarity, as links (a, b).

    The end that meets more sets is the centre, and is sent once per chunk of them; so no set is sent often as a member.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    many = stored(ends.groupBy("node").agg(F.count("*").alias("n")), "fan")
    for end in ("a", "b"):
        pairs = pairs.join(many.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}")), end)
    turned = F.col("n_b") > F.col("n_a")
    chunked = stored(pairs.select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.greatest("n_a", "n_b").alias("n")).withColumn("chunk", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CHUNK)))
        .select("a", "chunk", "b"), "chunks")
    members = chunked.join(sets.withColumnRenamed("key", "b"), "b").select("a", "chunk", F.lit(1).alias("kind"), "b", "shingles", "weights")
    centres = (chunked.select("a", "chunk").distinct().join(sets.withColumnRenamed("key", "a"), "a")
               .select("a", "chunk", F.lit(0).alias("kind"), F.col("a").alias("b"), "shingles", "weights"))
    rows = members.unionByName(centres).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "kind")

    def run(batches):
        centre, own, weight = None, b"", b""
        for batch in (b.slice(i, j - i) for b in batches for i, j in slices(b.column(4))):
            links = []
            for a, kind, b, s, w in zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "b", "shingles", "weights"))):
                if kind == 0:
                    centre, own, weight = a, s, w
                elif a == centre and jaccard(own, s, weight, w, similar) >= similar:
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], ["a", "b"])
    return rows.mapInArrow(releasing(run), "a binary, b binary")


def tokens(shingles: bytes, weights: bytes) -> np.ndarray:
    """A sorted set as 64-bit tokens, a repeated shingle once per repeat: sets share as many as their minima add up to."""
    x = np.frombuffer(shingles, "<u4").astype(np.uint64)
    if weights:
        x = np.repeat(x, np.frombuffer(weights, "<u4"))
    repeat = np.arange(len(x)) - np.searchsorted(x, x)
    return mix64(x | repeat.astype(np.uint64) << np.uint64(32))


def cells(made: np.ndarray) -> np.ndarray:
    return (made >> np.uint64(32)).astype(np.int64) % CELLS


def close_pairs(sets: DataFrame, similar: float) -> DataFrame:
    """a, b: pairs of different labels that may be similar, among them all that are. ``sets`` has key, label, shingles, weights."""
    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for s, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.add.at(total, cells(tokens(s, w)), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["cell", "n"])

    often = np.zeros(CELLS, np.int64)
    counted = sets.select("shingles", "weights").mapInArrow(releasing(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    often[counted["cell"]] = counted["n"]  # no more rows than cells

    def prefixes(batches):
        def rows(batch, taken, held):
            which = pa.array(np.repeat(taken, [len(h[0]) for h in held]))
            token, place, size, leads = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([
                pa.array(token.view(np.int64)), batch.column(0).take(which), batch.column(1).take(which),
                pa.array(size), pa.array(place), pa.array(leads)], ["token", "key", "label", "size", "place", "leads"])

        for batch in batches:
            taken, held, n_held = [], [], 0
            for i, (s, w) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                made = tokens(s, w)
                n = len(made)
                # As the larger set of a pair, and as the smaller one.
                long = n - int(np.ceil(similar * n - 1e-6)) + 1
                short = n - int(np.ceil(2 * similar / (1 + similar) * n - 1e-6)) + 1
                made = made[np.lexsort((made, often[cells(made)]))[:long]]
                place = np.arange(len(made))
                taken.append(i)
                held.append((made, place, np.full(len(made), n), place < short))
                n_held += len(made)
                if n_held >= 1 << 16:
                    yield rows(batch, taken, held)
                    taken, held, n_held = [], [], 0
            if held:
                yield rows(batch, taken, held)

    found = stored(sets.select("key", "label", "shingles", "weights").mapInArrow(
        releasing(prefixes), "token long, key binary, label binary, size long, place long, leads boolean"), "prefixes")
    shared = found.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("leads").alias("n_short"), F.min("label").alias("low"), F.max("label").alias("high"))
    shared = shared.where("n_short > 0 and low < high").select(
        "token", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n_short") / BLOCK).cast("int").alias("short_blocks"))
    lists = stored(found.join(shared, "token"), "lists")

    def dealt(rows: DataFrame, name: str, own: str, other: str) -> DataFrame:
        """Rows of a token in blocks of their own, one copy for each block of the other side."""
        mine, theirs = F.pmod(F.xxhash64("key"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        long, short = (mine, theirs) if own == "blocks" else (theirs, mine)
        return rows.select("token", long.alias("i"), short.alias("j"), *[F.col(c).alias(f"{name}_{c}") for c in ("key", "label", "size", "place")])

    longer = dealt(lists, "a", "blocks", "short_blocks")
    shorter = dealt(lists.where("leads"), "b", "short_blocks", "blocks")
    share = similar / (1 + similar)
    return longer.join(shorter, ["token", "i", "j"]).where(
        (F.col("a_label") != F.col("b_label"))
        & ((F.col("a_size") > F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a_key") > F.col("b_key"))))
        & (F.col("b_size") >= similar * F.col("a_size") - 1e-6)
        # What follows this shingle in both sets, if it is the first they share, must be enough.
        & (F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
           >= share * (F.col("a_size") + F.col("b_size")) - 1e-6)
    ).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR, size: int = WORDS,
            by_count: bool = False) -> DataFrame:
    """doc_id, class_id, copies of the class, and a flag on the one document of each class to keep."""
    names = stored(set_keys(docs, doc_id, text, size, by_count).withColumn("row", F.monotonically_increasing_id()), "names")
    # One grouping on the sets' keys, combined before the shuffle: copies of a text never travel with their shingles. The
    # sets stay in the buckets it dealt them to, so pairs go to the shingles and not the shingles to the pairs.
    grouped = sketch(docs, text, size, by_count).groupBy("key").agg(*[F.any_value(c).alias(c) for c in ("bands", "shingles", "weights")])
    with bucketed(grouped, "key", "keys") as keys:
        label = linked(keys, similar)
    spread = names.join(label, F.col("key") == F.col("node"), "left")
    own = F.concat(F.lit("row"), F.col("row").cast("string")).cast("binary")
    group = stored(spread.select("doc_id", "row", F.coalesce("label", "key", own).alias("group")), "groups")
    least = group.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count("*").alias("class_size"))
    return (group.join(stored(least, "classes"), "group")
            .select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
                    (F.col("row") == F.col("first.row")).alias("keep")))


def linked(keys: DataFrame, similar: float) -> DataFrame:
    """node, label: the sets that are similar to another, and the least key of their class. ``keys`` has key, bands, shingles, weights."""
    members = keys.select("key", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(sizes, "band"), "members")
    # The set that shares buckets with most others is the likeliest to be near all of them: the text others were made from.
    central = members.groupBy("key").agg(F.sum("size").alias("reach"))
    members = stored(members.join(central, "key"), "buckets")
    sets = keys.select("key", "shingles", "weights")
    links, label, tried = None, None, None
    for turn in ("centres", "open", "exact"):
        if label is None:
            open_members = members.withColumn("label", F.col("key"))
        else:
            named = members.join(label, F.col("key") == F.col("node"), "left").select(
                "band", "key", "size", "reach", F.coalesce("label", "key").alias("label"))
            split = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
            open_members = stored(named.join(split.select("band"), "band", "left_semi"), "open")

        def centres(order) -> DataFrame:
            best = open_members.groupBy("band").agg(F.min(F.struct(
                order.alias("order"), F.col("key").alias("centre"), F.col("label").alias("of"))).alias("c"))
            return stored(best.select("band", "c.centre", "c.of"), "centres")

        def starred(rows: DataFrame, centre: DataFrame) -> DataFrame:
            return rows.join(centre, "band").where("label != of").select(F.col("centre").alias("a"), F.col("key").alias("b"))

        if turn == "centres":
            near = starred(open_members, centres(-F.col("reach")))
        elif turn == "exact":
            large = open_members.where(F.col("size") > SMALL).select("key", "label").distinct()
            large = stored(large.join(sets, "key"), "large")
            if large.isEmpty():
                break
            near = close_pairs(large, similar)
        else:  # the most central set outside the component of the first centre
            first = centres(-F.col("reach")).select("band", F.col("of").alias("main"))
            open_members = stored(open_members.join(first, "band"), "open")
            centre = centres(F.struct((F.col("label") == F.col("main")).alias("own"), (-F.col("reach")).alias("reach")))
            near = starred(open_members.where(F.col("size") > SMALL), centre)
            other = open_members.where(F.col("size") <= SMALL)
            near = near.union(other.select("band", F.col("key").alias("a"), F.col("label").alias("la"))
                              .join(other.select("band", F.col("key").alias("b"), F.col("label").alias("lb")), "band")
                              .where("la != lb and a < b").select("a", "b"))
        pairs = near.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b").groupBy("x", "y").agg(
            F.first("a").alias("a"), F.first("b").alias("b"))
        pairs = pairs.select("a", "b", "x", "y")
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs.select("x", "y") if tried is None else tried.union(pairs.select("x", "y"))
        new = stored(verified(pairs.select("a", "b"), sets, similar), "links")
        grew = not new.isEmpty()
        links = new if links is None else links.union(new)
        if grew:
            label = components(links)
    if label is None:
        label = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return label
