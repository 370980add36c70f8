"""Document fingerprints by one-permutation MinHash, as column expressions only.

Each shingle of five words is hashed once. The top bits of the hash name one of ``BINS`` bins, and a bin keeps its least
hash. An empty bin copies from the first occupied bin of a random order of its own (optimal densification): a few
probes by hash, and for the rare bins still empty the occupied bin with the least hash of the two numbers, which ends
the same order. Of each bin the lowest eight bits are stored, as two hexadecimal digits. Two fingerprints agree in a
bin by chance once in 256 times, so their likeness is the share of equal bins corrected for that.

The next document is found without one task seeing all: ids are cut into buckets at quantiles, each bucket also gets
the first document of the bucket after it, and a window runs inside buckets. The quantiles and first ids, two values
per bucket and at most ``MAX_BUCKETS`` buckets, are all that the driver sees.

Defined results: null text is empty; a text without words has an empty fingerprint, like to another empty one by 1 and
to others by 0; a text of fewer than five words is one shingle; documents with equal ids follow each other by text,
null ids come last, and a sole document is its own next; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 256
BITS = 8
PROBES = 6
WORDS = 5
BUCKET_ROWS = 4000
MAX_BUCKETS = 1 << 16


def let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def shingle_hashes(text: Column, size: int = WORDS) -> Column:
    """64-bit hashes of all runs of ``size`` words."""
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")

    def runs(h: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(h) - size),
                              lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))
        return (F.when(F.size(h) >= size, several).when(F.size(h) > 0, F.array(F.xxhash64(h)))
                .otherwise(F.array().cast("array<bigint>")))
    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def bin_of(value: Column) -> Column:
    """0 to 255, in the order of the signed values."""
    return F.shiftright(value, 56) + 128


def bins(text: Column) -> Column:
    """The stored bits of each bin; an empty array for a text without words."""
    def least(ordered: Column) -> Column:  # the first of each bin in sorted order
        return F.filter(ordered, lambda v, i: (i == 0) | (bin_of(v) != bin_of(F.get(ordered, i - 1))))

    def spread(kept: Column) -> Column:  # one element per bin, null where empty
        before = lambda i: F.when(i == 0, -1).otherwise(bin_of(F.get(kept, i - 1)))
        filled = F.flatten(F.transform(kept, lambda v, i: F.concat(
            F.array_repeat(F.lit(None).cast("bigint"), (bin_of(v) - before(i) - 1).cast("int")), F.array(v))))
        tail = F.array_repeat(F.lit(None).cast("bigint"), (BINS - 1 - bin_of(F.element_at(kept, -1))).cast("int"))
        return F.concat(filled, tail)

    def probed(sparse: Column) -> Column:
        return F.transform(sparse, lambda v, j: F.coalesce(v, *[
            F.get(sparse, F.pmod(F.xxhash64(j, F.lit(p)), F.lit(BINS)).cast("int")) for p in range(PROBES)]))

    def ended(kept: Column) -> Column:
        named = lambda j: F.array_min(F.transform(kept, lambda v: F.struct(
            F.xxhash64(bin_of(v), j).alias("order"), v.alias("value"))))["value"]
        return F.transform(let(spread(kept), probed), lambda v, j: (F.coalesce(v, named(j)).bitwiseAND(255) - 128).cast("tinyint"))

    kept = let(F.array_sort(shingle_hashes(text)), least)
    return let(kept, lambda k: F.when(F.size(k) == 0, F.array().cast("array<tinyint>")).otherwise(ended(k)))


def as_text(sig: Column) -> Column:
    """Two hexadecimal digits per bin."""
    return F.array_join(F.transform(sig, lambda b: F.substring(F.hex(b.cast("int") + 384), 2, 2)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles: equal bins, less those equal by chance."""
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0),
                        lambda n, i: n + F.when(F.get(a, i) == F.get(b, i), 1).otherwise(0)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    return (F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double"))
            .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))))


def bucket_column(key: Column, cuts: list) -> Column:
    """Number of cuts at or below the key, found in two steps; null keys come last."""
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    if not groups:
        return F.lit(0)
    heads, parts = F.lit([g[0] for g in groups]), F.array(*[F.lit(g) for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= key)) - 1
    inside = F.size(F.filter(F.get(parts, F.greatest(group, F.lit(0))), lambda c: c <= key))
    return F.when(key.isNull(), len(cuts)).otherwise(F.when(group < 0, 0).otherwise(group * step + inside)).cast("int")


def with_next(rows: DataFrame, doc_id: str, tie: str, columns: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each row with ``next_<column>`` of the row after it by id; after the last comes the first."""
    ids = rows.select(doc_id)
    n = ids.count()
    buckets = min(MAX_BUCKETS, max(1, n // bucket_rows))
    cuts = []
    if buckets > 1:
        points = [(i + 1) / buckets for i in range(buckets - 1)]
        cuts = sorted(set(ids.agg(F.percentile_approx(doc_id, points, 100 * buckets).alias("p")).first()["p"] or []))
    bucket = bucket_column(F.col(doc_id), cuts)
    # First id of each bucket, and the bucket before it that is not empty (the last one for the first).
    firsts = sorted((r["bucket"], r["first"]) for r in
                    ids.groupBy(bucket.alias("bucket")).agg(F.min(doc_id).alias("first")).collect())
    kind = rows.schema[doc_id].dataType.simpleString()
    guests = rows.sparkSession.createDataFrame(
        [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], f"__first {kind}, __host int")
    seated = (rows.withColumn("__bucket", bucket)
              .join(F.broadcast(guests), F.col(doc_id).eqNullSafe(F.col("__first")), "left")
              .withColumn("__seat", F.explode(F.filter(F.array(
                  F.struct(F.col("__bucket").alias("at"), F.lit(False).alias("guest")),
                  F.struct(F.col("__host").alias("at"), F.lit(True).alias("guest"))), lambda s: s["at"].isNotNull())))
              .withColumn("__at", F.col("__seat.at")).withColumn("__guest", F.col("__seat.guest")))
    order = Window.partitionBy("__at").orderBy("__guest", F.col(doc_id).asc_nulls_last(), F.col(tie))
    follow = F.lead(F.struct(*columns)).over(order)
    return (seated.withColumn("__next", follow).where("not __guest")
            .select(*rows.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns]))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, sig: the bins of every text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), bins(body).alias("sig"))


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, whose second half is the start of the next document."""
    rows = with_next(fingerprints(docs, doc_id, text), "doc_id", "text", ["text", "sig"])
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring("next_text", F.lit(1), half))
    done = rows.select("doc_id", length.cast("long").alias("n_chars"), edited.alias("edited"), "sig", "next_sig")
    done = done.withColumn("edited_sig", bins(F.col("edited")))
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
