"""Quality by importance resampling: how much likelier is a text under the target than under the raw corpus?

Texts become hashed n-grams: words, pairs of words, and one feature for a word that repeats the one before. Two
generative models are counted over them: the raw model over every document, the target model over the labelled good
ones. A document's log weight is its log likelihood ratio, the sum over its n-grams. Gumbel noise drawn by a hash of the
document is added, and the ``k`` highest sums are the sample: drawing without replacement in proportion to the weights,
so near the margin the draw decides.

``k`` is a ``share`` of the corpus. Where none is given, it is the share that looks like the target: of documents whose
weight reaches a cut, set on labelled documents that the target model has not seen, with the least error, a good document
lost counting ``CARE`` times a bad one kept.

At most ``LABELS`` labelled documents are used (the lowest by hash of their id); everything else covers all documents.
The counts, whose number is that of the hash buckets, are the only thing that goes through the driver; the k-th sum is
found by histograms, not by a sort.

Defined results: null, empty and wordless texts have weight 0, the weight of a text that tells nothing; without good
labels and share all documents are kept; labels that are null, or of unknown documents, are ignored, and so are null
document ids among them; a document with contradicting labels is a bad one; rows equal in id and text are kept or dropped together; an empty table gives an empty result; other
columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, DoubleType, LongType, StructField, StructType

from starmart.llm.common import mix64, releasing, stored
from starmart.llm.words import NEXT, slices, words

BUCKETS = 10_000
LABELS = 20_000
CARE = 20.0


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram and the row it belongs to."""
    hashes, counts = words(texts, punctuation=True)
    row = np.repeat(np.arange(len(counts)), counts)
    if len(hashes) < 2:
        return (hashes % np.uint64(buckets)).astype(np.int64), row
    pair = row[1:] == row[:-1]
    same = pair & (hashes[1:] == hashes[:-1])
    repeat = np.full(int(same.sum()), mix64(np.array([1], np.uint64))[0])
    grams = np.concatenate([hashes, mix64(hashes[:-1] * NEXT + hashes[1:])[pair], repeat])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[1:][pair], row[1:][same]])


def log_ratios(counts, buckets: int) -> np.ndarray:
    """Log of target over raw probability per bucket, one added to every count; zeros without a target."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(buckets)
    return np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))


def best_cut(scores: np.ndarray, good: np.ndarray, care: float) -> float:
    """The score from which to keep, with the least weighted error; the lower one of equals."""
    if not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    good = good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    kept = 1 - np.concatenate([[0], np.cumsum(~good)]) / max(1, (~good).sum())
    at = int(np.argmin(care * lost + kept))
    if at == 0:
        return -np.inf
    below = scores[order[at - 1]]
    return float((below + scores[order[at]]) / 2) if at < len(scores) else float(below)


def gumbel(hashes: np.ndarray) -> np.ndarray:
    """Gumbel noise made of 64-bit hashes."""
    return -np.log(-np.log(((mix64(hashes) >> np.uint64(12)).astype(float) + 0.5) / 2.0 ** 52))


def kth_largest(frame: DataFrame, column: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest value: histograms over ever narrower ranges, the last few values looked at."""
    low, high = frame.agg(F.min(column), F.max(column)).first()
    above = 0
    while True:
        inside = frame.where(F.col(column).between(low, high))
        width = (high - low) / bins
        if width > 0 and low + width > low and inside.count() > few:
            bin_of = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
            counts = {r["bin"]: r for r in inside.groupBy(bin_of.alias("bin")).agg(
                F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
            for b in sorted(counts, reverse=True):
                if above + counts[b]["n"] >= k:
                    low, high = counts[b]["low"], counts[b]["high"]
                    break
                above += counts[b]["n"]
            continue
        counts = inside.groupBy(column).count().orderBy(F.desc(column)).limit(few).collect()
        for row in counts:
            above += row["count"]
            if above >= k:
                return row[column]
        return low


class Resampler:
    """Fitted on ``docs``; ``sample`` keeps the documents drawn."""

    def __init__(self, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
                 buckets: int = BUCKETS, max_labels: int = LABELS, share: float | None = None, care: float = CARE, seed: int = 41):
        self.doc_id, self.text, self.buckets, self.seed = doc_id, text, buckets, seed
        known = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(
            F.min(F.col(quality).cast("int")).alias("quality")).withColumn("pick", F.xxhash64("id", F.lit(seed)))
        # Odd picks fit the target model, even ones set the cut.
        self.labels = {r["id"]: (r["quality"] > 0, r["pick"] % 2 != 0) for r in known.orderBy("pick", "id").limit(max_labels).collect()}
        self.ratios = log_ratios(self.count(docs).collect(), buckets)
        self.scored = stored(self.score(docs).select(F.col(doc_id).alias("id"), "__score", "__key"), "scores", "snappy")
        if share is None:
            self.cut = self.held_out_cut(docs.schema[doc_id].dataType, care)
            k = self.scored.where(F.col("__score") >= self.cut).count() if np.isfinite(self.cut) else 0
        else:
            k = max(1, round(share * self.scored.count()))
        self.threshold = kth_largest(self.scored, "__key", k) if k and not self.scored.isEmpty() else None

    def held_out_cut(self, id_type: DataType, care: float) -> float:
        """The least-error cut over labelled documents that fit nothing."""
        held = {i for i, (_, fits) in self.labels.items() if not fits}
        ids = self.scored.sparkSession.createDataFrame([(i,) for i in held], StructType([StructField("id", id_type)]))
        seen = self.scored.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(F.min("__score").alias("s")).collect()
        return best_cut(np.array([r["s"] for r in seen]), np.array([self.labels[r["id"]][0] for r in seen], bool), care)

    def count(self, docs: DataFrame) -> DataFrame:
        """bucket, raw, target: n-grams of all documents and of the labelled good ones for fitting."""
        good = {i for i, (is_good, fits) in self.labels.items() if is_good and fits}
        buckets = self.buckets

        def run(batches):
            raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
            for batch in batches:
                chosen = np.array([i in good for i in batch.column(0).to_pylist()], bool)
                for a, b in slices(batch.column(1)):
                    gram, row = features(batch.column(1).slice(a, b - a), buckets)
                    raw += np.bincount(gram, minlength=buckets)
                    target += np.bincount(gram[chosen[a:b][row]], minlength=buckets)
            seen = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])
        parts = docs.select(self.doc_id, self.text).mapInArrow(releasing(run), "bucket long, raw long, target long")
        return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``__score`` (log ratio) and ``__key`` (log weight and noise)."""
        ratios, buckets, at = self.ratios, self.buckets, docs.columns.index(self.text)
        drawn = docs.withColumn("__draw", F.xxhash64(F.col(self.doc_id), F.col(self.text), F.lit(self.seed)))
        schema = StructType([*docs.schema.fields, StructField("__score", DoubleType()), StructField("__key", DoubleType())])
        arrow = to_arrow_schema(schema)

        def run(batches):
            for batch in batches:
                texts, n = batch.column(at), batch.num_rows
                score = np.zeros(n)
                for a, b in slices(texts):
                    gram, row = features(texts.slice(a, b - a), buckets)
                    score[a:b] = np.bincount(row, ratios[gram], minlength=b - a)
                key = score + gumbel(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64))
                yield from pa.Table.from_arrays([*batch.columns[:-1], pa.array(score), pa.array(key)], schema=arrow).to_batches()
        return drawn.mapInArrow(releasing(run), schema)

    def sample(self, docs: DataFrame) -> DataFrame:
        """The documents drawn, with ``__score`` and ``__key``."""
        scored = self.score(docs)
        return scored if self.threshold is None else scored.where(F.col("__key") >= self.threshold)
