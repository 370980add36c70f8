"""From raw documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it again for the next stage, so a lost executor never reaches back over a
stage. All but the last return the columns they got.

Defined results: every stage accepts nulls in any column, empty texts and empty tables as its operator says. Rows that
are equal in all columns are copies: the second stage keeps one of them, the fourth draws for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.llm import bin_slack_packing, dart_minhash, importance_resampling, pivotal_mixing, surrogate_pii
from starmart.llm.common import stored, table
from starmart.llm.queries import SURROGATE_KEY, tokenizer_path

#: SQL can express neither the classifier nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def row_key(docs: DataFrame) -> Column:
    """128 bits that tell rows apart unless they are equal in all columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.concat(F.hex(F.xxhash64(*columns)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *columns)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws as good; the rest go."""
    return importance_resampling.Resampler(docs, table(spark, sf_dir, "labels")).sample(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least id."""
    keyed = docs.withColumn("__key", row_key(docs))
    rows = keyed.select(F.struct("doc_id", "__key").alias("__row"), "text")
    kept = dart_minhash.classes(rows, doc_id="__row").where("keep").select(F.col("doc_id.__key").alias("__key"))
    return keyed.join(kept.distinct(), "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; the length column follows the text."""
    replaced = surrogate_pii.replace(docs, SURROGATE_KEY)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    keyed = docs.withColumn("__key", row_key(docs))
    copies = (pivotal_mixing.mix(keyed, doc_id="__key").groupBy("doc_id").agg(F.sum("copies").cast("int").alias("__copies"))
              .where("__copies > 0").withColumnRenamed("doc_id", "__key"))
    taken = keyed.dropDuplicates(["__key"]).join(stored(copies, "copies"), "__key")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1,024 tokens."""
    packed = bin_slack_packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return bin_slack_packing.ids_crc32(packed, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"])


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
