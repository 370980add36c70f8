"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import (
    bin_slack_packing, bwt_dedup, conversation_repair, conversation_sql, dart_minhash, importance_resampling, kdtree_topk,
    oph_fingerprint, pivotal_mixing, prefix_trie, splitter_sharding, surrogate_pii, text_rules, varbyte_tokens,
)
from starmart.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(table(spark, sf_dir, "documents"))


@query
def op2_oph_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """A vocabulary file of a public tokenizer, as installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = bin_slack_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return bin_slack_packing.ids_crc32(
        packed, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"])


@query
def op4_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree_topk.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


ORACLE_SQL["op4_kdtree_topk"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), placed as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from placed where rank <= 20
"""


@query
def op5_varbyte_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "varbyte")
    varbyte_tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return varbyte_tokens.ids_crc32(varbyte_tokens.read_tokens(spark, path))


@query
def op6_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


@query
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn as good, with their log ratio and their key in the draw."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    resampler = importance_resampling.Resampler(docs, table(spark, sf_dir, "labels"))
    return resampler.sample(docs).select("doc_id", F.col("__score").alias("log_ratio"), F.col("__key").alias("draw_key"))


@query
def op8_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pivotal_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_splitter_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitter_sharding.shard(table(spark, sf_dir, "documents"), n_shards=40)


#: Production takes the key from a secret store; the registered query needs a fixed one to be repeatable.
SURROGATE_KEY = b"a key for the registered query only"


@query
def op10_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogate_pii.replace(docs, SURROGATE_KEY, count="n_replaced")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op11_prefix_trie"] = conversation_sql.PREFIX_TRIE


@query
def op12_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every text, and the verdict of the threshold table."""
    judged = text_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *RULE_COLUMNS, "base_failed", "kept")


RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ORACLE_SQL["op12_text_rules"] = text_rules.judged_sql("doc_id, " + ", ".join(RULE_COLUMNS))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op13_conversation_repair"] = conversation_sql.REPAIR
