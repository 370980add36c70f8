"""Each stage of the pipeline on its own input, and the whole."""

from collections import Counter

import corpus_pipeline as pipeline
from starmart.llm.common import table

from .test_operators import brute_classes


def test_stages_keep_columns_and_take_effect(spark, make, odd, sf_dir):
    docs = make(odd, clash=False)
    kinds = docs.dtypes
    for name, stage in pipeline.STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        assert result.dtypes == kinds, name
        result.collect()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_near_dedup_keeps_one_row_per_class(spark, make, odd, sf_dir):
    rows = [r for r in odd if (r[1] or "").strip()]
    kept = pipeline.near_dedup(spark, make(odd, clash=False), sf_dir).collect()
    classes = {(c, n if n > 1 else d) for d, c, n in brute_classes(rows)}
    assert len([r for r in kept if (r.text or "").strip()]) == len(classes)
    assert len([r for r in kept if not (r.text or "").strip()]) == len(odd) - len(rows)


def test_mixing_repeats_rows(spark, make, sf_dir):
    rows = [(i, f"w{i} " * (i + 1), "ab"[i % 2]) for i in range(30)] * 2
    mixed = Counter(r.doc_id for r in pipeline.mixing(spark, make(rows, clash=False), sf_dir).collect())
    assert max(mixed.values()) <= 6 and set(mixed) <= set(range(30))


def test_run(spark, sf_dir):
    pieces = pipeline.run(spark, sf_dir).collect()
    known = {r.doc_id for r in table(spark, sf_dir, "documents").select("doc_id").collect()}
    bad = {r.doc_id for r in table(spark, sf_dir, "labels").where("quality = 0").collect()}
    used = {p.doc_id for p in pieces}
    assert used <= known and len(used & bad) <= 0.1 * len(bad)
    assert Counter((p.sequence_id, p.offset) for p in pieces).most_common(1)[0][1] == 1
