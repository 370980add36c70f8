"""The corpus operators against brute force, on odd rows, on empty tables, and on the sample documents."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import (
    bin_slack_packing, bwt_dedup, dart_minhash, graph, importance_resampling, kdtree_topk, oph_fingerprint, pivotal_mixing,
    splitter_sharding, surrogate_pii, varbyte_tokens,
)
from starmart.llm import words as words_module
from starmart.llm.common import mix64, scratch_path, table
from starmart.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from starmart.llm.common import releasing
from starmart.llm import tokens as tokens_module
from starmart.llm.tokens import Encoder
from starmart.llm.words import NEXT, shingles, words

from .conftest import prose

KEY = b"test key"


def shingle_set(text):
    w = (text or "").split()
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


# --- words and tokens

@pytest.mark.parametrize("punctuation", [False, True])
def test_words_of_long_texts_do_not_depend_on_their_parts(odd, monkeypatch, punctuation):
    texts = pa.array([t for _, t, _ in odd] + ["", "one, two. " * 40, None, " " * 100, "z" * 9000 + " end"])
    whole, counts = words(texts, punctuation)
    for size in (1, 16, 5000):
        monkeypatch.setattr(words_module, "SLICE_BYTES", size)
        parts, again = words(texts, punctuation)
        assert (parts == whole).all() and (again == counts).all()


def test_word_and_shingle_hashes_follow_the_words():
    texts = [None, "", "a b c d e f", "  a\tb\nc d e f ", "b c d e f", "a b"]
    hashes, counts = words(pa.array(texts))
    made, n = shingles(hashes, counts)
    assert counts.tolist() == [0, 0, 6, 6, 5, 2] and n.tolist() == [0, 0, 2, 2, 1, 1]
    assert made[0] == made[2] and made[1] == made[3] == made[4] and len(set(made.tolist())) == 3


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piecewise_encoding_equals_the_tokenizer(name):
    encoder = Encoder(tokenizer_path(name))
    texts = ["", " a  b", "a\n b \n\nc  ", "x \t y", "é é  <|endoftext|> a", "İstanbul ΑΣ ΑΣ. ΣΑΣ", "a b c's don't 12 34 5.6 !!! ", "\x1c a \x85 b",
             "a ́b", "x" * 500, "ÀÉ, Ÿ ß. THE ÷ a×b Ünder, don.t it.s", prose(1, 500), "end.\nNext line,*** it's\nfin", "\n", "a\n"]
    texts += ["a <|endoftext|> b", "<|startoftext|>x y", "<|endoftext|>", "one\ntwo, three.\nfour", "a\u00a0b c", "x \ny", "q\u3000r s"]
    from tokenizers import Tokenizer
    expected = Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == [e.ids for e in expected]
    assert encoder.encode([None]) == [b""] and encoder.encode([]) == []
    plain = Encoder(tokenizer_path(name), special=False)
    assert len(plain.encode(["<|endoftext|>"])[0]) > plain.width


def test_a_full_store_of_pieces_begins_anew(monkeypatch):
    monkeypatch.setattr("starmart.llm.tokens.PIECES_KEPT", 3)
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    for text in ["one two, three", "two three. four,", "\n", "one two, three"]:
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == encoder.tokenizer.encode(text).ids


def test_a_word_is_encoded_once_wherever_it_stands(monkeypatch):
    encoder, seen = Encoder(tokenizer_path("word_bpe_49k.json")), []
    word = encoder.word
    monkeypatch.setattr(encoder, "word", lambda text: seen.append(text) or word(text))
    text = "sable quince, sable.\nQuince! sable\nSable quince;"
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(seen) == ["quince", "sable"]


def test_frequent_words_stay_known_in_a_full_store(monkeypatch):
    monkeypatch.setattr("starmart.llm.tokens.PIECES_KEPT", 8)
    encoder, seen = Encoder(tokenizer_path("word_bpe_49k.json")), []
    word = encoder.word
    monkeypatch.setattr(encoder, "word", lambda text: seen.append(text) or word(text))
    for k in range(20):
        text = f"sable quince, {' '.join('v' * (k + 1) + end for end in 'abc')} {'z' * 80} Sable"
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == encoder.tokenizer.encode(text).ids
        assert len(encoder.known) <= 8
    assert seen.count("sable") == seen.count("quince") == 1


# --- 1

def brute_classes(rows):
    sets = [shingle_set(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc, _, _) in enumerate(rows):
        groups[root(i)].append(doc)
    return Counter((doc, min((d for d in g if d is not None), default=None), len(g)) for g in groups.values() for doc in g)


def test_near_duplicates(make, odd):
    result = dart_minhash.classes(make(odd)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in result) == brute_classes(odd)
    assert sum(r.keep for r in result) == len({(r.class_id, r.doc_id if r.class_size == 1 else 0) for r in result})


def test_many_near_copies_of_one_text_become_one_class(make):
    rows = []
    for i in range(120):
        w = prose(9, 200).split()
        w[i] = "changed"
        rows.append((i, " ".join(w), "s"))
    result = dart_minhash.classes(make(rows)).collect()
    assert {r.class_id for r in result} == {0}


def test_pairs_inside_a_large_template_family(make):
    """Texts of one template just below the limit; every second one has a partner above it that is no centre."""
    template, rows = prose(11, 180).split(), []
    for i in range(200):
        w = list(template)
        w[20:36] = prose(1000 + i, 16).split()
        rows.append((2 * i, " ".join(w), "s"))
        if i % 2:
            w[100:103] = prose(3000 + i, 3).split()
            rows.append((2 * i + 1, " ".join(w), "s"))
    rows += [(1000 + i, prose(5000 + i, 60), "s") for i in range(20)]
    expected = brute_classes(rows)
    assert sum(size == 2 for _, _, size in expected.elements()) == 200
    result = dart_minhash.classes(make(rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in result) == expected


@pytest.mark.parametrize("block", [256, 7])
def test_close_pairs_are_all_similar_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(dart_minhash, "BLOCK", block)
    rng = np.random.default_rng(8)
    base, rows = np.sort(rng.choice(1 << 32, 60, replace=False)), []
    for i in range(120):
        keep = base[rng.random(60) < 0.95]
        new = np.sort(np.append(keep, rng.choice(1 << 32, int(rng.integers(0, 9)))))
        weights = b"" if i < 60 else np.where(rng.random(len(new)) < 0.03, 2, 1).astype("<u4").tobytes()
        rows.append((b"%03d" % i, b"%03d" % (i % 100), new.astype("<u4").tobytes(), weights))
    frame = spark.createDataFrame(rows, "key binary, label binary, shingles binary, weights binary")
    for part in (rows[:60], rows[60:]):
        expected = {(a[0], b[0]) for a in part for b in part if a[0] < b[0] and a[1] != b[1]
                    and dart_minhash.jaccard(a[2], b[2], a[3], b[3]) >= 0.8}
        some = frame.where(F.col("key").isin([r[0] for r in part]))
        found = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in dart_minhash.close_pairs(some, 0.8).collect()}
        assert len(expected) > 20 and expected <= found


def test_near_duplicates_of_nothing(make):
    assert dart_minhash.classes(make([])).count() == 0
    assert dart_minhash.classes(make([(1, None, "a"), (2, "", "a")])).where("keep").count() == 2


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    elements = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    a, b = rng.integers(1, 6, 400).astype(float), rng.integers(1, 6, 400).astype(float)
    sig = dart_minhash.signatures(np.tile(elements, 2), np.concatenate([a, b]), np.array([400, 400]), k=2048)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - truth) < 0.04
    assert (dart_minhash.signatures(elements[:1], np.array([0.3]), np.array([1]), k=16) != 0).all()


def test_components(spark):
    links = [(b"%03d" % i, b"%03d" % (i + 1)) for i in range(40)] + [(b"x", b"y")]
    found = {bytes(r.node): bytes(r.label) for r in graph.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert set(found.values()) == {b"000", b"x"} and len(found) == 43


# --- 2

def test_fingerprints(make, odd):
    rows = sorted(odd, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t, _ in rows]
    for bucket_rows in (4000, 3):
        frame = oph_fingerprint.fingerprints(make(odd))
        follow = oph_fingerprint.with_next(frame, "doc_id", "text", ["text"], bucket_rows).collect()
        expected = Counter((rows[i][0], texts[i], texts[(i + 1) % len(rows)]) for i in range(len(rows)))
        assert Counter((r.doc_id, r.text, r.next_text) for r in follow) == expected
    result = oph_fingerprint.edited_likeness(make(odd)).collect()
    edits = []
    for i, t in enumerate(texts):
        half, nxt = len(t) // 2, texts[(i + 1) % len(texts)]
        edits.append(t[:len(t) - half] + nxt[:half])
    expected = Counter((rows[i][0], len(texts[i]), hashlib.sha256(edits[i].encode()).hexdigest()) for i in range(len(rows)))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in result) == expected
    by_edit = {(rows[i][0], hashlib.sha256(e.encode()).hexdigest()): i for i, e in enumerate(edits)}
    for r in result:
        i = by_edit[r.doc_id, r.edited_sha256]
        assert abs(r.near_edited - jaccard(shingle_set(texts[i]), shingle_set(edits[i]))) < 0.15
        assert abs(r.near_next - jaccard(shingle_set(texts[i]), shingle_set(texts[(i + 1) % len(texts)]))) < 0.15
    prints = defaultdict(set)
    for r in result:
        prints[texts[by_edit[r.doc_id, r.edited_sha256]]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert oph_fingerprint.edited_likeness(make([])).count() == 0


def test_fingerprints_stay_native(spark, sf_dir):
    plan = QUERIES["op2_oph_fingerprint"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- 3

def test_fill_is_optimal():
    import itertools
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 40, 4)}
        capacity = int(rng.integers(1, 90))
        used = bin_slack_packing.fill(counts, capacity)
        sums = (sum(a * b for a, b in zip(counts, z)) for z in itertools.product(*[range(v + 1) for v in counts.values()]))
        assert all(used[k] <= counts[k] for k in used)
        assert sum(k * v for k, v in used.items()) == max(s for s in sums if s <= capacity)


def test_packing_round_trip(make, odd):
    path = tokenizer_path("byte_bpe_50k.json")
    packed = bin_slack_packing.pack(make(odd), path, block_rows=5)
    pieces = packed.collect()
    encoder = Encoder(path)
    expected = Counter((i, encoder.encode([t])[0] + b"\0\0") for i, t, _ in odd)
    documents, used = Counter(), defaultdict(list)
    by_doc = defaultdict(list)
    for p in pieces:
        assert p.length * 2 == len(p.ids) and p.length <= 1024
        by_doc[p.doc_id].append(p)
        used[p.sequence_id].append((p.offset, p.length))
    for doc, parts in by_doc.items():
        copies = sum(1 for i, _, _ in odd if i == doc)
        starts = Counter(p.start for p in parts)
        assert set(starts.values()) == {copies}
        documents[doc, b"".join({p.start: bytes(p.ids) for p in sorted(parts, key=lambda p: p.start)}.values())] += copies
    assert documents == expected
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in bin_slack_packing.ids_crc32(packed, ["doc_id", "start", "length"]).collect()}
    for p in pieces:
        assert crc[p.doc_id, p.start] == zlib.crc32(np.frombuffer(p.ids, "<u2").astype("<u4").tobytes())
    assert bin_slack_packing.pack(make([]), path).count() == 0


def test_little_padding():
    lengths = np.random.default_rng(3).integers(1, 1024, 2000)
    window, _ = bin_slack_packing.windows(lengths, 1024)
    assert 1 - lengths.sum() / ((window.max() + 1) * 1024) < 0.02


# --- 4

def test_top_k_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(200)]
    rows += [(i, rows[7][1]) for i in range(200, 260)] + [(260, None), (261, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (262, [float("nan")] * 6),
                                                        (263, [float("inf")] * 6), (None, rows[0][1]), (40, rows[40][1])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    result = kdtree_topk.search(frame, lambda i: i % 20 == 0, k=20, shard_rows=50, block_rows=4).collect()
    good = [(i, np.floor(64 * np.array(v))) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    expected = Counter()
    for q, v in good:
        if q % 20 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:20]
            expected.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in result) == expected
    assert kdtree_topk.search(frame.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_topk_of_wide_values(spark, shard_rows):
    """All finite components take part; scores beyond 64 bits saturate."""
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.choice([0.3, -7.5, 2.0 ** 22, -1e8, 3e7], 3)]) for i in range(1, 41)]
    rows += [(50, [1e301, 0.0, 0.0]), (51, [1e17, 1.0, 0.0]), (52, [float("inf"), 0.0, 1.0]), (53, [float("nan"), 0.0, 1.0]), (54, [-1.7e308, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(min(max(64 * x, -1e300), 1e300)) for x in v] for i, v in rows if all(map(math.isfinite, v))}
    found = kdtree_topk.search(frame, lambda i: i % 20 == 0, k=7, shard_rows=shard_rows, block_rows=2).collect()
    expected = []
    for q in (20, 40):
        scores = [(-min(max(sum(a * b for a, b in zip(whole[q], v)), -1 << 63), (1 << 63) - 1), i) for i, v in whole.items() if i != q]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:7])]
    assert sorted(map(tuple, found)) == expected


# --- 5

def test_variable_bytes_round_trip():
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert (varbyte_tokens.decode_ranks(varbyte_tokens.encode_ranks(ranks), n) == ranks).all()


def test_token_files(spark, make, odd):
    tokenizer = tokenizer_path("word_bpe_49k.json")
    for rows in (odd, []):
        path = scratch_path(spark, "test")
        varbyte_tokens.write_tokens(make(rows), path, tokenizer)
        result = varbyte_tokens.read_tokens(spark, path).collect()
        encoder = Encoder(tokenizer)
        expected = Counter((i, np.append(np.frombuffer(encoder.encode([t])[0], encoder.dtype), 1).astype("<u4").tobytes()) for i, t, _ in rows)
        assert Counter((r.doc_id, bytes(r.ids)) for r in result) == expected
        at = 0
        for r in sorted(result, key=lambda r: r.start):
            assert r.start == at and len(r.ids) == 4 * r.n_tokens
            at += r.n_tokens
        ordered = [r.doc_id for r in sorted(result, key=lambda r: r.start)]
        assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))


# --- 6

def brute_repeats(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        yield len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [256, 2])
def test_repeats(make, odd, monkeypatch, hot):
    monkeypatch.setattr(bwt_dedup, "HOT", hot)
    passage, other = prose(20, 150), prose(21, 90)
    rows = [(100 + i, prose(30 + i, 40) + " " + passage[i:] + " " + prose(60 + i, 40) + other[:450 - 10 * i], "s") for i in range(12)]
    rows += [(200, passage[:600] + passage[:600], "s"), (201, "ab" * 900, "s"), (202, "z" + "ab" * 300, "s"), (203, passage[:399], "s")]
    rows += odd
    result = bwt_dedup.dedup(make(rows)).collect()
    expected = Counter((r[0], *x) for r, x in zip(rows, brute_repeats([t for _, t, _ in rows])))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result) == expected


def test_repeats_of_nothing(make):
    assert bwt_dedup.dedup(make([])).count() == 0


# --- 7

def test_resampling_separates_held_out_labels(spark, sf_dir):
    drawn = {r.doc_id for r in QUERIES["op7_importance_resampling"](spark, sf_dir).select("doc_id").collect()}
    labels = table(spark, sf_dir, "labels").collect()
    good = [r.doc_id in drawn for r in labels if r.quality == 1]
    bad = [r.doc_id in drawn for r in labels if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_resampling_of_odd_rows(spark, make, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = importance_resampling.Resampler(make(odd), none)
    assert kept.sample(make(odd)).count() == len(odd)
    some = spark.createDataFrame([(1, 1), (6, 1), (8, 1), (14, 0), (12, 0), (None, 1), (99, 1), (10, None)], "doc_id long, quality int")
    fitted = importance_resampling.Resampler(make(odd), some)
    result = fitted.sample(make(odd)).collect()
    assert result == fitted.sample(make(odd)).collect() and len(result) <= len(odd)
    assert all(np.isfinite(r["__score"]) for r in result)
    assert importance_resampling.Resampler(make([]), some).sample(make([])).count() == 0


def test_resampling_equals_a_plain_version(spark, make):
    rng = np.random.default_rng(17)
    rows = []
    for i in range(300):
        good, bad = prose(i % 7, 30).split(), prose(100 + i % 5, 30).split()
        mine = [str(rng.choice(good if rng.random() < (0.8 if i % 3 else 0.3) else bad)) for _ in range(int(rng.integers(0, 12)))]
        rows.append((i, "  ".join(mine) + rng.choice(["", ".", " !!", "\né ü"]), "s"))
    rows += [(300, None, "s"), (301, "", "s"), (5, rows[5][1], "s")]
    marks = [(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(4, 0), (4, 1)]
    fitted = importance_resampling.Resampler(make(rows), spark.createDataFrame(marks, "doc_id long, quality int"), share=0.5)
    result = {(r.doc_id, r.text): (r["__score"], r["__key"]) for r in fitted.score(make(rows)).collect()}

    hashed = {}
    def grams(text):
        seen = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t-\r]+", (text or "").encode())
        for w in seen:
            hashed.setdefault(w, int(words(pa.array([w.decode()]), punctuation=True)[0][0]))
        ids, wrap = [hashed[w] for w in seen], (1 << 64) - 1
        mixed = [int(mix64(np.array([(a * int(NEXT) + b) & wrap], np.uint64))[0]) for a, b in zip(ids, ids[1:])]
        again = [int(mix64(np.array([1], np.uint64))[0]) for a, b in zip(ids, ids[1:]) if a == b]
        return [g % importance_resampling.BUCKETS for g in ids + mixed + again]

    verdict = {}
    for i, q in marks:
        verdict[i] = min(q, verdict.get(i, 1))
    fits = {i for i, (_, f) in fitted.labels.items() if f}
    assert {i: bool(q) for i, q in verdict.items()} == {i: q for i, (q, _) in fitted.labels.items()}
    every, target = Counter(), Counter()
    for i, text, _ in rows:
        every.update(grams(text))
        if i in fits and verdict[i]:
            target.update(grams(text))
    n = importance_resampling.BUCKETS
    def ratio(g):
        return math.log((target[g] + 1) / (target.total() + n)) - math.log((every[g] + 1) / (every.total() + n))
    for i, text, _ in rows:
        assert math.isclose(result[i, text][0], sum(map(ratio, grams(text))), abs_tol=1e-9)
    keys = sorted((result[i, t][1] for i, t, _ in rows), reverse=True)
    drawn = {(r.doc_id, r.text) for r in fitted.sample(make(rows)).collect()}
    cut = keys[round(0.5 * len(rows)) - 1]
    assert drawn == {d for d, (_, key) in result.items() if key >= cut}
    highest = sorted(result, key=lambda d: -result[d][0])[:len(drawn)]
    assert drawn != set(highest)  # the draw decides near the margin


def test_gumbel_draws_in_proportion_to_weights():
    weights = np.log([0.5, 0.3, 0.15, 0.05])
    noise = importance_resampling.gumbel(np.arange(40_000, dtype=np.uint64)).reshape(-1, 4)
    won = np.bincount(np.argmax(weights + noise, axis=1), minlength=4) / len(noise)
    assert np.abs(won - np.exp(weights)).max() < 0.02


def test_kth_largest(spark):
    values = np.random.default_rng(6).normal(size=500).round(1).tolist()
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 17, 250, 500):
        assert importance_resampling.kth_largest(frame, "v", k, bins=16, few=20) == sorted(values, reverse=True)[k - 1]


# --- 8

def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


def test_mixing(spark, make, odd, sf_dir):
    sample = [(r.doc_id, r.text, r.source) for r in table(spark, sf_dir, "documents").collect()]
    for rows in (odd, sample):
        result = pivotal_mixing.mix(make(rows), block_rows=100, fan_in=2).collect()
        assert len(result) == len(rows)
        sizes, taken, largest, target = Counter(), Counter(), Counter(), {}
        for r in result:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
            target[r.source] = r.target
            assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert all(r.source_size == sizes[r.source] for r in result)
        expected = brute_targets(sizes)
        for s in sizes:
            assert target[s] == pytest.approx(expected[s])
            assert abs(taken[s] - expected[s]) <= largest[s] + 1
        assert Counter(map(tuple, result)) == Counter(map(tuple, pivotal_mixing.mix(make(rows), block_rows=100, fan_in=2).collect()))
    assert pivotal_mixing.mix(make([])).count() == 0


# --- 9

def test_sharding(spark, make, odd, sf_dir):
    sample = [(r.doc_id, r.text, r.source) for r in table(spark, sf_dir, "documents").collect()]
    hot = [(1000 + i, "the same text in a third of all rows", "s") for i in range(500)]
    for rows, shards in ((odd, 3), (sample + hot, 40)):
        result = splitter_sharding.shard(make(rows), n_shards=shards).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in result) == Counter(
            (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
        slots, load = defaultdict(list), Counter()
        for r in result:
            assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
            slots[r.shard].append(r.slot)
            load[r.shard] += r.size
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if shards == 40:
            assert max(load.values()) - min(load[s] for s in range(40)) < 0.05 * sum(load.values()) / 40
            spread = defaultdict(set)
            for r in result:
                spread[r.text_crc32].add(r.shard)
            assert max(map(len, spread.values())) == 1
    assert splitter_sharding.shard(make([])).count() == 0


# --- 10

def test_surrogates(make, odd):
    first = "Write to ann.lee@mail.example.com or call +1 (212) 555-0147, card 4111 1111 1111 1111, from 10.20.30.40."
    second = "Dr. Anna Smith met Mr. Smith; ANN.LEE@mail.example.com and bob@mail.example.com, DE89370400440532013000, госпожа."
    rows = [(101, first, "s"), (102, second, "s"), (103, first, "s"), (104, "Version 4.0, page 12, 3 of 5 @ noon", "s"), *odd]
    frame = make(rows)
    result = surrogate_pii.replace(frame, KEY, count="n_replaced").collect()
    by_id = {r.doc_id: r for r in result}
    assert len(result) == len(rows) and set(result[0].asDict()) == {*frame.columns, "n_replaced"}
    assert by_id[101].text == by_id[103].text and by_id[104].text == rows[3][1] and by_id[104].n_replaced == 0
    for doc, text in ((101, first), (102, second)):
        for a, b, *_ in surrogate_pii.entities(text):
            assert text[a:b] not in by_id[doc].text
    new = by_id[101].text
    card = "".join(c for c in new[new.index("card"):new.index(", from")] if c.isdigit())
    assert surrogate_pii.luhn(card) == 0 and len(card) == 16
    domains = {w.split("@")[1].strip(",") for w in (new + " " + by_id[102].text).split() if "@" in w}
    assert len(domains) == 1
    names = by_id[102].text.split(";")[0].split()
    assert names[2] == names[5] != "Smith"
    assert Counter((r.doc_id, r.text) for r in result if (r.doc_id or 0) < 100) == Counter((i, t) for i, t, _ in odd)
    assert surrogate_pii.replace(make([]), KEY).count() == 0


def test_names_keep_one_surrogate(make):
    """A name has one surrogate whatever its place and form of address, and later mentions follow."""
    texts = ["Dr Anna Smith spoke.", "Frau Anna Smith spoke.", "Mr Paul Jones stayed. Jones said so, Jonesy did not; Paul left.",
             "Mrs Smith and Miss Paul Li met jones.", "Jones alone is no entity here", "Herr Иван Петров, Иван!", "Ms Jones", "Mr Smith-Jones"]
    rows = {r.doc_id: r.text for r in surrogate_pii.replace(make([(i, t, "s") for i, t in enumerate(texts)]), KEY).collect()}
    anna, smith = rows[0].split()[1:3]
    assert rows[1] == f"Frau {anna} {smith} spoke." and rows[3].split()[1] == smith and anna[-1] == "a"
    paul, jones = rows[2].split()[1:3]
    assert rows[2] == f"Mr {paul} {jones} stayed. {jones} said so, Jonesy did not; {paul} left."
    assert rows[3].split()[4] == paul and rows[3].endswith("met jones.") and rows[4] == texts[4] and rows[6] == f"Ms {jones}"
    ivan, petrov = rows[5].rstrip("!").replace(",", "").split()[1:3]
    assert rows[5] == f"Herr {ivan} {petrov}, {ivan}!" and all("а" <= c.lower() <= "я" for c in ivan + petrov)
    assert len({anna, smith, paul, jones, ivan, petrov, rows[7].split()[1]}) == 7
    assert not {anna, smith, paul, jones, ivan, petrov} & {"Anna", "Smith", "Paul", "Jones", "Иван", "Петров", "Li"}


def test_surrogates_stay_distinct(spark):
    values = spark.createDataFrame([("given_f", f"Name{i}") for i in range(60)] + [("given_f", "Anna")] + [("ip", f"1.2.3.{i}") for i in range(9)],
                                   "kind string, value string")
    result = surrogate_pii.surrogates(values, KEY).collect()
    assert len(result) == 70 and len({(r.kind, r.surrogate) for r in result}) == 70
    assert not {(r.kind, r.surrogate) for r in result} & {(r.kind, r.value) for r in result}


def test_surrogates_of_used_up_formats(make):
    rows = [(i, f"mail {c}@example.com or {i % 10}@{c}.com", "s") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    result = surrogate_pii.replace(make(rows), KEY).collect()
    local = {r.doc_id: r.text.split()[1].split("@")[0] for r in result}
    domain = {r.doc_id: r.text.split()[3].split("@")[1] for r in result}
    assert len(set(local.values())) == len(set(domain.values())) == 26
    assert not {t for _, text, _ in rows for w in text.split() if "@" in w for t in w.split("@")} & {*local.values(), *domain.values()}


@pytest.mark.parametrize("kind, value", [
    ("local", "a"), ("local", "_"), ("domain", "a.com"), ("ip", "1.2.3.4"), ("phone", "+1 23 45"), ("card", "4111 1111 1111 1"),
    ("ssn", "123-45-6789"), ("secret", "AKIA" + "A" * 16), ("secret", "0" * 32), ("iban", "DE89370400440532013000"), ("family", "Li")])
def test_later_attempts_draw_from_a_larger_space(kind, value):
    early, late = (max(len(surrogate_pii.surrogate(KEY, kind, value, n)) for n in some) for some in (range(4), range(40, 44)))
    assert late > early
    for n in (0, 5, 41):
        drawn = surrogate_pii.surrogate(KEY, kind, value, n)
        if kind == "card":
            assert (surrogate_pii.luhn(value.replace(" ", "")) == 0) <= (surrogate_pii.luhn(drawn.replace(" ", "")) == 0)
        if kind == "iban":
            assert int("".join(str(int(c, 36)) for c in drawn[4:] + drawn[:4])) % 97 == 1


def test_surrogates_of_digits_beyond_ascii(make):
    number = "٠٣٠-١٢٣٤-٥٦٧٨"
    one, = surrogate_pii.replace(make([(1, f"call {number} now", "s")]), KEY, count="n_replaced").collect()
    assert one.n_replaced == 1 and number not in one.text


def test_equal_rows_without_ids_spread_evenly(spark):
    """200,000 equal rows with null ids: shards, sampled keys and blocks of the mix hold their even share."""
    docs = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("s").alias("source"))
    sizes = splitter_sharding.shard(docs).groupBy("shard").agg(F.sum("size").alias("n"), F.count("*").alias("rows"), F.max("slot").alias("last")).collect()
    total = sum(r.n for r in sizes)
    assert len(sizes) == 40 and max(r.n for r in sizes) < 1.1 * total / 40 and all(r.last == r.rows - 1 for r in sizes)
    rows = docs.select("doc_id", F.lit(29).alias("size"), F.lit(7).alias("key"), F.monotonically_increasing_id().alias("row"))
    assert len(splitter_sharding.draw(rows, 4000, 200_000 * 29, 23)) < 6000


def test_remaining_text_of_removed_repeats(make):
    shared = "".join(chr(97 + i * i % 23) for i in range(700))
    rows = {r.doc_id: r for r in bwt_dedup.dedup(make([(1, "é head " + shared + " tail", "s"), (2, shared, "s"), (3, "alone", "s"), (4, None, "s")])).collect()}
    assert rows[1].text.startswith("é head") and rows[1].text.endswith("tail") and len(rows[1].text) < 40
    assert rows[2].text == "" and rows[3].text == "alone" and rows[4].text == ""


# --- registered queries

@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_with_sql(spark, sf_dir, name):
    import duckdb

    connection = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    expected = connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert Counter(map(tuple, QUERIES[name](spark, sf_dir).select(*columns).collect())) == Counter(expected.fetchall())


def test_near_duplicate_and_repeat_queries_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, sf_dir, "documents").collect()]
    result = QUERIES["op1_dart_minhash"](spark, sf_dir).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in result) == brute_classes(rows)
    result = QUERIES["op6_bwt_dedup"](spark, sf_dir).collect()
    expected = Counter((r[0], *x) for r, x in zip(rows, brute_repeats([t for _, t, _ in rows])))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result) == expected


# --- memory of workers

def test_a_task_hands_back_the_memory_it_freed():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    pinned = []

    def run(batches):
        for batch in batches:
            made = [bytes(2000) for _ in range(100_000)]
            pinned.append(made[-1])  # what lies before it is freed, but not the end of the heap
            yield batch + 1

    before = resident()
    assert list(releasing(run)(iter([1, 2]))) == [2, 3]
    assert resident() - before < 100 << 20


def test_an_encoding_task_hands_back_the_memory_it_freed():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    path = tokenizer_path("byte_bpe_50k.json")
    tokens_module.encoder(path).encode(["a word to warm up with"])
    run = tokens_module.encode_batches(path, "text", 0, lambda rows, ids, offsets: pa.table({"n": np.diff(offsets)}))

    def batches():
        rng = np.random.default_rng(3)
        for _ in range(4):  # nearly every word is new, as with misspellings in a large corpus
            words = rng.integers(97, 123, (100, 2000, 7), dtype=np.uint8)
            words[:, :, 6] = 32
            yield pa.RecordBatch.from_pydict({"text": [bytes(text.ravel()[:-1]).decode() for text in words]})

    before = resident()
    assert sum(batch.num_rows for batch in run(batches())) == 400
    assert len(tokens_module.encoder(path).known) <= 3 * tokens_module.PIECES_KEPT
    assert resident() - before < 60 << 20


def test_pairs_go_to_the_sets_and_sets_stay(make, monkeypatch):
    """Shingles of sets without a pair are never shuffled again: the stored sets are read in their buckets."""
    near = [(i, f"{prose(900, 150)} tail {i}", "s") for i in range(6)]
    plans = []
    real = dart_minhash.verified

    def spied(pairs, sets, similar):
        links = real(pairs, sets, similar)
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return links

    monkeypatch.setattr(dart_minhash, "verified", spied)
    docs = make([*near, *[(100 + i, prose(i, 60), "s") for i in range(40)]])
    spark = docs.sparkSession
    monkeypatch.setattr(dart_minhash, "CHUNK", 2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = {t.name for t in spark.catalog.listTables()}
        got = {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()}
        assert {t.name for t in spark.catalog.listTables()} == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {i: 0 for i in range(6)} | {100 + i: 100 + i for i in range(40)}
    assert plans and all(plan.count("SelectedBucketsCount") == 2 for plan in plans)


def test_the_hotter_end_of_a_pair_is_its_centre(spark, monkeypatch):
    """One set is the second end of many pairs: it is sent once per chunk of them, not once per pair."""
    monkeypatch.setattr(dart_minhash, "CHUNK", 4)
    sets = [(bytes([i]), np.arange(50 + (i > 0), dtype="<u4").tobytes(), b"") for i in range(20)]
    stored_frames = {}
    real = dart_minhash.stored
    monkeypatch.setattr(dart_minhash, "stored", lambda frame, tag, **more: stored_frames.setdefault(tag, real(frame, tag, **more)))
    frame = spark.createDataFrame([tuple(map(bytearray, s)) for s in sets], "key binary, shingles binary, weights binary")
    pairs = spark.createDataFrame([(bytearray([i]), bytearray([0])) for i in range(1, 20)], "a binary, b binary")
    links = dart_minhash.verified(pairs, frame, 0.8).collect()
    assert sorted(bytes(r.b) for r in links) == [bytes([i]) for i in range(1, 20)] and {bytes(r.a) for r in links} == {b"\0"}
    assert max(r["count"] for r in stored_frames["chunks"].groupBy("b").count().collect()) == 1
