"""The prefix trie, the text rules and the conversation repair against brute force, SQL, odd rows and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import conversation_repair, conversation_sql, prefix_trie, text_rules
from starmart.llm.common import table

from .conftest import CLASHING, prose

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def spoken(spark):
    """Conversations with nulls, ties, repeated and empty rows, one that is long, many that are equal; with clashing columns."""
    rng, rows = random.Random(5), []
    for conv in [*range(-12, 60), None]:
        for _ in range(rng.choice([1, 2, 5, 12, 14])):
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice(["a.", "b", "", "  ", None, "é.", "x? \n", prose(1, 900) + "."])))
    rows += [(1000, i, rng.choice(["user", "assistant", "system"]), f"t{rng.randint(0, 500)}" + rng.choice([".", ""])) for i in range(1500)]
    rows += [(1005, i, r, t) for _, i, r, t in rows[-1500:-100]]
    for conv in range(2000, 2300):
        rows += [(conv, 0, "user", "hi"), (conv, 1, "assistant", f"there {conv // 100}.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in [*CLASHING, "depth", "level", "conv", "leaves", "symbols", "cost", "kind", "seg"]:
        frame = frame.withColumn(name, F.lit(f"extra {name}"))
    return frame.repartition(5), rows


def duck(sql, rows):
    db = duckdb.connect()
    db.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    return Counter(db.execute(sql).fetchall())


def by_turn(rows):
    return sorted(rows, key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))


# --- 11

def brute_trie(rows):
    convs, nodes, ends = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t, r or "", x or ""))
    said = {c: [v[1:] for v in by_turn(v)] for c, v in convs.items()}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        path = said.get(c - int(math.fmod(c, 5)), [])[:h] + said[c][h:]
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = Counter(k[:-1] for k in nodes if k), Counter(), Counter()
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] += not children[k]
        if k:
            saved[k] += (len(nodes[k]) - 1) * len(k[-1][1].encode())
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    return Counter((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in nodes.items())


@pytest.fixture(scope="module")
def short(spoken):
    """Without most of the long conversation's turns, for brute force over whole prefixes."""
    frame, rows = spoken
    return frame.where("coalesce(turn, 0) < 300"), [r for r in rows if (r[1] or 0) < 300]


def test_trie_equals_brute_force_and_sql(short):
    frame, rows = short
    result = Counter(tuple(r) for r in prefix_trie.prefix_trie(frame).collect())
    assert result == brute_trie(rows) == duck(conversation_sql.PREFIX_TRIE, rows)


def test_trie_with_small_blocks_and_runs(short, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(prefix_trie, "PARTS_BITS", 2)
    frame, rows = short
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(frame).collect()) == brute_trie(rows)


def test_subtree_sums_of_a_chain_a_star_and_a_caterpillar(spark):
    nodes, tree = [(0, 0, None, 0)], {}
    for d in range(1, 40):  # a chain that changes its member halfway, with a leaf beside each of its upper nodes
        nodes.append((0 if d < 20 else 500, d, 0 if d <= 20 else 500, d))
        if d < 20:
            nodes.append((d, d + 1, 0, 100))
    nodes += [(1000 + i, 1, 0, 7) for i in range(300)]
    for c, d, p, w in sorted(nodes, key=lambda n: -n[1]):
        own = tree.setdefault((c, d), [0, 0, 0])
        own[1] += own[0] == 0
        own[2] += w
        if p is not None:
            up = tree.setdefault((p, d - 1), [0, 0, 0])
            up[0] += 1
            up[1] += own[1]
            up[2] += own[2]
    frame = spark.createDataFrame(nodes, "conv_id long, depth long, parent_conv_id long, saved long")
    children, totals = prefix_trie.subtree_sums(frame)
    found = {(r.conv, r.level): [r.children, r.leaves, r.saved] for r in children.join(totals, ["conv", "level"]).collect()}
    assert found == tree


def test_trie_of_an_empty_table_and_turnless_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    rows = [(c, 0, None, None) for c in range(1, 30) if c % 5]  # their bases are absent
    result = Counter(tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect())
    assert result == brute_trie(rows)


# --- 12

def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(5)}
    stops = set(text_rules.stop_forms())
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_exclamations": (text or "").count("!"), "n_capitals": sum(c.isupper() for c in text or ""),
        "n_stop_words": sum(w in stops for w in words), "n_doubled_words": sum(a == b for a, b in zip(words, words[1:])),
        "n_repeat_words": len(covered), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_cut_lines": sum(x.endswith(("...", "…")) for x in lines)}


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h i j", "the cat sat on the mat and the dog sat on the rug of it",
    "x y z w v x y z w v", "a a a a a a a a a a a", "l1 one\nl1 one\n\n \nl1 one \nl1 one", "é ü ß x y  double\x0b\x0cend…\nmore...\n",
    "##$$ %% && || <> *", "UP UP AND AWAY!!! TO THE SKY WE GO NOW AND EVER", prose(4, 5000) + " " + prose(4, 40), "1 2 3 4 5 6 1 2 3 4 5",
    "\n".join(["and so it is said by the few"] * 3 + [prose(8, 90) + " of the in to and that is for"]),
]


def test_measures_and_verdict_equal_brute_force(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, TEXTS[5]), (1, TEXTS[1])], "doc_id long, text string")
    for name in [*CLASHING, "n_words", "kept", "one"]:
        frame = frame.withColumn(name, F.lit(f"extra {name}"))
    result = text_rules.judge(frame.repartition(3)).collect()
    assert len(result) == len(TEXTS) + 2
    for row in result:
        m = brute_measures(row.text)
        assert {k: row[k] for k in m} == m, row.text
        base = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        failed = [r.name for r in [*text_rules.BASE, *text_rules.RULES]
                  if (r.least is not None and 100 * m[r.measure] < r.least * m.get(r.per, 1))
                  or (r.most is not None and 100 * m[r.measure] > r.most * m.get(r.per, 1))]
        assert row.base_failed == base and row.failed == failed and row.kept == (not failed)
    assert {r.kept for r in result} == {True, False}


def test_text_rules_are_native_and_can_be_filtered(spark, sf_dir):
    judged = text_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert judged.where("kept").count() + judged.where("not kept").count() == judged.count()
    labels = table(spark, sf_dir, "labels")
    told = Counter((r.quality, r.base_failed, r.kept) for r in judged.select("doc_id", "base_failed", "kept").join(labels, "doc_id").collect())
    assert told[0, False, True] == 0 and told[1, False, False] <= 0.02 * told[1, False, True]


def test_text_rules_of_an_empty_table(spark):
    assert text_rules.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- 13

def brute_repair(rows):
    convs = defaultdict(list)
    said = lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        own, harm = convs[c], zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20
        r, x = said(r), said(x)
        x = "" if harm == 1 else re.sub("[.!?]", "", x) if harm == 2 else x
        own += [(t, "user" if harm == 4 else r, x)] * {0: 0, 3: 2}.get(harm, 1)
    return Counter(repaired(c, by_turn(v)) for c, v in convs.items())


DELTA = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def closed(best):
    for _ in range(3):
        for q, (cost, audit, lines) in list(best.items()):
            for role in ("user", "assistant"):
                p, new = DELTA.get((q, role[0])), (cost + 5, audit + "I", (*lines, role + ":"))
                if p and (p not in best or new[:2] < best[p][:2]):
                    best[p] = new
    return best


def repaired(conv, rows):
    """Forward over whole edit strings, with the least (cost, edits) of each state."""
    seen, faults, best = set(), [], {"": (0, "", ())}
    for _, r, x in rows:
        y = x.strip(SPACE)
        faults.append("blank" if not y else "duplicate" if (r, x) in seen else "" if y[-1] in ".!?" else "truncated")
        seen.add((r, x))
    for (_, r, x), fault in zip(rows, faults):
        ways, late = defaultdict(list), 5 * (fault == "truncated")
        for q, (cost, audit, lines) in closed(best).items():
            ways[q].append((cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                if (q, r[:1]) in DELTA:
                    ways[DELTA[q, r[:1]]].append((cost + late, audit + "K", (*lines, f"{r}:{x}")))
                for role in ("user", "assistant"):
                    if (q, role[0]) in DELTA:
                        ways[DELTA[q, role[0]]].append((cost + late + 1, audit + "R", (*lines, f"{role}:{x}")))
        best = {q: min(w, key=lambda n: n[:2]) for q, w in ways.items()}
    cost, audit, lines = min((w for q, w in closed(best).items() if q in ("", "a")), key=lambda n: n[:2])
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_repair_equals_brute_force_and_sql(spoken):
    frame, rows = spoken
    assert Counter(tuple(r) for r in conversation_repair.repair(frame).collect()) == brute_repair(rows)
    few = [r for r in rows if r[0] is None or r[0] < 1000]
    assert brute_repair(few) == duck(conversation_sql.REPAIR, few)


@pytest.mark.parametrize("bits", [0, 2])
def test_repair_across_segments(spoken, monkeypatch, bits):
    monkeypatch.setattr(conversation_repair, "SEGMENT_BITS", bits)
    monkeypatch.setattr(conversation_repair, "ROWS_AT_ONCE", 7)
    frame, rows = spoken
    few = frame.where("conv_id is null or conv_id < 1000")
    result = Counter(tuple(r) for r in conversation_repair.repair(few).collect())
    assert result == brute_repair([r for r in rows if r[0] is None or r[0] < 1000])


def test_block_tables_equal_plain_costs():
    """Every block of three symbols, and random strings, against all edit strings."""
    own, rng = conversation_repair.Tables(3), random.Random(1)
    for symbols in [*itertools.product(range(9), repeat=3), *[tuple(rng.randrange(9) for _ in range(n)) for n in (0, 1, 2, 7, 11) for _ in range(40)]]:
        rows = [(None, "user" if x == 8 else ("system", "user", "assistant", "tool")[x // 2],
                 "" if x == 8 else f"{i}" if x % 2 else f"{i}.") for i, x in enumerate(symbols)]
        string = conversation_repair.numbers("".join(map(str, symbols)))
        letters, q, cost = own.trace(string, 0, 0)
        more, extra = own.tails[q]
        expected = repaired(0, rows)
        assert (cost + extra, letters + more) == (expected[6], expected[7]), symbols
        codes, rest = own.codes(string)
        assert rest == len(symbols) % 3 and own.back(string, 0) < len(own.vectors)


def test_repair_of_an_empty_table_and_of_dropped_rows(spark):
    assert conversation_repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversation_repair.repair(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", empty)]
