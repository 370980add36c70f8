"""Cheapest repair of damaged conversations, by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in role initials: perhaps one system turn, then user and assistant in turns.
Rows are kept (0), given the role user or assistant (1), deleted (2, the only way for blank or repeated rows), or an
empty user or assistant turn is inserted (5); an unfinished text that stays costs 5 more.

Each row becomes one of nine symbols (role initial and fault). The cost to finish from the four states of the pattern
is a vector; less its least entry only a few dozen vectors occur. ``Tables`` finds them all, and precomputes for every
vector and every block of ``BLOCK`` symbols the vector before the block and what the least entry grows by. A
conversation is then processed backwards, a block per lookup, and traced forwards: each block is expanded backward from
its stored vector, and of the edits that keep the cost least the first in ASCII order is taken, which gives the least
of all cheapest edit strings.

No conversation need fit in one task. A range exchange orders the rows by conversation and turn, and splits long
conversations; segments of at most ``SEGMENT`` rows of it are compacted to one symbol per row. Costs and states pass
from segment to segment in a stream over those strings, one byte per row of text, with a vector or a state as the only
memory. The digest of the repaired conversation has to see its texts in order; they stream past it as well.

Defined results: null conversation ids are one conversation of their own; null turns come first; null role or text is
one space (so such a row is blank or has no legal role); rows of one turn are ordered by role and text after the
damage; a role counts by its first character, and an empty one by none, which no pattern allows; a conversation that
loses all rows has zeros, an empty audit and the digest of the empty string; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmart.llm.common import stored

BLOCK = 4
SEGMENT_BITS = 8
SEGMENT = 1 << SEGMENT_BITS
ROWS_AT_ONCE = 500

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = 4
ROLES = "sua"
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ACCEPTING = (0, 3)
DELETE_ONLY, SYMBOLS = 8, 9  # other symbols: twice the place of the initial in "sua" (3 for others), 1 more if unfinished
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
FAR = 1 << 20


class Tables:
    """All normalised vectors, their transitions by symbol and by block, and the edits of each step."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = self.closed([0 if q in ACCEPTING else FAR for q in range(STATES)])
        self.vectors, found = [end], {end: 0}
        step, grown = [], []
        for v in self.vectors:  # grows while new vectors turn up
            reached = []
            for x in range(SYMBOLS):
                new = self.before(v, x)
                least = min(new)
                new = tuple(c - least for c in new)
                if new not in found:
                    found[new] = len(self.vectors)
                    self.vectors.append(new)
                reached.append((found[new], least))
            step.append([r[0] for r in reached])
            grown.append([r[1] for r in reached])
        self.step, self.grown = np.array(step, np.int32), np.array(grown, np.int32)
        # A block's first symbol is its highest digit; blocks are entered from behind.
        self.block_step, self.block_grown = self.step, self.grown
        for _ in range(block - 1):
            inner, sums = self.block_step, self.block_grown
            self.block_step = self.step[inner].transpose(0, 2, 1).reshape(len(inner), -1)
            self.block_grown = (sums[:, :, None] + self.grown[inner]).transpose(0, 2, 1).reshape(len(inner), -1)
        self.moves = [[[self.move(v, x, q) for q in range(STATES)] for x in range(SYMBOLS)] for v in range(len(self.vectors))]
        self.tails = [self.tail(q) for q in range(STATES)]

    @staticmethod
    def closed(costs: list[int]) -> tuple[int, ...]:
        """With inserts before the row at hand allowed."""
        costs = list(costs)
        for _ in range(STATES):
            for q in range(STATES):
                costs[q] = min([costs[q], *[INSERT + costs[NEXT[q][y]] for y in "ua" if y in NEXT[q]]])
        return tuple(costs)

    @staticmethod
    def edits(x: int, q: int) -> list[tuple[str, int, int]]:
        """Letter, cost and state after it, for one row of symbol ``x``."""
        options = [("D", DELETE, q)]
        if x != DELETE_ONLY:
            late = UNFINISHED * (x % 2)
            role = ROLES[x // 2] if x // 2 < len(ROLES) else ""
            if role in NEXT[q]:
                options.append(("K", late, NEXT[q][role]))
            options += [("R", late + REROLE, NEXT[q][y]) for y in "ua" if y in NEXT[q]]
        return options

    def before(self, v: tuple[int, ...], x: int) -> tuple[int, ...]:
        return self.closed([min(c + v[p] for _, c, p in self.edits(x, q)) for q in range(STATES)])

    def move(self, v: int, x: int, q: int) -> tuple[str, int, int]:
        """Edits up to and with a row of symbol ``x`` from state ``q``, with vector ``v`` behind the row: letters, state, cost."""
        after, here = self.vectors[v], self.vectors[self.step[v, x]]
        grown, letters, cost = int(self.grown[v, x]), "", 0
        while True:
            left = here[q] + grown
            options = [(k, c, p) for k, c, p in self.edits(x, q) if c + after[p] == left]
            options += [("I", INSERT, NEXT[q][y]) for y in "ua" if y in NEXT[q] and INSERT + here[NEXT[q][y]] == here[q]]
            letter, c, q = min(options)
            letters, cost = letters + letter, cost + c
            if letter != "I":
                return letters, q, cost

    def tail(self, q: int) -> tuple[str, int]:
        """Inserts after the last row."""
        letters = ""
        while q not in ACCEPTING:
            q = NEXT[q]["a" if q == 2 else "u"]
            letters += "I"
        return letters, INSERT * len(letters)

    def codes(self, symbols: np.ndarray) -> tuple[np.ndarray, int]:
        """Numbers of the full blocks of a string of symbols, and how many symbols before them are left over."""
        rest = len(symbols) % self.block
        full = symbols[rest:].reshape(-1, self.block).astype(np.int64)
        return full @ (SYMBOLS ** np.arange(self.block - 1, -1, -1, dtype=np.int64)), rest

    def back(self, symbols: np.ndarray, v: int) -> int:
        """The vector before the symbols, given the one behind them."""
        codes, rest = self.codes(symbols)
        for code in codes[::-1].tolist():
            v = int(self.block_step[v, code])
        for x in symbols[:rest][::-1].tolist():
            v = int(self.step[v, x])
        return v

    def trace(self, symbols: np.ndarray, v: int, q: int) -> tuple[str, int, int]:
        """Letters of the edits of all symbols from state ``q``, the state behind them, and their cost."""
        codes, rest = self.codes(symbols)
        behind = [v]  # of each block, last first
        for code in codes[::-1].tolist():
            behind.append(int(self.block_step[behind[-1], code]))
        letters, cost = [], 0
        parts = [symbols[:rest]] + [symbols[i:i + self.block] for i in range(rest, len(symbols), self.block)]
        for part, right in zip(parts, reversed(behind)):
            inner = [right]
            for x in part[::-1].tolist():  # expanded backward
                inner.append(int(self.step[inner[-1], x]))
            for x, v in zip(part.tolist(), inner[-2::-1]):
                made, q, c = self.moves[v][x][q]
                letters.append(made)
                cost += c
        return "".join(letters), q, cost


@lru_cache(maxsize=2)
def tables(block: int = BLOCK) -> Tables:
    """One per Python worker."""
    return Tables(block)


# --- rows and symbols, by column functions

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows left after the damage that the CRC of ``conv_id:turn`` calls for."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
        (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20).alias("__harm"))
    harm = F.col("__harm")
    return rows.where(harm != 0).select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


def symbol(role: Column, text: Column) -> Column:
    first = F.substring(role, 1, 1)
    place = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    unfinished = (~text.rlike(r"[.!?][ \t-\r]*\z")).cast("int")
    return F.when(~text.rlike(r"[^ \t-\r]"), DELETE_ONLY).otherwise(2 * place + unfinished)


def segments(rows: DataFrame) -> DataFrame:
    """conv_id, seg, symbols: one digit per row in order; 8 blank, 9 repeated."""
    seg = F.shiftright("__at", SEGMENT_BITS).alias("seg")
    coded = rows.select("conv_id", "__at", symbol(F.col("role"), F.col("text")).alias("sym"),
                        F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("said"))
    # Of equal rows the first place is kept: partial minima, so a row repeated without end meets no task alone.
    firsts = coded.groupBy("conv_id", "said").agg(F.min("__at").alias("__at"))
    both = (coded.select("conv_id", seg, "__at", "sym")
            .unionByName(firsts.select("conv_id", seg, "__at", F.lit(-1).alias("sym"))))
    gathered = both.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list(F.struct("__at", "sym"))).alias("items"))

    def coded_item(x: Column, i: Column) -> Column:
        before = F.get(F.col("items"), i - 1)
        first = (before["__at"] == x["__at"]) & (before["sym"] == -1)
        return F.when((x["sym"] >= 0) & (x["sym"] < DELETE_ONLY) & ~F.coalesce(first, F.lit(False)), 9).otherwise(x["sym"])
    digits = F.filter(F.transform("items", coded_item), lambda s: s >= 0)
    return gathered.select("conv_id", "seg", F.array_join(F.transform(digits, lambda s: s.cast("string")), "").alias("symbols"))


# --- streams over segments and rows: sorted input, one conversation after the other

def key_of(value) -> tuple:
    return (value,)


def numbers(symbols: str) -> np.ndarray:
    return np.minimum(np.frombuffer(symbols.encode(), np.uint8) - 48, DELETE_ONLY)


def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from the last to the first of each conversation; adds the vector behind each, and whether it is the last."""
    own, conv, v = tables(), None, 0
    for batch in batches:
        behind, last = [], []
        for c, symbols in zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist()):
            last.append(conv != key_of(c))
            if last[-1]:
                conv, v = key_of(c), 0
            behind.append(v)
            v = own.back(numbers(symbols), v)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(behind, pa.int32()), pa.array(last, pa.bool_())],
                                         [*batch.schema.names, "behind", "last"])


def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from the first to the last; replaces the vector by the segment's edits and their cost."""
    own, conv, q = tables(), None, 0
    for batch in batches:
        edits, costs = [], []
        for c, symbols, v, last in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "symbols", "behind", "last")]):
            if conv != key_of(c):
                conv, q = key_of(c), 0
            letters, q, cost = own.trace(numbers(symbols), v, q)
            if last:
                more, extra = own.tails[q]
                letters, cost = letters + more, cost + extra
            edits.append(letters)
            costs.append(cost)
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("conv_id", "seg", "symbols")] + [pa.array(edits, pa.string()), pa.array(costs, pa.int64())],
            ["conv_id", "seg", "symbols", "edits", "cost"])


class Report:
    """What is known of the conversation that streams past."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.distinct = 0
        self.least = self.most = self.initial = None
        self.audit, self.edits, self.at, self.role, self.lines = [], "", 0, "", 0
        self.digest = hashlib.sha256()

    def segment(self, symbols: str, edits: str, cost: int) -> None:
        self.blank += symbols.count("8")
        self.duplicate += symbols.count("9")
        self.truncated += sum(map(symbols.count, "1357"))
        self.cost += cost
        self.rest()
        self.audit.append(edits)
        self.edits, self.at = edits, 0

    def write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        self.role = role[:1]

    def turned(self) -> str:
        return "assistant" if self.role == "u" else "user"

    def rest(self) -> None:
        """Inserts that no row follows."""
        while self.edits[self.at:self.at + 1] == "I":
            self.write(self.turned(), "")
            self.at += 1

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.most:
                self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        self.rest()
        letter = self.edits[self.at]
        self.at += 1
        if letter != "D":
            self.write(role if letter == "K" else self.turned(), text)

    def result(self) -> tuple:
        self.rest()
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        return (self.conv_id, min(gaps, (1 << 63) - 1), self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def reported(kind: pa.DataType):
    """A ``mapInArrow`` function from markers, segments and rows in order to one report per conversation."""
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                fields = [part.column(n).to_pylist() for n in ("conv_id", "kind", "turn", "role", "text", "cost")]
                for conv, what, turn, role, text, cost in zip(*fields):
                    if what == 0:
                        if now:
                            done.append(now.result())
                        now = Report(conv)
                    elif what == 1:
                        now.segment(role, text, cost)
                    else:
                        now.row(turn, role, text)
                if done:
                    yield packed(done)
                    done = []
        if now:
            yield packed([now.result()])
    return run


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: faults, cheapest cost, edits, and the digest of the repaired rows."""
    given = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = stored(damaged(given).repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("__at", F.monotonically_increasing_id()), "repair-rows")
    cut = segments(rows)
    conv = T.StructField("conv_id", given.schema["conv_id"].dataType)
    seg = [conv, T.StructField("seg", T.LongType()), T.StructField("symbols", T.StringType())]
    behind = T.StructType([*seg, T.StructField("behind", T.IntegerType()), T.StructField("last", T.BooleanType())])
    edited = T.StructType([*seg, T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())])
    edits = (cut.repartition("conv_id").sortWithinPartitions("conv_id", F.col("seg").desc()).mapInArrow(backward, behind)
             .sortWithinPartitions("conv_id", "seg").mapInArrow(forward, edited))
    none = F.lit(None)
    # Markers first, then each segment's edits before its rows.
    stream = (given.select("conv_id").distinct().select(
                  "conv_id", F.lit(-1).cast("long").alias("__at"), F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                  none.cast("string").alias("role"), none.cast("string").alias("text"), none.cast("long").alias("cost"))
              .unionByName(edits.select("conv_id", F.shiftleft("seg", SEGMENT_BITS).alias("__at"), F.lit(1).alias("kind"),
                                        none.cast("long").alias("turn"), F.col("symbols").alias("role"), F.col("edits").alias("text"), "cost"))
              .unionByName(rows.select("conv_id", "__at", F.lit(2).alias("kind"), "turn", "role", "text", none.cast("long").alias("cost"))))
    types = T.StructType([conv, *[T.StructField(n, T.LongType()) for n in RESULT[1:7]], *[T.StructField(n, T.StringType()) for n in RESULT[7:]]])
    from pyspark.sql.pandas.types import to_arrow_type
    return (stream.repartition("conv_id").sortWithinPartitions("conv_id", "__at", "kind")
            .mapInArrow(reported(to_arrow_type(conv.dataType)), types))
