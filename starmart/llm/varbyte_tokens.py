"""Token ids in files: frequency-ranked, byte-aligned, variable length, with the lengths apart from the bytes.

Ids are counted over the whole corpus and replaced by their rank, so the most frequent take one byte. A segment holds
the documents of one stretch of the order: a header (``SVB1``, number of documents, number of ids), the number of ids
of each document, control bytes with two bits per id (its bytes less one), and the bytes of all ranks, lowest first.
Decoding looks the four lengths of each control byte up in a table. Segments are rows of a Parquet table
(``segments``), the rank table is another (``ranks``): Spark's writers commit them, so files of lost tasks never count,
and any store that Spark reads will do.

Documents are in ascending id order, null ids first, by a range exchange; no task holds more than one range, and
positions over ranges come from one count per range.

Defined results: null or empty text has the end id alone; equal rows are separate documents; an empty table gives
empty files and an empty result; texts of any length are whole; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from starmart.llm.common import stored
from starmart.llm.tokens import binary, encode_batches, encoder

MAGIC = b"SVB1"
HEADER = np.dtype([("magic", "S4"), ("docs", "<u4"), ("ids", "<u8")])
SEGMENT_DOCS = 2048
SEGMENT_IDS = 1 << 20

#: Lengths of the four values behind each control byte, and their sum.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> bytes:
    """Control bytes, then data bytes."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8)
    width = 2 if ranks.max(initial=0) <= 0xFFFF else 4
    if width == 4:
        extra += ranks > 0xFFFF
        extra += ranks > 0xFFFFFF
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    data = ranks.astype(f"<u{width}").view(np.uint8)[(np.arange(width) <= extra[:, None]).ravel()]
    return control.tobytes() + data.tobytes()


def decode_ranks(raw: bytes | memoryview, n: int) -> np.ndarray:
    control = np.frombuffer(raw, np.uint8, -(-n // 4))
    data = np.frombuffer(raw, np.uint8, offset=len(control))
    lengths = LENGTHS[control].ravel()[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    ranks = data[starts].astype(np.uint32)
    for byte in range(1, lengths.max(initial=0)):
        has = np.flatnonzero(lengths > byte)
        ranks[has] |= data[starts[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def segment(counts: np.ndarray, ranks: np.ndarray) -> bytes:
    head = np.array((MAGIC, len(counts), len(ranks)), HEADER)
    return head.tobytes() + counts.astype("<u4").tobytes() + encode_ranks(ranks)


def read_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each document, and all ranks."""
    head = np.frombuffer(raw, HEADER, 1)[0]
    if head["magic"] != MAGIC:
        raise ValueError("not a token segment")
    docs, ids = int(head["docs"]), int(head["ids"])
    counts = np.frombuffer(raw, "<u4", docs, HEADER.itemsize)
    return counts, decode_ranks(memoryview(raw)[HEADER.itemsize + 4 * docs:], ids)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id",
                 text: str = "text") -> None:
    """Encode every text, append ``end_id``, write ``path/segments`` and ``path/ranks``."""
    spark = docs.sparkSession
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = encoder(tokenizer)
    vocabulary, dtype = max(own.tokenizer.get_vocab_size(), end_id + 1), own.dtype
    schema = StructType([inner.schema["doc_id"], StructField("ids", BinaryType())])
    arrow = to_arrow_schema(schema)

    def emit(rows, ids, offsets):
        return pa.table([rows.column("doc_id"), binary(ids, offsets)], schema.names).cast(arrow)

    tokens = stored(inner.mapInArrow(encode_batches(tokenizer, "text", end_id, emit), schema), "tokens")

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            _, offsets, data = column.buffers()
            bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
            if len(column) and bounds[-1] > bounds[0]:
                total += np.bincount(np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]].view(dtype), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # No more rows than the vocabulary has ids.
    order = [r["id"] for r in counts.orderBy(F.desc("n"), "id").select("id").toLocalIterator()]
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(vocabulary, np.uint32)
    rank_of[order] = np.arange(len(order))

    out = StructType([
        StructField("part", LongType()), StructField("segment", LongType()), StructField("start", LongType()),
        StructField("n_ids", LongType()), StructField("doc_ids", ArrayType(inner.schema["doc_id"].dataType)),
        StructField("payload", BinaryType())])
    arrow_out = to_arrow_schema(out)

    def segments(batches):
        part, number, start = TaskContext.get().partitionId(), 0, 0
        keys, bodies, held = [], [], 0

        def flush():
            nonlocal keys, bodies, held, number, start
            sizes = np.array([len(b) // dtype.itemsize for b in bodies])
            payload = segment(sizes, rank_of[np.frombuffer(b"".join(bodies), dtype)])
            row = pa.table([[part], [number], [start], [int(sizes.sum())], [keys], [payload]], out.names).cast(arrow_out)
            number, start = number + 1, start + int(sizes.sum())
            keys, bodies, held = [], [], 0
            return row.to_batches()

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                keys.append(key)
                bodies.append(ids)
                held += len(ids) // dtype.itemsize
                if len(keys) >= SEGMENT_DOCS or held >= SEGMENT_IDS:
                    yield from flush()
        if keys:
            yield from flush()

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(segments, out).write.option("compression", "none").parquet(f"{path}/segments")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers) of every document in the files."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()  # bounded by the vocabulary
    id_of = ranks["id"].to_numpy().astype("<u4")
    files = spark.read.parquet(f"{path}/segments")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("__n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("before"))
    placed = files.join(starts, "part").select((F.col("start") + F.col("before")).alias("start"), "doc_ids", "payload")
    key = StructField("doc_id", files.schema["doc_ids"].dataType.elementType)
    out = StructType([key, StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    arrow = to_arrow_schema(out)

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                counts, ranks = read_segment(one.column("payload")[0].as_py())
                ids = id_of[ranks]
                stops = np.cumsum(counts.astype(np.int64))
                yield from pa.table([
                    one.column("doc_ids").values.slice(one.column("doc_ids").offsets[0].as_py(), len(counts)),
                    pa.array(one.column("start")[0].as_py() + stops - counts), pa.array(counts.astype(np.int64)),
                    binary(ids, np.append(0, stops))], out.names).cast(arrow).to_batches()
    return placed.mapInArrow(read, out)


def ids_crc32(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids."""
    out = StructType([*read.schema.fields[:3], StructField("ids_crc32", LongType())])
    arrow = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            crc = pa.array([zlib.crc32(x) for x in b.column("ids").to_pylist()], pa.int64())
            yield from pa.table([*b.columns[:3], crc], out.names).cast(arrow).to_batches()
    return read.mapInArrow(run, out)
