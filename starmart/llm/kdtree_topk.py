"""Exact top-k search by inner product with a KD-tree per shard.

Rows are dealt to shards by a hash. Each shard becomes one tree: median splits along the widest side, and at every
node the tight bounding box of its rows. A box bounds the inner product of a query from above (each component takes
the better of the box's two ends), so a best-first traversal opens the node with the best bound next and ends when no
bound beats the k-th score. Queries go in blocks. Every block first searches one shard; the k-th scores found there
travel with it to all other shards, where they end most traversals early. Blocks meet trees by a join on the shard
id; neither side is held whole anywhere, and what a block brings back is at most k rows a query and shard.

Scores are integers and ties go to the smaller id; bounds that equal the k-th score are followed as long as the node
holds a smaller id.

Scores beyond 64 bits become the nearest number of 64 bits, and such scores tie.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
filled with zeros; rows with the query's own id are not its candidates; repeated rows of other ids are separate
candidates; a query repeated as a row is answered once for each row; a null id takes no part; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.common import stored

LEAF = 256
SHARD_ROWS = 4096
BLOCK_ROWS = 512

#: Larger components count as this one; a score of such a component is beyond 64 bits in any case.
HUGE = 1e300

FOUND = "query_id long, query_row long, vec_id long, score long"


def components(vectors: pd.Series, dims: int = 0) -> np.ndarray:
    """A matrix of whole numbers: doubles where all inner products are exact, else Python integers."""
    dims = max(dims, max(map(len, vectors), default=0))
    rows = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        rows[i, :len(v)] = v
    return rows


def exact(rows: np.ndarray) -> np.ndarray:
    return rows if not rows.size or np.abs(rows).max() < 2 ** 20 and rows.shape[1] < 2 ** 12 else whole(rows)


def whole(rows: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in rows.ravel()], dtype=object).reshape(rows.shape)


def in_64_bits(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, -1 << 63, (1 << 63) - 1) if scores.dtype == object else scores


class Tree:
    """Nodes in arrays: children, slice of rows, box, least id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.left, self.right, self.slices, low, high, least = [], [], [], [], [], []

        def grow(start: int, stop: int) -> int:
            node, part = len(self.slices), order[start:stop]
            box = rows[part]
            self.left.append(-1)
            self.right.append(-1)
            self.slices.append((start, stop))
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            least.append(ids[part].min())
            side = high[node] - low[node]
            if stop - start > leaf:
                # Rows that agree in every component are cut by id, so boxes of equal rows differ in their least id.
                by = ids[part] if not side.any() else box[:, int(side.argmax())]
                middle = (stop - start) // 2
                order[start:stop] = part[np.argpartition(by, middle)]
                self.left[node] = grow(start, start + middle)
                self.right[node] = grow(start + middle, stop)
            return node

        if len(ids):
            grow(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high, self.least = np.array(low), np.array(high), least

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return in_64_bits(np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, floor) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows that reach ``floor``, none of them with the id ``own``."""
        ids, scores = np.empty(0, np.int64), np.empty(0, self.rows.dtype)
        kth, kth_id = float(floor), None  # compares with integers of any size
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            bound = -bound
            if bound < kth:
                break
            if bound == kth and kth_id is not None and self.least[node] > kth_id:
                continue
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, stop = self.slices[node]
            leaf = in_64_bits(self.rows[start:stop] @ query)
            good = np.flatnonzero((leaf >= kth) & (self.ids[start:stop] != own))
            if not len(good):
                continue
            ids, scores = np.concatenate([ids, self.ids[start + good]]), np.concatenate([scores, leaf[good]])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                worst = np.lexsort((ids, -scores))[-1]
                kth, kth_id = scores[worst], ids[worst]
        return ids, scores


def build(shard: pd.DataFrame) -> pd.DataFrame:
    tree = Tree(shard["vec_id"].to_numpy(np.int64), exact(components(shard["vector"])))
    return pd.DataFrame({"shard": [shard["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})


def pack_block(rows: pd.DataFrame) -> pd.DataFrame:
    block = (rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64), components(rows["vector"]),
             np.full(len(rows), -np.inf))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "queries": [pickle.dumps(block)]})


def searcher(k: int):
    """Blocks that met a shard: the best rows of each of their queries there."""
    def run(batches):
        for pairs in batches:
            for raw_tree, raw_queries in zip(pairs["tree"], pairs["queries"]):
                tree, (ids, row, vectors, floors) = pickle.loads(raw_tree), pickle.loads(raw_queries)
                dims = max(tree.rows.shape[1], vectors.shape[1])
                if dims > tree.rows.shape[1]:  # missing components are zeros and score nothing
                    vectors = vectors[:, :tree.rows.shape[1]]
                elif dims > vectors.shape[1]:
                    vectors = np.pad(vectors, ((0, 0), (0, dims - vectors.shape[1])))
                vectors = exact(vectors)
                if object in (vectors.dtype, tree.rows.dtype):  # doubles are exact only among themselves
                    vectors = whole(vectors)
                    tree.rows, tree.low, tree.high = whole(tree.rows), whole(tree.low), whole(tree.high)
                bounds = tree.bounds(vectors)
                found = [tree.search(q, own, b, k, floor) for q, own, b, floor in zip(vectors, ids, bounds, floors)]
                n = [len(f[0]) for f in found]
                yield pd.DataFrame({
                    "query_id": np.repeat(ids, n), "query_row": np.repeat(row, n),
                    "vec_id": np.concatenate([f[0] for f in found]), "score": np.concatenate([f[1] for f in found]).astype(np.int64)})
    return run


def with_floors(k: int):
    """Put the k-th scores found so far into the blocks they belong to."""
    def run(key, blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        for i, raw in enumerate(blocks["queries"]):
            ids, row, vectors, floors = pickle.loads(raw)
            full = found.groupby("query_row")["score"].agg(lambda s: np.sort(s)[-k] if len(s) >= k else -np.inf)
            full = full.reindex(row).fillna(-np.inf).to_numpy(float)
            full = np.where(np.abs(full) >= 2.0 ** 53, np.nextafter(full, -np.inf), full)  # not rounded up
            floors = np.maximum(floors, full)
            blocks.at[i, "queries"] = pickle.dumps((ids, row, vectors, floors))
        return blocks[["block", "queries"]]
    return run


def search(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0,
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with ``is_query(id)``, the k best of all other rows.

    Components are ``floor(scale * x)``; pass ``scale=None`` for vectors of whole numbers.
    """
    def value(x):
        if scale is None:
            return x.cast("double")
        scaled = F.greatest(F.least(x.cast("double") * scale, F.lit(HUGE)), F.lit(-HUGE))
        return F.when(F.abs(scaled) < 2.0 ** 53, F.floor(scaled).cast("double")).otherwise(scaled)  # beyond, all are whole
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == infinite))
    rows = stored(
        vectors.where(F.col(vector).isNotNull() & ~bad & F.col(vec_id).isNotNull())
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, value).alias("vector")), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    trees = stored(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)))
                   .groupBy("shard").applyInPandas(build, "shard long, tree binary"), "trees", "none")
    queries = rows.where(is_query(F.col("vec_id"))).withColumn("row", F.monotonically_increasing_id())
    blocks = max(1, -(-queries.count() // block_rows))
    packed = stored(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)))
                    .groupBy("block").applyInPandas(pack_block, "block long, queries binary"), "queries")
    home = F.pmod(F.col("block"), F.lit(shards))
    run = searcher(k)
    first = stored(packed.withColumn("shard", home).join(trees, "shard").select("tree", "queries")
                   .mapInPandas(run, FOUND), "found")
    block_of = F.pmod(F.xxhash64(F.col("query_id").alias("vec_id"), F.col("query_row").alias("row")), F.lit(blocks))
    bounded = packed.groupBy("block").cogroup(first.withColumn("block", block_of).groupBy("block")).applyInPandas(
        with_floors(k), "block long, queries binary")
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != home)
    rest = (bounded.withColumn("shard", F.explode(others)).join(trees, "shard").select("tree", "queries")
            .mapInPandas(run, FOUND))
    best = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
