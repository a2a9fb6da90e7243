"""Approximate nearest neighbours (operator 8) with a hierarchical k-means tree.

``fit_tree`` builds the tree on a bounded sample (``sample_rows`` vectors, and at
most ``SAMPLE_BYTES`` of them); the tree is the only thing broadcast.  Every row
is indexed: it descends to the leaf of its nearest centres.  A query visits
leaves best-bin-first: a priority queue holds the branches passed by, nearest
centre first.  The number of leaves is calibrated: a bounded sample of queries
is answered exactly against all rows, and the visits widen leaf by leaf until
the leaves seen hold the wanted share of the true neighbours.

Each leaf is split into blocks of about ``block_rows`` rows and its queries
into blocks of ``block_queries``, from counts, so a leaf that holds a third of
all rows (copies of one vector, say) becomes many small groups.  Within a group
the distances of all its queries and rows are computed in slices; each query's
best ``k`` go on.  Scores are Euclidean distances in double precision between
the original vectors, ties go to the smaller id.

Vectors that are null, zero, of a length other than the most frequent one, or hold a null or
non-finite component take no part, nor do rows without an id.  Repeated ids are
separate candidates but one query.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 32 << 20
_FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Node ``i`` has ``centres[i]`` and ``children[i]``; a child below zero is the leaf ``-child - 1``."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), dtype=np.int64)
        if not self.centres:
            return out
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            nearest = _squares(x[rows], self.centres[node]).argmin(axis=1)
            for j, child in enumerate(self.children[node]):
                some = rows[nearest == j]
                if not len(some):
                    continue
                if child < 0:
                    out[some] = -child - 1
                else:
                    todo.append((child, some))
        return out

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        if not self.centres:
            yield 0
            return
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -node - 1
                continue
            for d, child in zip(_squares(q[None], self.centres[node])[0].tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (d, child))


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Label of each row; fewer than ``k`` labels where rows coincide."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        labels = _squares(x, centres).argmin(1)
        centres = np.array([x[labels == j].mean(0) if (labels == j).any() else centres[j] for j in range(k)])
    return _squares(x, centres).argmin(1)


def fit_tree(x: np.ndarray, branching: int = 12, leaf_rows: int = 64, seed: int = 7) -> Tree:
    """Hierarchical k-means: nodes split until at most ``leaf_rows`` sample rows are left."""
    rng = np.random.default_rng(seed)
    tree = Tree()

    def grow(rows: np.ndarray) -> int:
        labels = _kmeans(x[rows], min(branching, len(rows)), rng) if len(rows) > leaf_rows else np.zeros(len(rows))
        parts = [rows[labels == j] for j in np.unique(labels)]
        if len(parts) < 2:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(np.array([x[p].mean(0) for p in parts]))
        tree.children.append([])
        tree.children[node] = [grow(p) for p in parts]
        return node

    if len(x) > leaf_rows:
        grow(np.arange(len(x)))
    tree.leaves = max(tree.leaves, 1)
    if not tree.centres:
        tree.leaves = 1
    return tree


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part, as arrays of double."""
    v = F.col("v")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].n if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def top_k(queries: np.ndarray, ids: np.ndarray, x: np.ndarray, vec_ids: np.ndarray, k: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact ``k`` nearest rows of each query, its own id left out: (query_id, vec_id, score)."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    norms = (x * x).sum(1)
    step = max(1, (4 << 20) // max(1, len(x)))
    for lo in range(0, len(queries), step):
        some = queries[lo:lo + step]
        rough = norms[None, :] + (some * some).sum(1)[:, None] - 2 * (some @ x.T)
        rough[ids[lo:lo + step, None] == vec_ids[None, :]] = np.inf
        last = min(k, len(x)) - 1
        bound = np.partition(rough, last, axis=1)[:, last]
        # rounding of the rough form: a margin relative to the norms, then the exact distances decide
        slack = 1e-9 * (norms.max(initial=0.0) + (some * some).sum(1))
        for i in range(len(some)):
            near = np.flatnonzero(rough[i] <= bound[i] + slack[i]) if np.isfinite(bound[i]) else np.flatnonzero(
                np.isfinite(rough[i]))
            score = np.empty(len(near))
            for a in range(0, len(near), 65_536):  # ties may be many
                score[a:a + 65_536] = np.sqrt(((x[near[a:a + 65_536]] - some[i]) ** 2).sum(1))
            order = np.lexsort((vec_ids[near], score))[:k]
            out.append((np.full(len(order), ids[lo + i]), vec_ids[near[order]], score[order]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query's rows, ranked."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def exact_nearest(rows: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """Exact answers of a bounded set of queries: one pass over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cols = top_k(queries, ids, _matrix(b.column(1)), b.column(0).to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["query_id", "vec_id", "score"])

    return _best(rows.select("vec_id", "v").mapInArrow(run, _FOUND), k)


def calibrate(tree: Tree, rows: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int, recall: float) -> int:
    """Leaves to visit so that the sample queries' true neighbours are seen with the given recall."""
    truth = exact_nearest(rows, queries, ids, k).select("query_id", "vec_id")
    near = truth.join(rows, "vec_id").select("query_id", "v").collect()  # k rows per sample query
    if not near:
        return 1
    leaf = tree.assign(np.array([r.v for r in near]))
    order = {int(i): {x: n for n, x in enumerate(tree.visit(q))} for i, q in zip(ids, queries, strict=True)}
    ranks = np.array([order[r.query_id][x] for r, x in zip(near, leaf.tolist(), strict=True)])
    visits = 1
    while (ranks < visits).mean() < recall:
        visits += 1
    return visits


def nearest(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 10, recall: float = 0.97, sample_rows: int = SAMPLE_ROWS, calibration_queries: int = 200,
            block_rows: int = 20_000, block_queries: int = 1_000) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row where ``is_query`` (on ``vec_id``)."""
    rows = usable(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    first = rows.select(F.size("v")).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    bounded = max(1, min(sample_rows, SAMPLE_BYTES // (8 * first[0][0])))
    by_hash = (F.xxhash64("vec_id"), F.col("vec_id"))
    sample = rows.orderBy(*by_hash).limit(bounded).select("v").collect()
    tree = fit_tree(np.array([r.v for r in sample]))
    asked = rows.where(is_query).dropDuplicates(["vec_id"])
    some = asked.orderBy(*by_hash).limit(calibration_queries).collect()
    if not some:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    visits = calibrate(tree, rows, np.array([r.v for r in some]), np.array([r.vec_id for r in some]), k, recall)

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.assign(_matrix(b.column(1)))), b.column(0), b.column(1)],
                    ["leaf", "vec_id", "v"])

    indexed = rows.select("vec_id", "v").mapInArrow(to_leaf, "leaf long, vec_id long, v array<double>")
    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # one row per leaf

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, leaves = [], []
            for i, q in enumerate(_matrix(b.column(1))):
                seen = 0
                for n, leaf in enumerate(tree.visit(q)):
                    if n >= visits and seen > k:
                        break
                    if leaf in sizes:
                        seen += sizes[leaf]
                        at.append(i)
                        leaves.append(leaf)
            if at:
                index = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), b.column(0).take(index),
                                                  b.column(1).take(index)], ["leaf", "query_id", "q"])

    visiting = asked.select("vec_id", "v").mapInArrow(to_visits, "leaf long, query_id long, q array<double>")
    load = {r.leaf: r["count"] for r in visiting.groupBy("leaf").count().collect()}
    shape = spark.createDataFrame(
        [(leaf, -(-n // block_rows), -(-load[leaf] // block_queries)) for leaf, n in sizes.items() if leaf in load],
        "leaf long, row_blocks long, query_blocks long")

    def blocked(side: DataFrame, key: str, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        return (side.join(F.broadcast(shape), "leaf")  # one row per leaf
                .withColumn(own_block, F.pmod(F.xxhash64(key), F.col(own)))
                .withColumn(other_block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
                .drop("row_blocks", "query_blocks"))

    left = blocked(visiting, "query_id", "query_blocks", "row_blocks", "qb", "rb")
    right = blocked(indexed, "vec_id", "row_blocks", "query_blocks", "rb", "qb")

    def compare(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not queries.num_rows or not block.num_rows:
            cols = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        else:
            q, x = queries.combine_chunks(), block.combine_chunks()
            cols = top_k(_matrix(q["q"].chunk(0)), q["query_id"].to_numpy(), _matrix(x["v"].chunk(0)),
                         x["vec_id"].to_numpy(), k)
        return pa.table([pa.array(c) for c in cols], ["query_id", "vec_id", "score"])

    keys = ["leaf", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, _FOUND)
    return _best(found, k)
