"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on the ``SAMPLE`` vectors with the smallest id hashes (spherical
k-means, ``BRANCHES`` children a node, down to ``LEAF`` sample vectors), so it has
at most SAMPLE / 2 leaves; every vector is then indexed under the leaf it falls to.

A query walks the tree with a priority queue: the node whose centre is most
similar is opened first, and leaves are visited in the order they are popped. The
number of visits is widened until ``VALIDATED`` sample vectors, compared with all
rows by brute force, find ``RECALL`` of their true neighbours; a query goes on
until it has met enough rows for its answer. How far that must be is the data's
matter: vectors without structure need most of the leaves.

Visited leaves are searched as cells of at most ``CELL_ROWS`` vectors and
``CELL_QUERIES`` queries, so a leaf with very many rows or queries is many cells.
Each cell gives a query's best rows, and the best of those are the answer.

Nearness is the cosine in double precision on the original vectors, ties to the
smaller vec_id. Vectors that are NULL, zero, hold a NULL or non-finite component,
or differ in length from most of the sample take no part. Rows with a query's own
vec_id are no candidates; a NULL vec_id is no query, and is no candidate either,
as no result could name it. Repeated query rows are one query.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tellerflow.llm.registry import query
from tellerflow.llm.workers import map_arrow, ship
from tellerflow.operators.sinks import durable

SAMPLE, BRANCHES, LEAF = 20_000, 8, 64
VALIDATED, RECALL = 300, 0.95
CELL_ROWS, CELL_QUERIES = 8_192, 2_048
SAMPLE_NUMBERS = 8_000_000  # components the driver takes for the sample: longer vectors mean fewer of them


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Tree:
    """Centres of all nodes, children of inner nodes, and the leaves' numbers."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF):
        self.centres: list[np.ndarray] = []  # of a node's children
        self.children: list[list[int]] = []
        self.leaf_of: list[int] = []
        self.leaves = 0
        self._grow(_unit(sample) if len(sample) else sample, branches, leaf, np.random.default_rng(11))

    def _grow(self, x: np.ndarray, branches: int, leaf: int, rng: np.random.Generator) -> int:
        node = len(self.children)
        self.centres.append(np.zeros((0, x.shape[1])))
        self.children.append([])
        self.leaf_of.append(-1)
        groups = self._split(x, branches, rng) if len(x) > leaf else []
        if len(groups) < 2:
            self.leaf_of[node] = self.leaves
            self.leaves += 1
            return node
        self.centres[node] = np.stack([c for c, _ in groups])
        self.children[node] = [self._grow(own, branches, leaf, rng) for _, own in groups]
        return node

    @staticmethod
    def _split(x: np.ndarray, branches: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        centres = x[rng.choice(len(x), branches, replace=False)]
        for _ in range(12):
            near = np.argmax(x @ centres.T, 1)
            means = [x[near == k].mean(0) for k in range(len(centres)) if (near == k).any()]
            centres = np.stack([m / (np.linalg.norm(m) or 1.0) for m in means])
        near = np.argmax(x @ centres.T, 1)
        return [(c, x[near == k]) for k, c in enumerate(centres) if (near == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: down to the most similar centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf_of[node] >= 0:
                out[rows] = self.leaf_of[node]
            elif len(rows):
                near = np.argmax(x[rows] @ self.centres[node].T, 1)
                todo += [(child, rows[near == k]) for k, child in enumerate(self.children[node])]
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves for a unit vector, best bin first."""
        queue = [(-2.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf_of[node] >= 0:
                yield self.leaf_of[node]
            else:
                for score, child in zip((self.centres[node] @ q).tolist(), self.children[node]):
                    heapq.heappush(queue, (-score, child))


def _best(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its position, the positions of its k nearest other rows, and their cosines.

    A matrix product finds who can be among them; those are computed again row by
    row, so that equal vectors get equal scores wherever they lie.
    """
    if not len(ids):
        return
    ux, scale = _unit(x), np.abs(x).max(1, keepdims=True)
    small = x / scale
    length = np.sqrt((small * small).sum(1))
    for a in range(0, len(q), 256):
        part = q[a : a + 256] / np.abs(q[a : a + 256]).max(1, keepdims=True)
        lengths = np.sqrt((part * part).sum(1))
        near = (part / lengths[:, None]) @ ux.T
        near[q_ids[a : a + 256, None] == ids[None, :]] = -np.inf
        for i in range(len(part)):
            least = np.partition(near[i], -k)[-k] if len(ids) > k else -np.inf
            rows = np.flatnonzero((near[i] >= least - 1e-9) & (near[i] > -np.inf))
            score = (small[rows] * part[i]).sum(1) / (length[rows] * lengths[i])
            order = np.lexsort((ids[rows], -score))[:k]
            yield a + i, rows[order], score[order]


def usable(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, whatever their length."""
    v = F.col("v")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(fine)


def nearest(vectors: DataFrame, queries, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row where the column ``queries`` (over vec_id) holds."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, vector, vec_id)
    out = StructType([StructField("query_id", LongType()), StructField("rank", IntegerType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])
    lengths = rows.select("vec_id", F.size("v").alias("d")).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).groupBy("d").count().collect()
    if not lengths:
        return spark.createDataFrame([], out)
    width = max(lengths, key=lambda r: (r["count"], -r.d)).d
    rows = rows.where(F.size("v") == width)
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(2, min(SAMPLE, SAMPLE_NUMBERS // width))).toArrow()
    sample, sample_ids = _matrix(first.column("v")), first.column("vec_id").to_numpy()
    tree = spark.sparkContext.broadcast(Tree(sample))  # of bounded size, as the sample is

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.assign(_unit(_matrix(batch.column("v")))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("vec_id"), batch.column("v")], names=["leaf", "vec_id", "v"])

    vector_type = StructField("v", ArrayType(DoubleType()))
    index = durable(map_arrow(rows, place, StructType([StructField("leaf", LongType()), StructField("vec_id", LongType()), vector_type])), "ann-index")
    sizes = {r.leaf: r["count"] for r in index.groupBy("leaf").count().collect()}  # a row per leaf
    visits = _calibrated(index, tree.value, sample_ids[:VALIDATED], sample[:VALIDATED], k, recall)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _unit(_matrix(batch.column("v"))) if batch.num_rows else []
            at, leaves = [], []
            for i, own in enumerate(q):
                met = 0
                for n, leaf in enumerate(tree.value.visits(own), 1):
                    at.append(i)
                    leaves.append(leaf)
                    met += sizes.get(leaf, 0)
                    if n >= visits and met > k:
                        break
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), batch.column("vec_id").take(pick), batch.column("v").take(pick)], names=["leaf", "query_id", "v"])

    asked = index.where(queries).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    asked = durable(map_arrow(asked, walk, StructType([StructField("leaf", LongType()), StructField("query_id", LongType()), vector_type])), "ann-visits")
    busy = {r.leaf: r["count"] for r in asked.groupBy("leaf").count().collect()}
    cells = spark.createDataFrame(
        [(leaf, -(-sizes[leaf] // CELL_ROWS), -(-busy[leaf] // CELL_QUERIES)) for leaf in sizes if leaf in busy] or [(-1, 1, 1)], "leaf long, rows int, queries int"
    )

    def parts(name: str):
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    own = index.join(F.broadcast(cells), "leaf").select("leaf", F.pmod(F.xxhash64("vec_id"), "rows").cast("int").alias("i"), parts("queries").alias("j"), "vec_id", "v")
    other = asked.join(F.broadcast(cells), "leaf").select("leaf", F.pmod(F.xxhash64("query_id"), "queries").cast("int").alias("j"), parts("rows").alias("i"), "query_id", "v")

    def search(cell: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, q_ids = cell.column("vec_id").to_numpy(), wanted.column("query_id").to_numpy()
        found = [(q, r, s) for q, r, s in _best(ids, _matrix(cell.column("v")), q_ids, _matrix(wanted.column("v")), k)]
        whose = np.repeat(q_ids[[f[0] for f in found]], [len(f[1]) for f in found]) if found else np.zeros(0, np.int64)
        near = ids[np.concatenate([f[1] for f in found])] if found else np.zeros(0, np.int64)
        return pa.table({"query_id": whose, "vec_id": near, "score": np.concatenate([f[2] for f in found]) if found else np.zeros(0)})

    keys = ["leaf", "i", "j"]
    best = own.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    return _ranked(best, k)


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrated(index: DataFrame, tree: Tree, ids: np.ndarray, q: np.ndarray, k: int, recall: float) -> int:
    """Leaf visits that find ``recall`` of the true k nearest of the vectors ``q``, whose truth is searched among all rows."""

    def brute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            for i, rows, score in _best(own, _matrix(batch.column("v")), ids, q, k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), i)), pa.array(own[rows]), pa.array(score), pa.array(leaf[rows])], names=["query_id", "vec_id", "score", "leaf"]
                )

    schema = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType()), StructField("leaf", LongType())])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = map_arrow(index, brute, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect()
    if not true:
        return 1
    places = [{leaf: n for n, leaf in enumerate(tree.visits(u), 1)} for u in _unit(q)]
    needed = Counter(places[r.query_id][r.leaf] for r in true)
    found, visits = 0, 0
    while found < recall * len(true):  # widen by one leaf
        visits += 1
        found += needed[visits]
    return visits


@query("op9_nearest_neighbours")
def op9(spark, folder):
    return nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
