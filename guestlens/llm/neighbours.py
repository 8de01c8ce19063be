"""Nearest neighbours by inner product, with vantage-point trees per shard.

Inner products become distances by one more coordinate: with M the longest norm,
a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0), and then
|q' - x'|^2 = M^2 + |q|^2 - 2 q.x. Each shard of vectors is a tree: a node's
vantage point splits the rest by distance into an inner and an outer half. A half
is left out for a query if the triangle inequality says that it holds nothing
nearer than the best found so far. `factor` relaxes that: the best distance
counts as factor times itself, so smaller values leave more out, and 1 is exact.

Equal vectors are one entry of the tree with their smallest ids, as many as could
ever be asked for, so a vector on a third of all rows costs nothing. Queries come
in blocks; every block meets every shard, as each query is against all rows. A
task works on one block and one shard.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored

NEAREST = 20
#: Vectors per shard and queries per block, which bound what a task holds.
SHARD, QUERIES = 8192, 4096
#: Vectors per leaf of a tree.
LEAF = 256
#: Relaxation of the pruning; 1 is exact.
FACTOR = 0.9


def tree(points: np.ndarray, places: np.ndarray | None = None) -> tuple:
    """(places,) for a leaf, else (vantage place, radius, inner, outer).

    The vantage point belongs to its inner half.
    """
    places = np.arange(len(points)) if places is None else places
    if len(places) <= LEAF:
        return (places,)
    middle = points[places].mean(axis=0)
    vantage = int(places[((points[places] - middle) ** 2).sum(axis=1).argmax()])
    away = np.sqrt(((points[places] - points[vantage]) ** 2).sum(axis=1))
    order = away.argsort(kind="stable")
    half = len(places) // 2
    radius = float(away[order[half]])
    return vantage, radius, tree(points, places[order[:half]]), tree(points, places[order[half:]])


class _Best:
    """The best k entries per query, by inner product, then by place."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.place = np.full((n, k), -1, dtype=np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, places: np.ndarray) -> None:
        k = self.score.shape[1]
        at, column = np.nonzero(scores >= self.score[rows, -1][:, None])
        if not len(at):
            return
        some, at_some = np.unique(at, return_inverse=True)
        held = rows[some]
        row = np.concatenate([np.repeat(np.arange(len(some)), k), at_some])
        score = np.concatenate([self.score[held].ravel(), scores[at, column]])
        place = np.concatenate([self.place[held].ravel(), places[column]])
        order = np.lexsort((place, -score, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(len(some)))
        order = order[np.arange(len(row)) - first[row] < k]
        self.score[held] = score[order].reshape(-1, k)
        self.place[held] = place[order].reshape(-1, k)


def search(root: tuple, vectors: np.ndarray, points: np.ndarray, longest: float, queries: np.ndarray, k: int, factor: float) -> _Best:
    """The best k places of the tree for each query, all queries at a time."""
    best = _Best(len(queries), k)
    norms = (queries**2).sum(axis=1)
    to_point = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)

    def reach(rows: np.ndarray) -> np.ndarray:
        """Relaxed distance within which something better may lie."""
        limit = np.maximum(0, longest**2 + norms[rows] - 2 * best.score[rows, -1])
        return factor * np.sqrt(limit) + 1e-9 * (1 + longest)

    def visit(node: tuple, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if len(node) == 1:
            best.add(rows, queries[rows] @ vectors[node[0]].T, node[0])
            return
        vantage, radius, inner, outer = node
        away = np.sqrt(((to_point[rows] - points[vantage]) ** 2).sum(axis=1))
        near = away < radius
        visit(inner, rows[near])
        visit(outer, rows[~near])
        later = near & (radius - away <= reach(rows))
        visit(outer, rows[later])
        later = ~near & (away - radius <= reach(rows))
        visit(inner, rows[later])

    visit(root, np.arange(len(queries)))
    return best


def _usable(rows: DataFrame) -> DataFrame:
    """vec_id, vector (doubles): rows with an id and a finite vector that is not zero."""
    vector = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # and -0 becomes 0
    rows = rows.select("vec_id", vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows found, but its own.

    rows and queries have vec_id and embedding. Nearness is the inner product in
    double precision of the vectors as given; ties go to the smaller vec_id.

    Defined cases: vectors that are null, zero, or hold null or non-finite
    components, and rows without an id, take no part; vectors of different
    lengths are never compared; rows that repeat in vec_id and vector count once;
    rows with a query's vec_id are its own; fewer candidates than k give all of
    them; no rows give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    ids = Window.partitionBy("vector").orderBy("vec_id")
    some = _usable(rows).dropDuplicates(["vec_id", "vector"])
    # The smallest k + 1 ids of each vector, chosen per task before the shuffle.
    some = some.withColumn("n", F.row_number().over(ids)).where(F.col("n") <= k + 1)
    entries = some.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries.withColumn("width", F.size("vector")), "vectors")
    asked = stored(_usable(queries).dropDuplicates(["vec_id", "vector"]).withColumn("width", F.size("vector")), "queries")

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    longest = entries.agg(F.max(norm)).first()[0] or 0.0
    shards = -(-entries.count() // SHARD) or 1
    blocks = -(-asked.count() // QUERIES) or 1

    def index(table: pa.Table) -> pa.Table:
        width, shard = table.column("width")[0].as_py(), table.column("shard")[0].as_py()
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width)
        # In order of the smallest id, so that equal scores keep that order.
        names = table.column("ids").to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i][0])
        vectors = vectors[order]
        last = np.sqrt(np.maximum(0, longest**2 - (vectors**2).sum(axis=1)))
        points = np.concatenate([vectors, last[:, None]], axis=1)
        held = pickle.dumps((tree(points), vectors, points, [names[i] for i in order]))
        return pa.table({"width": pa.array([width], pa.int32()), "shard": pa.array([shard], pa.int64()), "held": pa.array([held], pa.binary())})

    def block(table: pa.Table) -> pa.Table:
        width, number = table.column("width")[0].as_py(), table.column("block")[0].as_py()
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width)
        held = pickle.dumps((table.column("vec_id").to_pylist(), vectors))
        return pa.table({"width": pa.array([width], pa.int32()), "block": pa.array([number], pa.int64()), "asked": pa.array([held], pa.binary())})

    of_shard = F.pmod(F.xxhash64("vector"), F.lit(shards))
    of_block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))
    trees = entries.withColumn("shard", of_shard).groupBy("width", "shard").applyInArrow(index, "width int, shard long, held binary")
    asking = asked.withColumn("block", of_block).groupBy("width", "block").applyInArrow(block, "width int, block long, asked binary")
    trees, asking = stored(trees, "vantage-trees"), stored(asking, "query-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                root, vectors, points, names = pickle.loads(batch.column("held")[i].as_py())
                own, wanted = pickle.loads(batch.column("asked")[i].as_py())
                # One more than asked for: the query's own vector may be among them.
                yield _found(search(root, vectors, points, longest, wanted, k + 1, factor), vectors, names, own, wanted, k)

    # Blocks of queries against shards: the numbers of each are all that is joined.
    pairs = asking.withColumn("shard", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")))
    met = pairs.join(trees, ["width", "shard"]).select("asked", "held").repartition(shards * blocks)
    found = met.mapInArrow(run, "query_id long, vec_id array<bigint>, score array<double>")
    each = found.select("query_id", F.explode(F.arrays_zip("vec_id", "score")).alias("x")).select("query_id", "x.vec_id", "x.score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _found(best: _Best, vectors: np.ndarray, names: list[list[int]], own: list[int], wanted: np.ndarray, k: int) -> pa.RecordBatch:
    """The best k rows per query of one shard, with scores summed in one fixed
    order, so that equal vectors score alike wherever they lie."""
    ids, scores = [], []
    for row, query in enumerate(own):
        places = best.place[row][best.place[row] >= 0]
        exact = (vectors[places] * wanted[row]).sum(axis=1).tolist()
        rows = sorted((-s, name) for s, p in zip(exact, places.tolist()) for name in names[p] if name != query)[:k]
        ids.append([name for _, name in rows])
        scores.append([-s for s, _ in rows])
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))],
        names=["query_id", "vec_id", "score"],
    )
