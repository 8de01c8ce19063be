"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored


def forest(a: list[bytes], b: list[bytes]) -> list[tuple[bytes, bytes]]:
    """(node, smallest node of its component) of these links, without the latter."""
    above: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        path = []
        while (y := above.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            above[p] = x
        return x

    for x, y in zip(a, b):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in list(above)]


#: Links that a task holds at once.
HELD = 100_000


def _shorter(links: DataFrame) -> DataFrame:
    """The same components with fewer links: what a task holds becomes a forest."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[bytes] = []
        b: list[bytes] = []

        def trees() -> pa.RecordBatch:
            found = forest(a, b)
            a.clear()
            b.clear()
            columns = [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            a += batch.column("a").to_pylist()
            b += batch.column("b").to_pylist()
            if len(a) >= HELD:
                yield trees()
        yield trees()

    ship(links.sparkSession)
    return links.mapInArrow(shorten, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """a, b (binary) -> node, root: every node that has a link, and its component.

    In each round a node points to the smallest of itself and its neighbours, and
    links are redrawn between the nodes pointed to. Nodes are hashes, so their
    order is random and each round leaves a fraction of them. All steps are joins
    and sums per node; a node's links are never gathered.
    """
    edges = stored(_shorter(links.where("a != b")).distinct(), "links")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stored(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("to")), "contraction")
        if labels is None:
            labels = to.select("node", F.col("to").alias("root"))
        else:
            step = to.select(F.col("node").alias("from"), "to")
            labels = labels.join(step, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = stored(labels, "labels")
        left = to.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = to.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        redrawn = edges.join(left, "a").join(right, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a != b")
        edges = stored(_shorter(redrawn).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
