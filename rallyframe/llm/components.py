"""Connected components of an edge table by alternating large and small stars, without collecting edges or components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch

#: Edges that one task contracts to stars in memory before the rounds.
CONTRACTED = 200_000


def stars(pairs) -> list[tuple[int, int]]:
    """(node, smallest node of its component) of all nodes but the smallest ones."""
    parent: dict[int, int] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in list(parent) if (r := root(x)) != x]


def _contract(batches):
    def pairs():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    got = stars(pairs())
    for i in range(0, len(got), 50_000):
        part = got[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], type=pa.int64()), pa.array([x for _, x in part], type=pa.int64())], names=["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """(a, b): each node of ``edges`` (a, b longs) that is not the smallest of its component, with the smallest.

    An empty table gives an empty table; loops and repeated edges are ignored.
    """
    with scratch(edges.sparkSession) as keep:
        edges = edges.select("a", "b").where("a <> b")
        parts = -(-edges.count() // CONTRACTED)
        now = materialise(edges.repartition(max(1, parts)).mapInArrow(_contract, "a long, b long"), "stars")
        state = _state(now)
        while parts > 1:
            both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("low"))
            large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
            down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
            low = down.groupBy("a").agg(F.min("b").alias("low"))
            small = down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            now, before = materialise(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "stars"), state
            state = _state(now)
            if state == before:
                break
        return keep(now)


def _state(stars_: DataFrame):
    """Number and sum of hashes of the rows, to tell whether a round changed any."""
    return stars_.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
