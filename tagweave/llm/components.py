"""Connected components of links between ids: union-find inside partitions, stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import stage

PART_LINKS = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a part become a star for each of its trees; parts have a bounded number of links."""

    def stars(root: dict[int, int]) -> pa.RecordBatch:
        nodes = [n for n in root if root[n] != n]
        centres = [find(root, n) for n in nodes]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(centres, pa.int64())], ["a", "b"])

    def find(root: dict[int, int], node: int) -> int:
        while root[node] != node:
            root[node] = root[root[node]]
            node = root[node]
        return node

    root: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            root.setdefault(a, a)
            root.setdefault(b, b)
            x, y = find(root, a), find(root, b)
            root[max(x, y)] = min(x, y)
        if len(root) > PART_LINKS:
            yield stars(root)
            root = {}
    if root:
        yield stars(root)


def _lowest(links: DataFrame, node: str, other: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("at")).agg(F.min(other).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest id that it reaches, for each id of ``links`` (a, b: long, not null).

    Alternates large and small stars until nothing moves; a star's centre may have any number of
    links, as smallest neighbours are aggregated and then joined back.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.mapInArrow(_contract, "a long, b long").distinct(), "links")
    state = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the join shuffles both sides by itself and may split a large star.
        low = stage(_lowest(both, "a", "b").select("at", F.least("at", "low").alias("low")), "lowest")
        large = both.join(low, both["a"] == low["at"]).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.distinct(), "large")
        low = _lowest(large, "a", "b")
        joined = large.join(low, large["a"] == low["at"])
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select(F.col("at").alias("a"), F.col("low").alias("b")))
        links = stage(small.filter("a <> b").distinct(), "small")
        sums = links.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
        if state == tuple(sums):
            break
        state = tuple(sums)
    centres = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres.select("node", F.col("node").alias("component")))
