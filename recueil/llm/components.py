"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recueil.llm.common import scratch, stored

#: Edges of a task that are contracted at a time.
EDGES = 500_000


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (``a, b``) with the same components: those a task holds at a
    time become stars around their smallest nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}
        kind = None

        def find(x):
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = up
            return x

        def stars() -> pa.RecordBatch:
            pairs = [(x, find(x)) for x in list(root)]
            pairs = [p for p in pairs if p[0] != p[1]]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            kind = batch.column("a").type
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                p, q = find(x), find(y)
                if p != q:
                    root[max(p, q)] = min(p, q)
            if len(root) > EDGES:
                yield stars()
                root = {}
        if root:
            yield stars()

    return edges.select("a", "b").mapInArrow(run, edges.select("a", "b").schema)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``).

    The component is its smallest node.  Each task contracts the edges it holds
    first.  Then large-star and small-star steps take turns until the edges form
    stars; each writes its edges to the shared folder, and no step gathers a
    component in one task.
    """
    with scratch(edges.sparkSession) as kept:
        named = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
        pairs, last = stored(contracted(named).distinct(), "edges"), None
        while True:
            # Large star: larger neighbours point to the smallest neighbour.
            both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
            large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
            # Small star: smaller neighbours and the node itself point there.
            down = large.groupBy("a").agg(F.min("b").alias("low"))
            joined = large.join(down, "a")
            small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(joined.select("a", F.col("low").alias("b")))
            pairs = stored(contracted(small.filter("a <> b")).distinct(), "edges")
            state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
            if state == last:
                break
            last = state
        roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return kept(stars.unionByName(roots), "components")
