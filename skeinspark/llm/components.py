"""Connected components of a link table: forests of partitions, then alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, lean

#: Nodes that a task holds before it passes its stars on, and links up to which one task ties the rest.
HELD = 500_000


def forests(batches):
    """Links (u, v) of a task as (node, smallest node that the task's links tie it to); with more than HELD nodes, in parts."""

    def stars():
        nodes = [x for x in above if find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["u", "v"])

    def find(x):
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above[x]
        return top

    above: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            above.setdefault(a, a)
            above.setdefault(b, b)
            a, b = find(a), find(b)
            above[max(a, b)] = min(a, b)
        if len(above) > HELD:
            yield stars()
            above = {}
    yield stars()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root), root the smallest node reachable; nodes without a link do not appear.

    Each task first ties what its own links tie.  If that leaves at most HELD links, by count, one task ties them.
    Otherwise each round a star is built around the smallest neighbour of every node, first towards larger, then
    towards smaller nodes, until nothing changes: about log(nodes) rounds.  Minima are pre-aggregated, joins are split by
    AQE where a node has very many links, every round is checkpointed, and only two numbers a round reach the driver.
    """
    edges = links.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).mapInArrow(lean(forests), "u bigint, v bigint")
    edges = cut(edges.distinct())
    state = None
    if edges.limit(HELD + 1).count() <= HELD:
        edges, state = cut(edges.coalesce(1).mapInArrow(lean(forests), "u bigint, v bigint")), ()
    while state != () and (now := tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())) != state and now[0]:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
        small = large.join(least, F.col("u") == F.col("x"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
        edges = cut(small.distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
