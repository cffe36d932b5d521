"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mereflow import scratch

#: Times that pointers are doubled between two writes.
DOUBLINGS = 2


#: Rows from which a written table is not broadcast: its file says little of its size, as pointers compress to nearly nothing.
MANY = 100_000


def _large(df: DataFrame, rows: int) -> DataFrame:
    return df.hint("merge") if rows > MANY else df


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node id of its component.

    Each round hooks every node to its smallest neighbour, follows the pointers to their ends by doubling
    and contracts the edges, so the edge table shrinks at least by half per round, and a chain of any length
    takes one. Rounds are written to the shared folder. Nodes are of any type that has an order. Edges with a null end
    are ignored, self loops give a component of one, repeated edges count once.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    first = e = scratch.save(e.union(e.select("b", "a")).distinct(), "edges")
    steps: list[tuple[DataFrame, int]] = []
    while True:
        live = e.where("a <> b")
        hooked = live.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("p"))
        up = scratch.save(hooked, "up")
        if (rows := up.count()) == 0:
            scratch.drop(up)
            break
        far = up
        while True:
            nxt = far
            for _ in range(DOUBLINGS):
                q = nxt.select(F.col("n").alias("n2"), F.col("p").alias("p2"))
                nxt = nxt.join(_large(q, rows), nxt.p == q.n2, "left").select("n", F.coalesce("p2", "p").alias("p"), (F.coalesce("p2", "p") < F.col("p")).alias("moved"))
            nxt = scratch.save(nxt, "up")
            scratch.drop(far)
            far = nxt
            if far.where("moved").isEmpty():
                break
        ua, ub = far.select(F.col("n").alias("a"), F.col("p").alias("pa")), far.select(F.col("n").alias("b"), F.col("p").alias("pb"))
        e2 = scratch.save(live.join(_large(ua, rows), "a").join(_large(ub, rows), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b").distinct(), "edges")
        if e is not first:
            scratch.drop(e)
        e = e2
        steps.append((far, rows))
    # every node follows the pointers of one round after the other
    labels = first.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
    for far, rows in steps:
        own = far.select(F.col("n").alias("n2"), F.col("p").alias("p2"))
        labels = labels.join(_large(own, rows), labels.root == own.n2, "left").select("node", F.coalesce("p2", "root").alias("root"))
    labels = scratch.save(labels, "labels")
    for old in (e, first, *(far for far, _ in steps)):
        scratch.drop(old)
    return labels
