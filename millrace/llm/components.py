"""Connected components, and splits that keep them whole (problem 2)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import hot_keys, join_skewed
from millrace.session import stage

SMALL_EDGES = 50_000


def _order(node: str) -> Column:
    """Nodes' order: by hash, then by name. Every component's first node is its root, at any partitioning."""
    return F.struct(F.xxhash64(F.col(node)).alias("h"), F.col(node).alias("n"))


def _union_small(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over a small graph; each node with its component's first node."""
    parent: dict[tuple, tuple] = {}

    def root(x: tuple) -> tuple:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pdf in batches:
        for ha, a, hb, b in zip(pdf.ha, pdf.a, pdf.hb, pdf.b, strict=True):
            x, y = sorted((root((ha, a)), root((hb, b))))
            parent[y] = x
    found = [(x[1], root(x)[1]) for x in parent]
    yield pd.DataFrame(found, columns=["node", "root"]).astype({"node": "object", "root": "object"})


def components(edges: DataFrame, src: str, dst: str, hops: int = 3, small_edges: int = SMALL_EDGES, chunk: int = 10_000, share: float = 0.001) -> DataFrame:
    """Every node (string) that has an edge to another, with its component's root: columns node, root.

    Edges count in both directions; null ends and loops are left out; repeated edges change nothing.

    Method: adjacency lists are hash-partitioned by node, a hub's list in chunks. Many seeds, the nodes before all their
    neighbours in hash order, grow at once for some hops; each node takes the label that reaches it first. Edges between
    different labels are the collisions; they make a smaller graph that is solved the same way, and by union-find in one
    task once it has at most small_edges edges (a bound on that task, not on the input). Each round at least merges all
    neighbours of seeds, so the rounds end.

    No join gathers a hub or a giant component: nodes with over share of the edges' ends, and roots with over share of
    the nodes, 1 / share of either at most, meet their edges and nodes by broadcast.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_")
    e = stage(e, "edges")
    labels: DataFrame | None = None
    while True:
        n = e.count()
        if n <= small_edges:
            last = e.select(F.xxhash64("a").alias("ha"), "a", F.xxhash64("b").alias("hb"), "b").coalesce(1).mapInPandas(_union_small, "node string, root string")
            return last if labels is None else _follow(labels, stage(last, "labels"), share)
        step, hubs = _grow(e, n, hops, chunk, share)
        near, far = (step.select(F.col("node").alias(k), F.col("root").alias(f"r{k}")) for k in ("a", "b"))
        moved = e
        for k, side in (("a", near), ("b", far)):
            moved = join_skewed(moved, side, [k], hubs and hubs.withColumnRenamed("a", k))
        moved = moved.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        e = stage(moved.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_"), "edges")
        labels = step if labels is None else stage(_follow(labels, step, share), "labels")


def _follow(labels: DataFrame, step: DataFrame, share: float) -> DataFrame:
    """Labels of the first graph, led on by those of the next."""
    on = step.select(F.col("node").alias("root"), F.col("root").alias("_next"))
    return join_skewed(labels, on, ["root"], hot_keys(labels, ["root"], share), "left").select("node", F.coalesce("_next", "root").alias("root"))


def _grow(e: DataFrame, edges: int, hops: int, chunk: int, share: float) -> tuple[DataFrame, DataFrame | None]:
    """One round: seeds, their growth for some hops, and every other node under its own label; and the largest hubs, or None."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("_deg"), F.min(_order("b")).alias("_first"))
    degree = stage(degree.select("a", "_deg", F.ceil(F.col("_deg") / chunk).cast("int").alias("_cuts"), (_order("a") < F.col("_first")).alias("_seed")), "degrees")
    top = degree.where(F.col("_deg") > 2 * share * edges).select("a").collect()  # 1 / share rows at most
    top = e.sparkSession.createDataFrame(top, "a string") if top else None
    hubs = degree.where("_cuts > 1").select("a", "_cuts")  # at most 2 * edges / chunk rows, each with over chunk neighbours
    cut = F.when(F.col("_cuts") > 1, F.pmod(F.xxhash64("b"), F.col("_cuts"))).otherwise(0).cast("int")
    adj = join_skewed(both, degree.select("a", "_cuts"), ["a"], top).select("a", cut.alias("_cut"), "b")
    adj = stage(adj, "adjacency")
    seen = degree.where("_seed").select(F.col("a").alias("node"), F.col("a").alias("root"))
    frontier = seen
    for hop in range(hops):
        out = frontier.join(degree.select(F.col("a").alias("node"), "_cuts").hint("merge"), "node") if hop == 0 else frontier.join(hubs.select(F.col("a").alias("node"), "_cuts"), "node", "left")
        out = out.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.coalesce("_cuts", F.lit(1)) - 1))).select(F.col("node").alias("a"), "_cut", "root")
        reached = adj.join(out, ["a", "_cut"]).groupBy(F.col("b").alias("node")).agg(F.min(_order("root")).alias("_r"))
        frontier = stage(reached.select("node", F.col("_r.n").alias("root")).join(seen, "node", "left_anti"), "frontier")
        seen = seen.unionByName(frontier)
    rest = degree.select(F.col("a").alias("node")).join(seen, "node", "left_anti").select("node", F.col("node").alias("root"))
    return stage(seen.unionByName(rest), "labels"), top


def linked_keys(df: DataFrame, a: str, b: str, weight_name: str = "weight") -> DataFrame:
    """Distinct pairs of two key columns with their number of rows; pre-aggregated before the shuffle."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(weight_name))


BUCKETS = 65_536


def split_plan(sizes: DataFrame, root: str, weight: str, shares: list[tuple[str, float]], large: float = 0.002) -> DataFrame:
    """Every root with its split: columns root, split_name.

    Roots above large of the total (1 / large of them at most) go, largest first, each to the split that lacks most; the
    others fill what is left in the order of their hash, cut where the running weight passes a split's share. The
    running weight is kept per hash bucket, 65,536 rows at any input, so shares hold to about that part of the total.
    """
    spark = sizes.sparkSession
    total = sizes.agg(F.sum(weight)).first()[0] or 0
    if not total or not shares:
        return sizes.select(root, F.lit(None).cast("string").alias("split_name")).where("false")
    whole = sum(x for _, x in shares)
    left = {name: total * x / whole for name, x in shares}
    big = sizes.where(F.col(weight) > large * total).select(root, weight).collect()
    placed = []
    for r in sorted(big, key=lambda r: (-r[1], r[0])):
        name = max(left, key=lambda k: (left[k], k))
        left[name] -= r[1]
        placed.append((r[0], name))
    bucket = F.shiftrightunsigned(F.xxhash64(root), 48).cast("int")
    rest = sizes.where(F.col(weight) <= large * total)
    sums = rest.groupBy(bucket.alias("_bucket")).agg(F.sum(weight).alias("_w")).toPandas().sort_values("_bucket")
    room = {k: max(0.0, float(v)) for k, v in left.items()}
    factor = float(sums["_w"].sum()) / (sum(room.values()) or 1)
    mid = (sums["_w"].cumsum() - sums["_w"] / 2).astype(float)
    names = pd.Series(shares[-1][0], index=sums.index, dtype=object)
    edge = float(sum(room.values())) * factor
    for name, _ in reversed(shares):
        names[mid <= edge] = name
        edge -= room[name] * factor
    plan = spark.createDataFrame(pd.DataFrame({"_bucket": sums["_bucket"].astype("int32"), "split_name": names}), "_bucket int, split_name string")
    small = rest.select(root, bucket.alias("_bucket")).join(F.broadcast(plan), "_bucket").select(root, "split_name")
    large_ones = spark.createDataFrame(placed, f"{root} string, split_name string")
    return small.unionByName(large_ones)
