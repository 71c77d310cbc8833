from __future__ import annotations

import random
from collections import Counter, defaultdict

from millrace.llm.components import components, split_plan
from millrace.llm.splitting import speakers_together, split_entries


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[root(a)] = root(b)
    groups = defaultdict(set)
    for x in parent:
        groups[root(x)].add(x)
    return {frozenset(g) for g in groups.values()}


def groups(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r["root"]].add(r["node"])
    assert all(k in v for k, v in out.items())
    return {frozenset(v) for v in out.values()}


def test_components_of_chains_hubs_and_noise(spark):
    rng = random.Random(1)
    edges = [(f"c{i}", f"c{i + 1}") for i in range(120)] + [("hub", f"h{i}") for i in range(300)]
    edges += [(f"n{rng.randrange(500)}", f"n{rng.randrange(500)}") for _ in range(350)] + [("x", "x"), (None, "y"), ("z", None), ("p", "q"), ("q", "p")] * 2
    df = spark.createDataFrame(edges, "a string, b string")
    want = brute(edges)
    roots = None
    for small, hops, chunk in ((10_000, 2, 50), (0, 3, 50), (20, 1, 10_000)):
        got = components(df.repartition(3), "a", "b", hops=hops, small_edges=small, chunk=chunk)
        assert groups(got) == want
        names = {r["node"]: r["root"] for r in got.collect()}
        assert roots is None or roots == names
        roots = names


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def entries(spark, rows):
    return spark.createDataFrame(rows, "entry_id long, speaker string, audio_filepath string, root string")


def test_speakers_that_share_a_recording(spark):
    rows = [
        (1, "Ann_1", "x/rec00000001/1.wav", "r"), (2, "ann 1", "x/REC00000002/1.wav", "r"), (3, "bob", "y/rec00000002_5.wav", "r"), (4, "Unknown", "rec00000003", "r"),
        (5, "unknown ", "rec00000001", "r"), (6, "cid", "rec00000003", "r"), (7, None, "rec00000003", "r"), (8, "", "rec00000009", "r"), (9, "dee", None, "r"), (10, "D.E.E", "no code", "r"), (11, "dee", None, "r"),
    ]
    got = {tuple(r) for r in speakers_together(entries(spark, rows)).collect()}
    assert got == {("Ann_1", "ann 1"), ("Ann_1", "bob"), ("ann 1", "bob"), ("D.E.E", "dee")}
    assert speakers_together(entries(spark, [])).count() == 0


def test_split_keeps_components_and_shares(spark):
    rng = random.Random(2)
    rows = [(i, f"s{rng.randrange(900)}" if rng.random() < 0.7 else None, f"rec{rng.randrange(2000):08d}" if rng.random() < 0.95 else None, "r") for i in range(4000)]
    rows += [(4000 + i, "hot", f"rec{90_000_000 + i:08d}", "r") for i in range(600)]
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), (None, 0.3)], "split_name string, target_share double")
    got = split_entries(entries(spark, rows), targets).collect()
    assert sorted(r["entry_id"] for r in got) == list(range(4600))
    split = {r["entry_id"]: r["split_name"] for r in got}
    by = defaultdict(set)
    for i, s, p, _ in rows:
        for k in (s, p):
            if k is not None:
                by[k].add(split[i])
    assert all(len(v) == 1 for v in by.values())
    assert {r["split_name"] for r in got} <= {"train", "validation", "test"}
    again = {r["entry_id"]: r["split_name"] for r in split_entries(entries(spark, rows[::-1]).repartition(3), targets).collect()}
    assert again == split
    assert split_entries(entries(spark, []), targets).count() == 0


def test_shares_of_many_small_components(spark):
    sizes = spark.createDataFrame([(f"c{i}", 1 + i % 5) for i in range(20_000)] + [("large", 9000)], "root string, n long")
    plan = {r["root"]: r["split_name"] for r in split_plan(sizes, "root", "n", [("train", 0.8), ("test", 0.1), ("validation", 0.1)]).collect()}
    weight = Counter()
    for r in sizes.collect():
        weight[plan[r["root"]]] += r["n"]
    total = sum(weight.values())
    assert plan["large"] == "train"
    assert abs(weight["train"] / total - 0.8) < 0.005 and abs(weight["test"] / total - 0.1) < 0.005


def test_hot_speaker_and_giant_component_are_spread(spark):
    """One speaker with half of all edges, and one component with most nodes: no task of a join gets over a third."""
    from pyspark.sql import functions as F

    from millrace.llm import components as C
    from millrace.llm.splitting import speaker_classes
    from millrace.operators.joins import hot_keys, join_skewed

    edges = [("s:hot", f"r:{i}") for i in range(3000)] + [(f"s:{i}", f"r:{i}") for i in range(1500)] + [(f"s:x{i}", f"r:x{i}") for i in range(1500)]
    df = spark.createDataFrame(edges, "a string, b string")
    want = brute(edges)
    for small in (0, 10_000):
        assert groups(C.components(df, "a", "b", hops=2, small_edges=small, chunk=200, share=0.01)) == want
    labels = C.components(df, "a", "b", small_edges=0, share=0.01)
    hot = hot_keys(labels, ["root"], 0.01)
    assert hot.count() == 1
    for left, right, key, keys in ((df, labels.withColumnRenamed("node", "a"), "a", hot_keys(df, ["a"], 0.01)), (labels, labels.select("root").distinct().withColumn("n", F.lit(1)), "root", hot)):
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # small partitions would be put together
        try:
            met = join_skewed(left.repartition(8), right, [key], keys)
            most = max(r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect())
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert most < left.count() / 3
    rows = [(i, "hot" if i % 2 else f"s{i}", f"rec{i // 2:08d}", "r") for i in range(2000)] + [(9000, None, "rec00000001", "r"), (9001, "Alone", None, "r"), (9002, "alone!", None, "r")]
    got = {r["speaker"]: (r["class_id"], r["members"]) for r in speaker_classes(entries(spark, rows)).collect()}
    assert got["hot"] == ("hot", 1001) and got["s10"] == ("hot", 1001) and got["Alone"] == got["alone!"] == ("Alone", 2)
    assert speaker_classes(entries(spark, [])).count() == 0
