from __future__ import annotations

import random

from millrace.operators.intervals import periods_and_gaps, to_millis
from millrace.operators.ordered import carry_last, running_sum, scanned, with_position

SCHEMA = "k string, s long, e long, kind string"


def brute(rows):
    out = set()
    by = {}
    for k, s, e in rows:
        if k is not None and s is not None and e is not None and e > s:
            by.setdefault(k, []).append((s, e))
    for k, xs in by.items():
        xs.sort()
        at, end = xs[0]
        for s, e in xs[1:]:
            if s > end:
                out |= {(k, "period", at, end), (k, "gap", end, s)}
                at, end = s, e
            end = max(end, e)
        out.add((k, "period", at, end))
    return out


def test_periods_match_brute_force_with_a_hot_entity(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(3000):
        s = rng.randrange(0, 200_000)
        rows.append(("hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}", s, s + rng.choice([0, 1, 5, 40, 3000])))
    rows += [(None, 1, 2), ("a", None, 2), ("a", 1, None), ("b", 5, 5), ("b", 9, 3), ("c", 0, 100_000), ("c", 3, 5), ("c", 100_000, 100_001)] * 2
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)  # a further column named like one of the result
    for parts in (1, 7):
        got = {tuple(r) for r in periods_and_gaps(df, ["k"], "s", "e", parts).collect()}
        assert got == brute(rows)


def test_one_interval_over_all_partitions(spark):
    rows = [("k", 0, 10_000)] + [("k", i, i + 1) for i in range(1, 2000, 2)] + [("k", 10_001 + 3 * i, 10_002 + 3 * i) for i in range(500)]
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    assert {tuple(r) for r in periods_and_gaps(df, ["k"], "s", "e", 9).collect()} == brute(rows)


def test_no_rows(spark):
    assert periods_and_gaps(spark.createDataFrame([], SCHEMA), ["k"], "s", "e").count() == 0


def test_millis(spark):
    df = spark.createDataFrame([(1.0004,), (1.0006,), (float("nan"),), (None,), (-0.0011,)], "t double")
    assert [r[0] for r in df.select(to_millis("t")).collect()] == [1000, 1001, None, None, -1]


def test_positions_sums_and_carried_values(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab") if rng.random() < 0.9 else None, i, rng.choice([None, 1, 2, 3])) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    got = {r["i"]: r["position"] for r in with_position(df, ["k", "i"], parts=6).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == {r[1]: p for p, r in enumerate(order)}
    sums, last, want_sum, want_last = {}, {}, {}, {}
    for k, i, v in order:
        want_last[i] = last.get(k)
        last[k] = v if v is not None else last.get(k)
        sums[k] = want_sum[i] = sums.get(k, 0) + (v or 0)
    assert {r["i"]: r["t"] for r in running_sum(df, ["k"], ["i"], "v", "t", 6).collect()} == want_sum
    assert {r["i"]: r["t"] for r in carry_last(df, ["k"], ["i"], "v", "t", 6).collect()} == want_last
    assert with_position(df.where("false"), ["i"]).count() == 0
    got = scanned(df, ["k"], ["i"], {"t": "v"}, {"b": "v"}, 6).collect()
    assert {r["i"]: r["t"] for r in got} == want_sum
    prior, want = {}, {}
    for k, i, v in order:
        want[i] = prior.get(k)
        prior[k] = v
    assert {r["i"]: r["b"] for r in got} == want
