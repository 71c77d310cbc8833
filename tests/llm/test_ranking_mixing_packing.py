from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from millrace.llm.mixing import mix_entries, without_superseded
from millrace.llm.packing import pack_documents, pack_lengths, token_count
from millrace.llm.ranking import Score, borda_ranking

NAN = float("nan")


def brute_borda(rows, signs):
    one = {}
    for i, *s in rows:
        if i is not None:
            clean = tuple(None if x is None or math.isnan(x) else x for x in s)
            key = tuple((x is not None, x or 0.0) for x in clean)
            if i not in one or key < one[i][0]:
                one[i] = key, clean
    points = defaultdict(list)
    for k, sign in enumerate(signs):
        vals = [v[1][k] for v in one.values() if v[1][k] is not None]
        for i, v in one.items():
            x = v[1][k]
            if x is None or len(vals) < 2:
                points[i].append(0.5)
            else:
                worse = sum(sign * y < sign * x for y in vals)
                points[i].append((worse + (vals.count(x) - 1) / 2) / (len(vals) - 1))
    order = sorted(points, key=lambda i: (-round(sum(points[i]), 9), i))
    return {i: (p + 1, [round(x, 9) for x in points[i]]) for p, i in enumerate(order)}


def test_ranking_matches_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *v: rng.choice(v)
    rows = [(i, 0.0 if rng.random() < 0.4 else pick(None, NAN, rng.random() * 1000), pick(0.0, 1.0, None), rng.random()) for i in range(400)]
    rows += [(None, 1.0, 1.0, 1.0), (5, 9.0, 9.0, 9.0), (6, None, None, None), rows[7], rows[7]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, a double, b double, c double, rank int")
    got = borda_ranking(df, "id", [Score("a", False), Score("b", False), Score("c")]).collect()
    assert {r["id"]: (r["rank"], [round(r[f"{x}_points"], 9) for x in "abc"]) for r in got} == brute_borda(rows, [-1, -1, 1])
    assert sorted(r["rank"] for r in got) == list(range(1, len(got) + 1))


def test_ranking_ignores_ranges_and_takes_empty_tables(spark):
    rows = [(i, float(i), 1e9 * (99 - i)) for i in range(100)]
    got = borda_ranking(spark.createDataFrame(rows, "id long, a double, b double"), "id", [Score("a"), Score("b")]).collect()
    assert {r["points"] for r in got} == {1.0} and [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(100))
    assert borda_ranking(spark.createDataFrame([], "id long, a double"), "id", [Score("a")]).count() == 0


def _mix(spark, rows, targets, **kw):
    df = spark.createDataFrame(rows, "id long, source string, d double, copies string")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    entries, report = mix_entries(df, t, "id", "source", "d", **kw)
    return {r["id"]: r["copies"] for r in entries.collect()}, {r["source"]: r for r in report.collect()}


def test_mix_meets_shares_within_repeats(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["Big-src ", "big_src", "big_src", "big_src", "small"]) if i % 50 else "tiny", rng.choice([rng.random() * 20, rng.random() * 5, None, NAN, 0.0, -3.0, 5e4]), "x") for i in range(6000)]
    rows += [(6000, None, 1.0, "x"), (6001, "other", 1.0, "x"), (6002, " ", 1.0, "x")]
    targets = [("big_src", 0.6, 2), ("small", 0.3, 3), ("tiny", 0.05, 4), ("absent", 0.05, 5), (None, 0.1, 1)]
    for weight in (None, "d"):
        copies, report = _mix(spark, rows, targets, weight=weight)
        assert len(copies) == len(rows)
        usable = {r[0]: r for r in rows if r[2] is not None and 0 < r[2] <= 120}
        assert all(c == 0 for i, c in copies.items() if i not in usable)
        caps = {"big_src": 2, "small": 3, "tiny": 4}
        got = defaultdict(float)
        for i, c in copies.items():
            if c:
                s = (usable[i][1] or "").strip().lower().replace("-", "_")
                assert c <= caps[s]
                got[s] += c * usable[i][2]
        whole = sum(got.values())
        for s, share in (("big_src", 0.6), ("small", 0.3), ("tiny", 0.05)):
            assert abs(got[s] / whole - share / 0.95) < 0.003
            assert abs(report[s]["reached"] - got[s]) < 1e-6 and abs(report[s]["reached"] - report[s]["quota"]) <= 20
        assert report["absent"]["reached"] == 0.0 and report["absent"]["entries"] == 0


def test_mix_of_a_given_total_holds_caps_and_repeats_itself(spark):
    rows = [(i, "a" if i < 10 else "b", 1.0, "x") for i in range(1000)]
    targets = [("a", 0.5, 3), ("b", 0.5, 3)]
    copies, report = _mix(spark, rows, targets, total=500.0)
    assert report["a"]["reached"] == 30.0 and all(copies[i] == 3 for i in range(10)) and abs(report["b"]["reached"] - 250) <= 1
    again, _ = _mix(spark, rows[::-1], targets, total=500.0)
    assert again == copies
    none, report = _mix(spark, [], targets)
    assert not none and report["a"]["actual_share"] is None


def test_an_entry_delivered_again_is_used_once(spark):
    rows = [(1, "a", 5, 1.0), (2, "a", 9, 2.0), (3, "b", 1, 3.0), (4, None, 1, 4.0), (5, None, 2, 5.0)]
    df = spark.createDataFrame(rows, "id long, path string, at int, d double")
    got = {r["id"]: r["d"] for r in without_superseded(df, "id", "path", ["at"], "d").collect()}
    assert got == {1: None, 2: 2.0, 3: 3.0, 4: 4.0, 5: 5.0}


def test_pareto_sample_follows_the_weights(spark):
    rows = [(i, "a", 1.0 if i % 2 else 4.0, "x") for i in range(20_000)]
    copies, _ = _mix(spark, rows, [("a", 1.0, 1)], weight="d", total=10_000.0)
    used = Counter(4.0 if i % 2 == 0 else 1.0 for i, c in copies.items() if c)
    assert abs(used[4.0] / used[1.0] - 4) < 0.35


def _item_by_item(hist, cap, fit):
    """What each pack holds when items are placed one at a time, the longest first."""
    packs = []
    for x in sorted(Counter(hist).elements(), reverse=True):
        fits = [i for i, used in enumerate(packs) if used + x <= cap]
        if fit == "shortest" and packs and min(packs) + x <= cap:
            packs[packs.index(min(packs))] += x
        elif fit == "best" and fits:
            packs[max(fits, key=lambda i: packs[i])] += x
        else:
            packs.append(x)
    return packs


def test_most_room_first_takes_another_pack_than_best_fit():
    assert sorted(p for p, _ in pack_lengths({6: 1, 5: 1, 2: 1}, 10)) == [((5, 1), (2, 1)), ((6, 1),)]
    assert sorted(p for p, _ in pack_lengths({6: 1, 5: 1, 2: 1}, 10, "best")) == [((5, 1),), ((6, 1), (2, 1))]


def test_shortest_pack_first_keeps_every_item():
    rng = random.Random(5)
    for _ in range(60):
        cap = rng.randrange(4, 60)
        hist = Counter(rng.randrange(1, cap + 1) for _ in range(rng.randrange(0, 300)))
        fit = rng.choice(["shortest", "best"])
        patterns = pack_lengths(dict(hist), cap, fit)
        assert sorted(_item_by_item(hist, cap, fit)) == sorted(sum(length * per for length, per in p) for p, n in patterns for _ in range(n))
        seen = Counter()
        for p, n in patterns:
            assert sum(length * per for length, per in p) <= cap
            for length, per in p:
                seen[length] += per * n
        assert seen == hist
        used = sum(k * v for k, v in hist.items())
        assert sum(n for _, n in patterns) <= 2 * math.ceil(used / cap) + 1
    with pytest.raises(ValueError):
        pack_lengths({5: 1}, 4)


def test_documents_are_whole_and_ranked_in_cells(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([7, 7, 7, rng.randrange(0, 40), 137, None]), "x") for i in range(3000)] + [(None, 5, "x"), (1, 7, "x")]
    df = spark.createDataFrame(rows, "id long, n long, pack string")
    both = pack_documents(df, "id", "n", [("t", 32), ("u", 50)], cell_rows=100).toPandas()
    other = both[both["pack_name"] == "u"]
    assert other.groupby("pack")["size"].sum().max() <= 50 and not other.duplicated(["pack", "slot"]).any() and other["size"].sum() == both[both["pack_name"] == "t"]["size"].sum()
    got = both[both["pack_name"] == "t"]
    assert got.groupby("pack")["size"].sum().max() <= 32 and not got.duplicated(["pack", "slot"]).any()
    want = Counter(i for i, n, _ in rows if i is not None and n and n > 0 for _ in range(-(-n // 32)))
    assert Counter(got["id"]) == want
    assert got["size"].sum() == sum(n for i, n, _ in rows if i is not None and n and n > 0)
    fits = {i for i, n, _ in rows if i is not None and n and n <= 32} - {1}
    assert set(got[got["id"].isin(fits)]["piece"]) == {0}
    filled = got["size"].sum() / (got["pack"].nunique() * 32)
    assert filled > 0.97
    assert pack_documents(df.where("false"), "id", "n", [("t", 32)]).count() == 0


def test_token_count(spark):
    df = spark.createDataFrame([("Hello world",), ("",), (None,), ("naïve 你好",), ("word " * 50_000,)], "t string")
    got = [r[0] for r in df.select(token_count("t")).collect()]
    assert got[0] == 2 and got[1] == got[2] == 0 and got[3] > 2 and got[4] >= 50_000
