"""Goldens and brute force for the operators that SQL can't express, and for their edge cases."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import prompts as P
from millrace.functions import spoken as K
from millrace.functions import text as T
from millrace.functions import tokens as V
from millrace.operators import aggregates as A
from millrace.operators import buckets as B
from millrace.operators import filters as O
from millrace.operators import islands as I
from millrace.operators import joins as J
from millrace.operators import sampling as S
from millrace.operators import scoring as C


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def ints(*xs):
    return F.array(*map(F.lit, xs)).cast("array<int>")


# Filters.


def test_filters_let_missing_values_pass(spark):
    df = spark.createDataFrame([(1.0, [1, 37, 12, 2]), (None, [1])], "d double, tokens array<int>")
    keep = lambda c: [r[0] for r in df.where(c).select("d").collect()]
    assert keep(O.within(F.col("d"), 0, 10)) == [1.0, None] and keep(O.within(F.col("d"), 0, 0.5)) == [None] and keep(O.within(F.col("d"), 1.5, 2)) == [None]
    rate = lambda lo, hi: keep(O.tokens_per_second(F.size("tokens"), F.col("d"), lo, hi))
    assert rate(0, 5) == [1.0, None] and rate(0, 1) == [None] and rate(10, 12) == [None]


def test_constraints(spark):
    df = spark.createDataFrame([("en", "asr", None), ("de", "qa", "de"), (None, "asr", "x")], "lang string, task string, other string")
    keep = lambda c: [r[0] for r in df.where(O.constraint(c, df.columns)).select("lang").collect()]
    assert keep(".lang==en") == ["en"] and keep(".lang != .other") == ["en", None] and keep(".lang==.other") == ["de"]
    assert keep("not .task==asr or .lang==en") == ["en", "de"] and keep("(.task==asr) and not (.lang==en)") == [None]
    assert keep(".task==asr xor .lang==en") == [None] and len(keep("")) == 3 and keep(".nothing==.missing and .lang==en") == ["en"]
    for bad in (".a==", "(.lang==en", ".lang==en)", "and .lang==en", "lang==en"):
        with pytest.raises(ValueError):
            O.constraint(bad, df.columns)


def test_frequent_labels_and_shards(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), (None, 2), (None, 3), ("b", 4)], "label string, shard int")
    assert sorted(r[1] for r in O.frequent_only(df, "label", 2).collect()) == [0, 1, 2, 3]
    assert [r[1] for r in O.select_shards(df, "shard", "1:3").collect()] == [1, 2] and O.select_shards(df, "shard", "4").count() == 1 and O.select_shards(df, "shard", "all").count() == 5
    assert O.without_outliers(df.where("false"), "shard", 1.0).count() == 0


def test_last_seen_over_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("h" if i % 3 else "c", i, rng.choice([None, None, f"v{i}"])) for i in range(600)]
    last, want = {}, {}
    for k, i, v in rows:
        last[k] = v or last.get(k)
        want[i] = last[k]
    got = O.last_seen(spark.createDataFrame(rows, "k string, i int, v string").repartition(4), ["k"], ["i"], "v")
    assert {r["i"]: r["v"] for r in got.collect()} == want


def test_overlaps_match_brute_force(spark):
    rng = random.Random(2)
    side = lambda n: [(rng.choice("kkl"), i, s := rng.randrange(0, 300), s + rng.choice([0, 3, 90])) for i in range(n)]
    a, b = side(80), side(70)
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] - 1 < y[3] and y[2] < x[3] + 1)
    schema = "k string, i int, start int, end int"
    got = J.overlapping(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], 20, 1)
    assert sorted((r["a_i"], r["b_i"]) for r in got.collect()) == want


def test_strict_payload_join(spark):
    m, t = spark.createDataFrame([("a-sub1.wav",), ("a.wav",), ("b.wav",)], "p string"), spark.createDataFrame([("a.wav", 1)], "n string, v int")
    assert sorted(r["p"] for r in J.with_payload(m, t, "p", "n").collect()) == ["a-sub1.wav", "a.wav"]
    with pytest.raises(ValueError):
        J.with_payload(m, t, "p", "n", strict=True)


# Arrays and runs.


def test_merged_steps_and_overlaps(spark):
    assert one(spark, I.merged_steps(ints(-1, 0, 1, 2), ints(0, 1, 2, 3))) == list(range(8))
    assert one(spark, I.merged_steps(ints(-3, 1, 2, 3), ints())) == [0, 4, 5, 6] and one(spark, I.merged_steps(ints(), ints(5))) == [5]
    assert one(spark, I.overlap_length(ints(0, 1, 2, 3), ints(2, 3, 4, 5), 4)) == 2 and one(spark, I.overlap_length(ints(0, 2, 3, 4), ints(2, 3, 4, 5), 4)) == 3
    assert one(spark, I.overlap_length(ints(), ints(1), 4)) == 0
    old, new = (ints(0, 1, 2, 3), ints(0, 1, 2, 3)), ints(2, 3, 4, 5)
    assert one(spark, I.timed_overlap(*old, new, ints(2, 3, 4, 5))) == 2 and one(spark, I.timed_overlap(*old, new, ints(6, 7, 8, 9))) == 0


def brute_emissions(e, blank, pivot, start, silence):
    n, at, low = 0, -1, max(0, start, pivot - silence)
    i = len(e) - 1
    while i >= low:
        if e[i] == blank:
            n += 1
            at = i if n > silence else at
        elif n > silence:
            break
        else:
            n, at = 0, -1
        i -= 1
    return at + silence // 2 if n > silence and silence > 0 else None


def test_end_of_utterance(spark):
    assert [one(spark, I.end_by_emissions(ints(0, 1, 2, *[9] * 9), 9, F.lit(p), 0, 5)) for p in (8, 11)] == [brute_emissions([0, 1, 2, *[9] * 9], 9, p, 0, 5) for p in (8, 11)]
    rng = random.Random(3)
    cases = [([rng.choice([0, 0, 1]) for _ in range(20)], rng.randrange(20), rng.randrange(0, 3), rng.randrange(0, 6)) for _ in range(25)]
    for e, p, s, n in cases:
        assert one(spark, I.end_by_emissions(ints(*e), 0, F.lit(p), s, n)) == brute_emissions(e, 0, p, s, n)
    assert one(spark, I.end_by_timestamps(ints(1, 2, 10), F.lit(12), 4)) == 2 + 1 + 2 and one(spark, I.end_by_timestamps(ints(1, 2), F.lit(20), 4)) == 5
    assert one(spark, I.end_by_timestamps(ints(1, 2), F.lit(4), 4)) is None and one(spark, I.end_by_timestamps(ints(1), F.lit(9), 0)) == 9
    assert one(spark, I.end_by_timestamps(ints(1), F.lit(9), -1)) is None and one(spark, I.end_by_timestamps(ints(), F.lit(9), 3)) is None


def test_char_offsets_over_chunks(spark):
    got = one(spark, I.clamped_offsets(ints(0, 2, 0, 1), ints(3, 4, 1, 2), ints(0, 0, 1, 1), [0, 32], 8))
    assert [(r["s"], r["e"]) for r in got] == [(0, 3), (3, 4), (4, 5), (5, 6)]


def test_folds(spark):
    words = F.array(*map(F.lit, ["a", "b.", "c", "?", "d"]))
    assert one(spark, I.delimited_segments(words, ".?")) == ["a b.", "c ?", "d"]
    assert one(spark, I.resetting_groups(F.array(*map(F.lit, [3.0, 8.0, 11.0, 2.0])), 10.0)) == [0, 0, 1, -1]
    assert one(spark, I.collapse_repeats(ints(1, 1, 0, 1, 2, 2, 0), 0)) == [1, 1, 2] and one(spark, I.collapse_repeats(ints(), 0)) == []
    got = one(spark, I.subsegments(F.lit(2.0), F.lit(2.0), 1.5, 0.75))
    assert [(r["start"], r["duration"]) for r in got] == [(2.0, 1.5), (2.75, 1.25)]


# Buckets and packs.


def test_bucket_truth_tables(spark):
    b = [(5, 10), (5, 20), (10, 15), (10, 30)]
    at = lambda x, y, **k: one(spark, B.bucket_2d(F.lit(x), F.lit(y), b, **k))
    assert at(2.0, 21) is None and at(5.0, 20) == 1 and at(8.0, 16) == 3 and at(2.0, 21, strict=False) == 3 and at(11.0, 1) is None
    assert at(2.0, 10, max_ratio=[4, 9, 9, 9]) is None and one(spark, B.bucket_1d(F.lit(3.0), [3, 6])) == 0 and one(spark, B.bucket_1d(F.lit(6.1), [3, 6])) is None


def by_items_first_fit(items, cap):
    bins = []
    for x in sorted(items, reverse=True):
        for b in bins:
            if sum(b) + x <= cap:
                b.append(x)
                break
        else:
            bins.append([x])
    return bins


def by_items_knapsack(items, cap):
    left, out = sorted(items), []
    while left:
        room, pack = cap, []
        while fit := [x for x in left if x <= room]:
            pack.append(fit[-1])
            left.remove(fit[-1])
            room -= fit[-1]
        out.append(pack)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.integers(30, 60))
def test_packs_are_those_of_item_by_item(items, cap):
    spread = lambda ps: [[x for x, k in p for _ in range(k)] for p, n in ps for _ in range(n)]
    assert spread(B.first_fit_decreasing(Counter(items), cap)) == by_items_first_fit(items, cap)
    assert spread(B.greedy_knapsacks(Counter(items), cap)) == by_items_knapsack(items, cap)


def test_too_long_items_are_an_error():
    for f in (B.first_fit_decreasing, B.greedy_knapsacks):
        with pytest.raises(ValueError):
            f({5: 1}, 4)


def test_items_meet_their_packs(spark):
    df = spark.createDataFrame([(i, 3 if i < 40 else 1 + i % 8) for i in range(90)], "id int, n int")
    packs = B.packed(df, ["id"], "n", B.first_fit_decreasing(B.histogram(df, "n"), 8)).toPandas()
    assert sorted(packs.id) == list(range(90)) and packs.groupby("pack")["n"].sum().max() <= 8 and not packs.duplicated(["pack", "slot"]).any()


def test_filled_packs(spark):
    rows = [(0, 0, [1, 2, 3], [False, True, True], 1), (0, 1, [4, 5], [True, False], 0), (1, 0, [6], [True], 0)]
    df = spark.createDataFrame(rows, "pack long, slot int, ids array<int>, mask array<boolean>, answer int")
    got = {r["pack"]: r for r in B.filled_packs(df, "ids", mask="mask").collect()}
    assert got[0]["input_ids"] == [1, 2, 3, 4, 5] and got[0]["loss_mask"] == [True, True, False, False, False]
    assert got[0]["position_ids"] == [0, 1, 2, 0, 1] and got[0]["seq_start_id"] == [0, 3] and got[0]["cu_seqlens"] == [0, 3, 5] and got[1]["seq_start_id"] == [0]
    got = {r["pack"]: r for r in B.filled_packs(df, "ids", answer_start="answer").collect()}
    assert got[0]["loss_mask"] == [True, True, True, True, True]


def brute_starts(sizes, length):
    flat = [(d, o) for d, n in enumerate(sizes) for o in range(n)]
    return [flat[s * length] for s in range((len(flat) - 1) // length + 1)]


def test_sample_starts(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = [rng.randrange(1, 9) for _ in range(30)]
        got = B.sample_starts(spark.createDataFrame(list(enumerate(sizes)), "d int, n int"), ["d"], "n", 5).orderBy("sample").collect()
        assert [(r["doc_place"], r["offset"]) for r in got] == brute_starts(sizes, 5)


def brute_edges(sizes, buckets):
    limit, total, out = sum(sizes) / buckets, 0.0, []
    for x in sorted(sizes):
        if total > limit:
            out.append(round(x, 3))
            total = 0.0
        total += x
    return out


def test_equal_mass_edges(spark):
    rng = random.Random(5)
    for _ in range(5):
        sizes = [rng.choice([1.0, 2.0, 2.0, 5.0, float(rng.randrange(1, 40))]) for _ in range(120)]
        assert B.equal_mass_edges(spark.createDataFrame([(x,) for x in sizes], "s double"), "s", 6) == brute_edges(sizes, 6)
    assert B.equal_mass_edges(spark.createDataFrame([], "s double"), "s", 3) == []


def test_sequential_packs(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5, 6, 7, 8]), (2, [9, 10, 11, 12]), (3, [])], "i int, t array<int>")
    got = B.sequential_packs(df, ["i"], "t", 7).orderBy("pack").collect()
    assert [(r["tokens"], r["used"]) for r in got] == [([1, 2, 3, 4, 5, 6, 7], 7), ([8, 9, 10, 11, 12, 0, 0], 5)]


def brute_spans(sizes, target, least, one_left):
    if len(sizes) < least or any(x > 512 for x in sizes):
        return []
    out, begin, total = [], 0, 0
    for i, x in enumerate(sizes):
        total += x
        left = len(sizes) - i - 1
        if (total >= target and (left > 1 if one_left else left >= least) and i - begin + 1 >= least) or left == 0:
            out.append((begin, i + 1))
            begin, total = i + 1, 0
    return out


def test_sentence_spans(spark):
    rng = random.Random(6)
    cases = [[rng.randrange(1, 40) for _ in range(rng.randrange(0, 15))] for _ in range(40)] + [[600, 3, 4], [1]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s array<int>")
    for one_left in (True, False):
        got = {r["i"]: [(x["start"], x["end"]) for x in r["x"]] for r in df.select("i", B.sentence_spans(F.col("s"), 60, one_left=one_left).alias("x")).collect()}
        assert got == {i: brute_spans(c, 60, 2, one_left) for i, c in enumerate(cases)}


def test_padding(spark):
    assert one(spark, B.padded(ints(1, 2), 4)) == [1, 2, 0, 0] and one(spark, B.padded(ints(1, 2, 3), 2)) == [1, 2] and one(spark, B.padded(ints(1), 3, 9, left=True)) == [9, 9, 1]
    assert one(spark, B.up_to_multiple(F.lit(16), 16)) == 16 and one(spark, B.position_mask(F.lit(2), 3)) == [True, True, False]


# Sampling.


def test_splits_and_samples_are_alike_at_any_partitioning(spark):
    df = spark.range(500).withColumn("label", F.col("id") % 3 == 0)
    for f in (lambda d: S.split_exactly(d, "id", [("a", 0.7), ("b", 0.3)], 1), lambda d: S.stratified_split(d, "id", "label", 0.1, 1), lambda d: S.rebalance(d, "id", "label", 1), lambda d: S.weighted_draws(d, "id", "id", 50, 1), lambda d: S.round_robin(d, "label", ["id"])):
        assert sorted(map(tuple, f(df.repartition(1)).collect())) == sorted(map(tuple, f(df.repartition(17)).collect()))
    assert Counter(r["split"] for r in S.split_exactly(df, "id", [("a", 0.7), ("b", 0.3)], 1).collect()) == {"a": 350, "b": 150}
    copies = S.repeated(S.rebalance(df, "id", "label", 1), "copies").groupBy("label").count().collect()
    assert len({r["count"] for r in copies}) == 1


def test_blends_hold_their_weights(spark):
    got = Counter(r["source"] for r in S.blend_by_deficit(spark, [5, 3, 2], 1000).collect())
    assert got == {0: 500, 1: 300, 2: 200}
    with pytest.raises(ValueError):
        S.bin_table([1.0, 0.001, 1.0], 10)


# Metrics.


def test_word_distance_is_that_of_an_alignment(spark):
    rng = random.Random(7)
    rows = [(" ".join(rng.choices("abcde", k=rng.randrange(0, 9))), " ".join(rng.choices("abcde", k=rng.randrange(0, 9)))) for _ in range(80)] + [("é à", " é  à "), ("", "")]
    df = spark.createDataFrame(rows, "h string, r string")
    got = df.select(T.edit_distance_words("h", "r").alias("d"), C.edit_kinds("h", "r").alias("e")).collect()
    for (h, r), g in zip(rows, got, strict=True):
        assert g["d"] == C.distance(r.split(), h.split()) == g["e"]["ins"] + g["e"]["del"] + g["e"]["sub"]


def test_speaker_matching():
    rng = random.Random(8)
    for _ in range(40):
        h, r = ([" ".join(rng.choices("abcd", k=rng.randrange(0, 5))) for _ in range(rng.randrange(0, 5))] for _ in range(2))
        assert C.speaker_errors(h, r)[0] == C.best_permutation(h, r)


def test_diarization_matches_frames(spark):
    rng = random.Random(9)
    def side(names):
        out = []
        for s in names:
            t = 0
            while t < 80:
                t += rng.randrange(1, 9)
                e = t + rng.randrange(1, 12)
                out.append(("s", s, float(t), float(e)))
                t = e
        return out
    ref, hyp = side("AB"), side("xyz")
    schema = "session string, speaker string, start double, end double"
    got = C.diarization_errors(spark.createDataFrame(ref, schema), spark.createDataFrame(hyp, schema), "session", 7.0).first()
    on = lambda rows, t: {x[1] for x in rows if x[2] <= t < x[3]}
    frames = [(on(ref, t), on(hyp, t)) for t in range(0, 120)]
    best = max(sum((a, b) in ok for r, h in frames for a in r for b in h) for names in itertools.permutations("xyz", 2) for ok in [set(zip("AB", names, strict=True))])
    assert got["total"] == sum(len(r) for r, _ in frames)
    assert got["miss"] == sum(max(0, len(r) - len(h)) for r, h in frames) and got["false_alarm"] == sum(max(0, len(h) - len(r)) for r, h in frames)
    assert got["confusion"] == sum(min(len(r), len(h)) for r, h in frames) - best


def test_bleu_and_rouge(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat today", "the cat sat on the mat today"), (2, "a b c d e", "a b c d e")], "i int, h string, r string")
    assert abs(C.bleu(df, "i", "h", "r").first()[0] - 100) < 1e-9
    assert C.bleu(df.withColumn("h", F.lit("x y")), "i", "h", "r").first()[0] == 0.0
    assert C.rouge_values("the cat", "the cat sat") == (0.8, 2 / 3, 0.8) and C.rouge_values("", None) == (0.0, 0.0, 0.0)


def test_punctuation_edits():
    assert C.punctuation_edits("Hi, you. Ok?", "hi you, ok!", ",.?!") == [(",", "Deletions", ""), (".", "Substitutions", ","), ("?", "Substitutions", "!")]
    assert C.punctuation_edits("a", "a.", ".") == [(".", "Insertions", "")]


def test_ranking_metrics_edges(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.9), (0, 0.4)], "y int, s double")
    assert tuple(A.ranking_metrics(df, "y", "s").first()) == (1.0, 1.0, 1.0)
    assert tuple(A.ranking_metrics(df.where("y = 1"), "y", "s").first()) == (0.5, 1.0, 0.0)
    assert df.where("y = 1").agg(A.normalized_cross_entropy(F.col("y"), F.col("s"))).first()[0] == -math.inf
    assert tuple(A.youden_curve(df.where("y = 1"), "y", "s").first())[0] == 0.0
    assert df.agg(A.rate(F.lit(1), F.lit(0))).first()[0] == math.inf


def test_ranking_metrics_of_many_rows(spark):
    """The product of both classes' counts goes beyond 32 bits."""
    n = 100_000
    df = spark.range(n).select((F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.col("id") % 3).cast("double").alias("s"))
    counts = Counter((i % 2, i % 2 + i % 3) for i in range(n))
    scores = range(4)
    tp, tn = n // 2, n // 2
    roc = sum(counts[1, a] * counts[0, b] * (1.0 if a > b else 0.5) for a in scores for b in scores if a >= b) / (tp * tn)
    at = lambda y, keep: sum(counts[y, s] for s in scores if keep(s))
    pr = sum(counts[1, a] * at(1, lambda s: s >= a) / (at(1, lambda s: s >= a) + at(0, lambda s: s >= a)) for a in scores if counts[1, a]) / tp
    nt = sum(counts[0, a] * at(0, lambda s: s <= a) / (at(0, lambda s: s <= a) + at(1, lambda s: s <= a)) for a in scores if counts[0, a]) / tn
    assert tuple(A.ranking_metrics(df, "y", "s").first()) == pytest.approx((roc, pr, nt))
    assert tuple(A.ranking_metrics(df.withColumn("s", F.lit(0.3)), "y", "s").first()) == (0.5, 0.5, 0.5)


def test_confidence_is_between_zero_and_one(spark):
    for m in ("max_prob", *(f"entropy_{k}_{s}" for k in ("gibbs", "tsallis", "renyi") for s in ("lin", "exp"))):
        for t in (1.0, 0.33):
            sure = one(spark, A.confidence(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)), 4, m, t))
            even = one(spark, A.confidence(F.array(*[F.lit(0.25)] * 4), 4, m, t))
            assert abs(sure - 1) < 1e-9 and abs(even) < 1e-9, (m, t)
    with pytest.raises(ValueError):
        A.confidence(F.array(F.lit(1.0)), 4, "entropy_none_lin")


def test_spots_layers_and_rewards(spark):
    assert C.best_spots([(0, 9, 1.0), (5, 14, 2.0), (30, 40, 0.5), (31, 41, 0.4)]) == [1, 2]
    rng = random.Random(10)
    items = [(rng.randrange(5), rng.randrange(5)) for _ in range(30)]
    got = C.layers(items)
    beats = lambda b, a: b[0] <= a[0] and b[1] >= a[1] and b != a
    for i, a in enumerate(items):
        above = [got[j] for j, b in enumerate(items) if beats(b, a)]
        assert got[i] == max(above, default=0) + 1
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "a double, b double")
    assert [round(r["reward"], 4) for r in C.normalized_rewards(df, ["a", "b"]).collect()] == [0.3413, -0.3413]


# Texts, templates and tokens.


def test_text_functions(spark):
    f = lambda g, t: one(spark, g(F.lit(t)))
    assert f(T.attach_punctuation, "é , b !") == "é, b!" and f(T.split_words, " a \n b ") == ["a", "b"] and f(T.split_words, "") == []
    assert f(T.clean_label, ' It’s "9 10" yes? ') == "its nine one zero yes" and f(T.spell_digits, "0 007 a1") == "seven a1"
    assert f(T.split_sentences, "hi-there. dr. smith *left* now! ok") == ["Hi there.", "Dr.", "Smith left now!", "Ok"]
    assert f(T.mark_end, "done. ") == "done. <eou>" and f(T.mark_end, "not yet, ") == "not yet, "
    assert f(T.byte_ids, "é") == [195, 169] and f(T.byte_ids, "") == [] and one(spark, T.byte_ids(F.lit(None).cast("string"))) is None
    assert f(T.normalize_answer, "The an A cat, and THE  hat!") == "cat and hat" and one(spark, T.find_tokens(F.lit("ab1\nc"), "[a-z]+")) == ["ab", "1", "c"]
    assert f(T.delete_chars, "it's #1!") == "it's 1"


def test_speech_text_rules(spark):
    bad = ["", " ", "[Music]", "see https://x", "{a}{b}", "abcdefghij" * 3, "a" * 12 + "b" * 12, "!?!?!?a", "x &lt; y", None]
    good = ["Hello there.", "aaaaaaaaaa", "ok"]
    rows = spark.createDataFrame([(t,) for t in bad + good], "t string").select(T.is_speech_text("t")).collect()
    assert [r[0] for r in rows] == [False] * len(bad) + [True] * len(good)
    chars = T.allowed_chars(["en", "de"])
    assert one(spark, T.has_only(F.lit("Grüße, 5!"), chars)) and not one(spark, T.has_only(F.lit("naïve"), chars)) and not one(spark, T.has_only(F.lit(""), chars))
    assert one(spark, T.has_only(F.lit("任何"), T.allowed_chars(["zh"]))) and T.alphabet("xx") == T.alphabet("en")


def test_templates(spark):
    turns = spark.createDataFrame([([("user", "Hi"), ("assistant", "Yo")],), ([("user", "Hi")],)], "t array<struct<role:string,content:string>>")
    text = lambda n: [r[0] for r in turns.select(P.rendered(n, F.col("t"))).collect()]
    assert text("mistral") == ["<s>[INST] Hi [/INST] Yo</s>", "<s>[INST] Hi [/INST] "]
    assert text("llama2") == ["{bos}[INST] Hi [/INST]Yo {eos}", "{bos}[INST] Hi [/INST]"]
    assert text("qwen")[1] == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\n"
    got = P.encode_dialogues(turns, "gemma", "t").collect()
    assert got[0]["input_ids"] == got[0]["context_ids"] + got[0]["answer_ids"] and got[0]["mask"].count(True) == len(got[0]["answer_ids"]) and got[0]["input_ids"][0] == 1 and got[0]["answer_ids"][-1] == 2
    assert got[1]["answer_ids"] is None and got[1]["mask"] is None and got[1]["context_ids"] == got[1]["input_ids"]
    with pytest.raises(ValueError):
        P.turn("t5_translation", "user", message=F.lit("x"))
    with pytest.raises(ValueError):
        P.register("plain", P.Template({"assistant": "{message}"}))
    with pytest.raises(Exception):
        turns.select(P.rendered("plain", F.array(F.struct(F.lit("critic").alias("role"), F.lit("x").alias("content"))))).collect()


def test_placeholders_and_rendering(spark):
    got = one(spark, P.split_placeholder(F.lit("say <sound> now")))
    assert [(p["kind"], p["value"]) for p in got] == [("text", "say"), ("audio", "<sound>"), ("text", "now")]
    assert [(p["kind"], p["value"]) for p in one(spark, P.split_placeholder(F.lit("Transcribe: <speech>")))] == [("text", "Transcribe:"), ("audio", "<speech>")]
    df = spark.createDataFrame([("{b}", None)], "a string, b string")
    assert df.select(T.render("<{a}|{b}>\\n", ["a", "b"])).first()[0] == "<{b}|>\n"
    with pytest.raises(ValueError):
        T.render("{c}", ["a"])


def test_codes(spark):
    assert one(spark, V.integer_code(F.lit(1234), 0, 2)) == [100 + 12, 34] and one(spark, V.integer_code(F.lit(None).cast("int"), 0, 2)) == [200, 99]
    with pytest.raises(Exception):
        one(spark, V.integer_code(F.lit(10_000), 0, 2))
    assert one(spark, V.shifted_ids(ints(1, 2), F.lit("de"), [("en", 10), ("de", 5)])) == [11, 12] and one(spark, V.language_of_id(F.lit(12), [("en", 10), ("de", 5)])) == "de"
    assert one(spark, V.parsed_ids(F.lit("a hm b"), ["a", "b", "hm", " "], -1)) == [0, 3, 2, 3, 1]


def test_spoken_numbers():
    say = K.number_words
    assert [say(n) for n in (0, 13, 85, 100, 342, 1001, 12_345, 2_000_000)] == ["zero", "thirteen", "eighty-five", "one hundred", "three hundred and forty-two", "one thousand and one", "twelve thousand, three hundred and forty-five", "two million"]
    assert K.ordinal_words(21) == "twenty-first" and K.ordinal_words(30) == "thirtieth" and K.ordinal_words(12) == "twelfth"
    assert K.say_numbers("at 9:05 pay $1,250.50 for the 3rd 2.5 or 1,000") == "at nine five pay one thousand, two hundred and fifty dollars and fifty cents for the third two point five or one thousand"
    assert K.cleaned("Dr.  Müller’s 2 cafés") == "doctor muller's two cafes" and K.cut_for_alignment("One two. Three [x] four.", 3, brackets=True) == ["One two.", "Three four."]
