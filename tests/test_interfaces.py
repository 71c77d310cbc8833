from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions import tokens as K
from millrace.functions.prompts import formatted
from millrace.functions.tokenizers import TOKENIZERS, Bytes, tokenizer
from millrace.functions.tokenizers import register as register_tokenizer
from millrace.operators import aggregates as A
from millrace.operators import buckets as B
from millrace.operators import mergeable as G
from millrace.operators.joins import hot_keys, join_skewed
from millrace.session import fresh_path, scratch, stage
from millrace.sources import corpus as C
from millrace.sources import hub as H
from millrace.sources import manifest as M

ODD = ["", None, "naïve 你好 🙂", "a  b\tc", "x" * 3000, "<s> the end </s>"]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id long, text string, ids string")


@pytest.mark.parametrize("name", ["byte", "char", "sentencepiece", "library", "ranks"])
def test_tokenizers_go_there_and_back(spark, name):
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    args = {"char": [sorted(set("".join(t for t in ODD if t)))], "sentencepiece": ["/opt/tokenizers/piece_bpe_32k.model"], "library": ["/opt/tokenizers/byte_bpe_50k.json"], "ranks": ["/opt/tokenizers/byte_bpe_50k.tiktoken", pattern]}
    tok = tokenizer(name, *args.get(name, [])).with_special(bos="<begin>", eos="<end>")
    assert tok.special_id("eod") == tok.special_id("eos") == tok.vocab_size - 1
    df = rows(spark, ODD).withColumn("got", tok.ids("text", ["bos"], ["eos"]))
    got = df.select("text", "got", tok.text("got").alias("back")).collect()
    for r in got:
        if r["text"] is None:
            assert r["got"] is None and r["back"] is None
            continue
        assert r["got"][0] == tok.special_id("bos") and r["got"][-1] == tok.special_id("eos")
        want = r["text"] if name != "sentencepiece" else " ".join(r["text"].split())
        assert (r["back"] if name != "sentencepiece" else " ".join(r["back"].split())) == want


def test_tokenizers_by_name(spark):
    register_tokenizer("own", Bytes)
    assert "own" in TOKENIZERS and tokenizer("own").vocab_size == 256
    with pytest.raises(ValueError):
        tokenizer("none of that name")
    with pytest.raises(KeyError):
        tokenizer("byte").special_id("pad")
    words = tokenizer("word", ["<unk>", "the", "end"], unk="<unk>")
    assert rows(spark, ["the red end"]).select(words.ids("text")).first()[0] == [1, 0, 2]


def test_states_of_parts_merge_to_the_state_of_the_whole(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a b c", "a x c", "", None]), rng.choice(["a b c", "a b", "q"]), rng.choice([None, 0.5, 2.0]), rng.randrange(1, 5)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, hyp string, ref string, loss double, w long")
    metrics = {"exact": G.exact_match("hyp", "ref"), "wer": G.word_errors("hyp", "ref"), "loss": G.mean_loss("loss", "w"), "ppl": G.perplexity("loss", "w"), "spread": G.spread("w")}
    whole = G.computed(G.updated(df, metrics), metrics).first()
    parts = [G.updated(df.where(F.col("id") % 3 == k), metrics, ["w"]) for k in range(3)]
    assert G.computed(G.merged(parts, metrics), metrics).first() == pytest.approx(tuple(whole))
    assert whole["exact"] == sum(h == r for _, h, r, _, _ in data) / 200
    none = G.computed(G.updated(df.where("false"), metrics), metrics).first()
    assert all(v is None for v in none)


def test_items_by_a_python_parser(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"a": 1}\n\nnot json\n{"a": 2, "b": "x"}\n')
    own = M.python_parser(lambda line, file: json.loads(line) | {"file": file.rsplit("/", 1)[-1]})
    got = M.items(spark, str(tmp_path / "a.txt"), "a int, b string, file string", own, "drop").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, 1, None, "a.txt"), (2, 2, "x", "a.txt")]
    assert M.items(spark, str(tmp_path / "a.txt"), "a int", own, "keep").count() == 3
    with pytest.raises(ValueError, match="1 lines can't be parsed"):
        M.items(spark, str(tmp_path / "a.txt"), "a int", own)


def test_extra_fields_are_checked(spark, tmp_path):
    (tmp_path / "few.txt").write_text("one\ntwo\n")
    df = spark.range(3)
    with pytest.raises(ValueError, match="no such extra field"):
        M.with_extra_fields(df, ["id"], [{"type": "other", "name": "x"}])
    with pytest.raises(ValueError, match="needs a name"):
        M.with_extra_fields(df, ["id"], [{"type": "text_iter", "path": "x"}])
    with pytest.raises(ValueError, match="enough lines"):
        M.with_extra_fields(df, ["id"], [{"type": "text_iter", "name": "x", "path": str(tmp_path / "few.txt")}])
    got = M.with_extra_fields(df, ["id"], [{"type": "text_sample", "name": "x", "path": str(tmp_path / "few.txt"), "seed": 1}]).collect()
    assert len(got) == 3 and {r["x"] for r in got} <= {"one", "two"}
    assert M.with_extra_fields(df.where("false"), ["id"], [{"type": "text_iter", "name": "x", "path": str(tmp_path / "few.txt")}]).count() == 0


def test_a_source_is_left_after_two_shards_without_rows(spark):
    data = [("en", "a", s, i, s not in (1, 2)) for s in range(5) for i in range(2)] + [("en", "b", 0, 9, True), ("de", "a", 0, 1, True), ("en", "c", 0, 1, None)]
    df = spark.createDataFrame(data, "lang string, source string, shard int, k int, ok boolean")
    got = M.source_streams(df, "lang", "source", "shard", ["k"], {"en": ["b", "a", "c"], "de": ["a"]}, F.col("ok")).collect()
    assert sorted((r["lang"], r["place"], r["source"], r["shard"], r["k"]) for r in got) == [("de", 0, "a", 0, 1), ("en", 0, "b", 0, 9), ("en", 1, "a", 0, 0), ("en", 2, "a", 0, 1)]


def test_hub_tables(spark):
    df = spark.createDataFrame([("zip://a/b.flac::https://x", [0.0] * 8), ("/abs/c", [0.0] * 4), ("d.e/f", [])], "path string, array array<double>").select(F.struct("path", "array", F.lit(4).alias("sampling_rate")).alias("audio"), F.lit(" two\nlines ").alias("text"))
    assert [tuple(r) for r in H.as_manifest(df, "/base/").collect()] == [("/base/a/b.wav", " two\nlines ", 2.0), ("/abs/c.wav", " two\nlines ", 1.0), ("/base/d.e/f.wav", " two\nlines ", 0.0)]
    out = fresh_path(spark, "hub")
    df.write.parquet(out)
    assert {r["text"] for r in H.read_hub_table(spark, out).collect()} == {"two lines"}
    with pytest.raises(ValueError, match="no field 'none'"):
        H.read_hub_table(spark, out, audio_key="audio.none")
    plan = H.read_hub_table(spark, out).select("text")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_token_files_and_blends(spark, tmp_path):
    data = [(i, list(range(i % 7))) for i in range(50)]
    df = spark.createDataFrame(data, "k long, ids array<int>").repartition(3)
    prefixes = C.write_token_files(df, ["k"], "ids", str(tmp_path), parts=3)
    got = [r["tokens"] for p in prefixes for r in C.read_token_files(spark, p, 10).orderBy("sequence").collect()]
    assert got == [x for _, x in data]
    (tmp_path / "bad.idx").write_bytes(b"x" * 40)
    with pytest.raises(ValueError):
        C.read_token_files(spark, str(tmp_path / "bad"))
    assert C.weighted_paths(["30", "a", "70", "b"]) == [(30.0, "a"), (70.0, "b")] and C.weighted_paths(["a", "b"]) == [(1.0, "a"), (1.0, "b")]
    for bad in ([], ["30", "a", "70"], ["30", "a", "b", "c"]):
        with pytest.raises(ValueError):
            C.weighted_paths(bad)
    samples = C.token_samples(df, ["k"], "ids", 4)
    got = C.blended([(1.0, samples), (3.0, samples)], 40, 8).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {0: 10, 1: 30}
    with pytest.raises(ValueError):
        C.blended([(1.0, samples.where("false"))], 4)


def test_masks_coders_and_formatted_rows(spark):
    df = spark.createDataFrame([([3, 2, 1],), ([],), (None,)], "n array<int>")
    got = [r[0] for r in df.select(B.block_causal_mask(F.col("n"))).collect()]
    want = [[int(a == b and j <= i) for j, b in enumerate([0, 0, 0, 1, 1, 2])] for i, a in enumerate([0, 0, 0, 1, 1, 2])]
    assert [[int(x) for x in row] for row in got[0]] == want and not got[1] and got[2] is None
    t = spark.createDataFrame([(5, "b", 1.0), (7, "a", 2.0), (5, None, 3.0)], "x long, c string, f double")
    assert [r[0] for r in t.select(K.row_codes(t, [("x", "int", {"length": 1}), ("c", "category")])).collect()] == [[0, 102], [2, 101], [0, 103]]
    with pytest.raises(ValueError):
        K.row_codes(t, [("x", "other")])
    with pytest.raises(ValueError):
        K.category_codes(t, "c", most=1)
    f = formatted(rows(spark, ODD).select("id", F.lit("ab").alias("p"), "text"), "p", "text", tokenizer("byte").ids).where("id = 1").first()
    assert (f["input_length"], f["output_length"], f["total_length"], f["mask"]) == (2, 0, 2, [False, False])
    one = rows(spark, ["Ab"])
    labels = [" ", "a", "b"]
    assert one.select(K.transcript_parser("base")("text", labels, lower=False)).first()[0] == [2]
    assert one.select(K.transcript_parser("en")("text", labels)).first()[0] == [1, 2]
    with pytest.raises(ValueError):
        K.transcript_parser("other")


def test_first_fit_in_shuffled_order(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.randrange(1, 10)) for i in range(300)], "k long, n int")
    got = B.first_fit_shuffled(df, "k", "n", 10, seed=1).toPandas()
    import hashlib

    packs = []
    for r in sorted(got.itertuples(), key=lambda r: (hashlib.md5(f"1:{r.k}".encode()).hexdigest(), r.k)):
        at = next((i for i, u in enumerate(packs) if u + r.n <= 10), len(packs))
        packs[at:] = packs[at:] or [0]
        packs[at] += r.n
        assert at == r.pack
    cells = B.first_fit_shuffled(df, "k", "n", 10, cells=4).toPandas()
    assert cells.groupby(["cell", "pack"])["n"].sum().max() <= 10 and len(cells) == 300


def test_word_pairs_and_prefixes(spark):
    t = rows(spark, ["a b a", "b", None])
    counts = {tuple(r) for r in A.ngram_counts(t.where("text is not null"), T.split_words("text")).collect()}
    assert counts == {("<s>", "a", 1), ("a", "b", 1), ("b", "a", 1), ("a", "</s>", 1), ("<s>", "b", 1), ("b", "</s>", 1)}
    p = spark.createDataFrame([("abc", "abd"), ("", "x"), ("same", "same"), (None, "x"), ("long", "lo")], "a string, b string")
    assert [r[0] for r in p.select(T.newly_stable("a", "b")).collect()] == ["d", "x", "", None, ""]


def test_english_tokens(spark):
    said = {"It's 5,300 dogs, isn't it?": "It &apos;s 5,300 dogs , isn &apos;t it ?", "Wait... what": "Wait ... what", "A well-known (and old) fact.": "A well @-@ known ( and old ) fact .", "": "", "a, b & c": "a , b &amp; c"}
    got = [r[0] for r in rows(spark, list(said)).select(T.english_tokens("text")).collect()]
    assert got == list(said.values())


def test_skewed_joins_spread_hot_keys(spark):
    left = spark.createDataFrame([("hot", i) for i in range(4000)] + [(f"k{i}", i) for i in range(500)] + [("none", 1)], "k string, v long")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(500)], "k string, w long")
    hot = hot_keys(left, ["k"], 0.01)
    assert [r[0] for r in hot.collect()] == ["hot"] and hot_keys(left, ["k"], 0.99) is None
    for how, n in (("inner", 4500), ("left", 4501)):
        got = join_skewed(left, right, ["k"], hot, how)
        assert got.count() == n == left.join(right, "k", how).count()
        parts = [r["count"] for r in join_skewed(left.repartition(8), right, ["k"], hot, how).groupBy(F.spark_partition_id()).count().collect()]
        assert max(parts) < 0.3 * n  # no task gets the hot key


def test_word_errors_beyond_any_number_of_distinct_words(spark):
    many, other = " ".join(f"w{i}" for i in range(6500)), " ".join(f"x{i}" for i in range(6500))
    df = spark.createDataFrame([(many, other), ("a b", "a c"), (None, "q"), ("z", None)], "hyp string, ref string")
    got = A.error_rates(df, "hyp", "ref").first()
    assert (got["errors"], got["size"], got["rate"]) == (6503, 6503, 1.0)


def test_scratch_tables_go_with_their_block(spark):
    with scratch(spark):
        there = stage(spark.range(5)).inputFiles()[0]
        assert spark.read.parquet(there).count() >= 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(there).count()


def test_stored_files(spark, tmp_path):
    from millrace.sources.store import StoredFile

    (tmp_path / "a.txt").write_text("one")
    f = StoredFile(spark, f"file://{tmp_path}/store/a.txt", str(tmp_path / "a.txt"))
    assert not f.exists
    f.put()
    other = StoredFile(spark, f"file://{tmp_path}/store/a.txt", str(tmp_path / "copy" / "a.txt"))
    assert f.exists and open(other.get()).read() == "one"
    (tmp_path / "a.txt").write_text("two")
    f.put()
    assert open(other.get()).read() == "one" and open(other.get(again=True)).read() == "two"
    with pytest.raises(FileNotFoundError):
        StoredFile(spark, f"{tmp_path}/none").get()


def test_matching_of_speakers(spark):
    import numpy as np

    from millrace.operators.scoring import assignment, best_permutation, speaker_word_errors

    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 6)
        m = n + rng.randrange(2)
        cost = np.array([[rng.randrange(9) for _ in range(m)] for _ in range(n)], float)
        import itertools

        pick = assignment(cost)
        assert len(set(pick)) == n and sum(cost[i, j] for i, j in enumerate(pick)) == min(sum(cost[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(cost.shape[1]), n))
    data, want = [], {}
    for s in range(12):
        h, r = ([" ".join(rng.choice("abc") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(4))] for _ in range(2))
        data += [(s, "hyp", f"h{i}", t or None) for i, t in enumerate(h)] + [(s, "ref", f"r{i}", t) for i, t in enumerate(r)]
        if h or r:
            want[s] = (best_permutation(h, r), sum(len(t.split()) for t in r))
    got = speaker_word_errors(spark.createDataFrame(data, "session int, side string, speaker string, text string"), "session", "side", "speaker", "text").collect()
    assert {r["session"]: (r["errors"], r["size"]) for r in got} == want
