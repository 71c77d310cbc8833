from __future__ import annotations

import json
import tarfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import manifest as M
from millrace.sources import tables as S
from millrace.sources.tar import read_tar
from millrace.streaming import utterances as U


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_manifest_aliases(spark, tmp_path):
    rows = [{"audio_filepath": "a.wav", "duration": 1.0, "text": None, "normalized_text": "n"}, {"context": "c.wav", "context_duration": 2, "normalized_text": "n"}, {"video_filename": "v", "duration": 3, "text_filepath": "t.txt", "rttm_filename": "r"}]
    write(tmp_path / "a.json", [json.dumps(rows[0]), "", json.dumps(rows[1])])
    write(tmp_path / "b.json", [json.dumps(rows[2])])
    got = M.canonical(M.scan_lines(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])).orderBy("id").collect()
    assert [r["id"] for r in got] == [0, 1, 2] and [r["audio_file"] for r in got] == ["a.wav", "c.wav", None] and [r["duration"] for r in got] == [1, 2, 3]
    assert [r["text"] for r in got] == ["", "n", ""] and got[2]["rttm_file"] == "r" and got[2]["text_file"] == "t.txt"


def test_manifest_errors(spark, tmp_path):
    p = write(tmp_path / "x.json", ['{"audio_filepath": "a", "duration": 1}', "{bad"])
    with pytest.raises(ValueError, match="1 lines"):
        M.canonical(M.scan_lines(spark, p))
    assert M.canonical(M.scan_lines(spark, p), "drop").count() == 1
    with pytest.raises(ValueError):
        M.parse_lines(M.scan_lines(spark, p), "audio_filepath string")
    assert [r["audio_filepath"] for r in M.parse_lines(M.scan_lines(spark, p), "audio_filepath string", "keep").orderBy("ordinal").collect()] == ["a", None]
    for line in ('{"duration": 1}', '{"audio_filepath": "a"}'):
        with pytest.raises(Exception):
            M.canonical(M.scan_lines(spark, write(tmp_path / "y.json", [line]))).collect()
    empty = write(tmp_path / "z.json", [""])
    assert M.scan_lines(spark, empty).count() == 0


def test_round_trip_and_names(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", 1.5)], "text string, duration double")
    M.write_manifest(df.coalesce(1), str(tmp_path / "m"), ascii_only=True)
    raw = "".join(p.read_text() for p in (tmp_path / "m").glob("part*"))
    assert "\\u00e9" in raw and '"duration":null' in raw and raw.isascii()
    got = M.parse_lines(M.scan_lines(spark, str(tmp_path / "m")), "text string, duration double")
    assert sorted(map(str, got.select("text", "duration").collect())) == sorted(map(str, df.collect()))
    assert M.free_name(spark, str(tmp_path / "m")).endswith("m_prepared1") and M.free_name(spark, str(tmp_path / "new.jsonl")).endswith("new.jsonl")


def test_tables_and_kaldi_without_speakers(spark, tmp_path):
    write(tmp_path / "t.csv", ["a,b", "1,", '"x, y",2'])
    assert [tuple(r) for r in S.read_table(spark, str(tmp_path / "t.csv")).collect()] == [("1", ""), ("x, y", "2")]
    with pytest.raises(ValueError):
        S.read_table(spark, "x.doc")
    write(tmp_path / "wav.scp", ["w1 /a b.wav"])
    write(tmp_path / "segments", ["u1 w1 0.5 2.25", "u2 w9 0 1"])
    write(tmp_path / "text", ["u1 hello there"])
    assert [tuple(r) for r in S.read_kaldi(spark, str(tmp_path)).collect()] == [("u1", "/a b.wav", 0.5, 1.75, "hello there", None)]
    write(tmp_path / "r.rttm", ["SPEAKER rec 1 0.5 1.5 <NA> <NA> ann <NA> <NA>", "NON-LEX rec"])
    assert [tuple(r) for r in S.read_rttm(spark, str(tmp_path / "r.rttm")).collect()] == [("rec", 0.5, 1.5, "ann")]
    with pytest.raises(Exception):
        spark.range(1).select(S.ctm_line(F.lit("r"), "1", F.lit(-1.0), F.lit(1.0), F.lit("w"))).collect()


def test_tar_members(spark, tmp_path):
    for n in (0, 1):
        with tarfile.open(tmp_path / f"audio_{n}.tar", "w") as tar:
            (tmp_path / "x.txt").write_text(f"hello{n}")
            tar.add(tmp_path / "x.txt", arcname=f"dir/x{n}.txt")
    got = read_tar(spark, f"{tmp_path}/*.tar").where("member = 'dir/x1.txt'").collect()
    assert [(r["shard"], r["stem"], bytes(r["payload"])) for r in got] == [("audio_1.tar", "x1", b"hello1")]
    assert M.shard_id("a").__class__ and [r[0] for r in spark.createDataFrame([("audio_12.tar",), ("x.wav",)], "p string").select(M.shard_id("p")).collect()] == [12, None]


FRAMES = [("a", 0, [1, 2], [0.0, 1.0], False), ("a", 1, [2, 3], [1.0, 2.0], False), ("b", 0, [7], [0.0], True), ("a", 2, [3, 4, 5], [2.0, 40.0, 41.0], True), ("c", 0, [], [], True)]


def run(spark, tmp_path, batches, **settings):
    source = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, U.INPUT).coalesce(1).write.mode("append").parquet(str(source / f"part={i}"))
        stream = spark.readStream.schema(U.INPUT).option("recursiveFileLookup", "true").parquet(str(source))
        U.drain(U.utterances(stream, **settings), str(tmp_path / "out"))
    return sorted((r["stream_id"], r["utterance"], r["kind"], tuple(r["tokens"])) for r in spark.read.parquet(str(tmp_path / "out/data")).collect())


def test_utterances_are_alike_over_batches(spark, tmp_path):
    want = [("a", 0, "final", (1, 2, 3)), ("a", 1, "final", (4, 5)), ("b", 0, "final", (7,))]
    assert run(spark, tmp_path / "1", [FRAMES]) == want
    assert run(spark, tmp_path / "2", [FRAMES[:2], FRAMES[2:3], FRAMES[3:]]) == want


def test_partial_outputs(spark, tmp_path):
    got = run(spark, tmp_path, [FRAMES], partials=True)
    assert ("a", 0, "partial", (1, 2)) in got and ("a", 0, "final", (1, 2, 3)) in got


def test_seglst_query_writes_and_reads_every_session(spark, tmp_path, monkeypatch):
    from millrace.plans import sources as P

    rows = [(i, f"ses_{i % 40:08d}", "A", float(i), i + 0.5, "w") for i in range(100)] + [(100, None, "A", 1.0, 2.0, None), (101, "ses_00000001", "A", None, 2.0, "w")]
    spark.createDataFrame(rows, "segment_id long, session_id string, speaker string, start_time double, end_time double, words string").write.parquet(str(tmp_path / "segment.parquet"))
    monkeypatch.setattr(P, "_folder", lambda spark: str(tmp_path / "out"))
    got = P.q_seglst(spark, str(tmp_path)).collect()
    assert sorted((r["session_id"] or "", r["start"], r["end"]) for r in got) == sorted((r[1] or "", r[3], r[4]) for r in rows[:101])
    assert sorted(r["start"] for r in S.read_seglst(spark, str(tmp_path / "out"), "ses_00000001").collect()) == [1.0, 41.0, 81.0]
    back = S.read_seglst(spark, str(tmp_path / "out")).collect()
    assert sorted((r["session_id"] or "", r["start"], r["end"]) for r in back) == sorted((r[1] or "", r[3], r[4]) for r in rows[:101])
