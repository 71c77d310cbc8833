"""Queries that take whole texts and arrays, over made-up tables."""

from __future__ import annotations

from millrace.plans import registry
from tests.test_operators import brute_emissions


def test_emissions_of_whole_texts(spark, tmp_path):
    texts = {1: "z" * 60 + "a", 2: "abzzzz", 3: "", 4: None, 5: "zażółć 🎧 xyz" * 5, 6: "a" * 50 + "zzzzzz" + "b" * 4, 7: "m" * 40 + "n"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for k, t in texts.items():
        e = [int("a" <= c <= "m") for c in t or ""]
        want[k] = brute_emissions(e, 0, len(e) * 3 // 4, 0, 3)
    assert {r["doc_id"]: r["at"] for r in registry.queries()["q_eou_emissions"](spark, str(tmp_path)).collect()} == want
    assert want[1] == 43 and want[6] is not None


def test_offsets_of_all_steps(spark, tmp_path):
    rows = [(i, "s", "A", float(i), i + 0.5, "w") for i in range(7)] + [(9, "s", "B", 2.0, 3.0, "w")]
    spark.createDataFrame(rows, "segment_id long, session_id string, speaker string, start_time double, end_time double, words string").write.parquet(str(tmp_path / "segment.parquet"))
    got = {r["speaker"]: [tuple(x) for x in r["offsets"]] for r in registry.queries()["q_clamped_offsets"](spark, str(tmp_path)).collect()}
    assert got == {"A": [(4 * i + 4 * (i > 3), 4 * i + 2 + 4 * (i > 3)) for i in range(7)], "B": [(8, 10)]}
