from __future__ import annotations

import os

from millrace.functions.text import common_suffix_length


def test_common_suffix_of_any_length(spark):
    long = "ж" * 130 + "/🎧.wav"
    groups = {"long": [f"a{long}", f"bc{long}", None], "one": ["only.wav"], "none": ["a", "b"], "empty": ["", ""], "null": [None], "whole": ["x.wav", "yx.wav"], "shorter": ["", "x"]}
    df = spark.createDataFrame([(k, t) for k, v in groups.items() for t in v], "k string, t string")
    want = {k: len(os.path.commonprefix([t[::-1] for t in v if t is not None])) for k, v in groups.items()}
    assert {r[0]: r[1] for r in df.groupBy("k").agg(common_suffix_length("t")).collect()} == want
    assert {r[0]: r[1] for r in df.groupBy("k").agg(common_suffix_length("t", 12)).collect()} == {k: min(n, 12) for k, n in want.items()}
