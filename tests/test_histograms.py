from __future__ import annotations

from millrace.operators.aggregates import dense_histogram


def test_dense_up_to_the_largest_value(spark):
    df = spark.createDataFrame([(3,), (450,), (450,), (None,)], "w int")
    got = {r["value"]: r["n"] for r in dense_histogram(df, "w").collect()}
    assert got == {i: 0 for i in range(451)} | {3: 1, 450: 2}
    assert sum(r["n"] for r in dense_histogram(df, "w", 400).collect()) == 1
    assert dense_histogram(df.where("false"), "w").count() == 0
