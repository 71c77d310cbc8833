from __future__ import annotations

from types import SimpleNamespace

import pytest

from millrace.session import shared_dir, stage


def without_setting(spark, master):
    context = spark.sparkContext
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master=master, applicationId="test-app", _jvm=context._jvm, _jsc=context._jsc),
    )


def test_a_local_session_gets_a_folder_and_a_cluster_must_name_one(spark):
    made = shared_dir(without_setting(spark, "local[2]"))
    assert made.startswith("file:///") and made == shared_dir(without_setting(spark, "local[2]"))
    with pytest.raises(ValueError):
        shared_dir(without_setting(spark, "spark://host:7077"))
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "hdfs://x/shared/"))
    assert shared_dir(named) == "hdfs://x/shared"


def test_staged_tables_keep_their_schema_and_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) as t", "array(id) as a")
    got = stage(df)
    assert got.dtypes == df.dtypes and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert stage(df.where("false")).count() == 0
