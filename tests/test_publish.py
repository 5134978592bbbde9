"""Publishing: a dead run changes nothing; a day filter opens that day's files."""

import os

import pytest
from pyspark.sql import functions as F

from adlens.plans import publish as P


def tables(spark, n):
    return {name: spark.range(5).select(F.lit(n).alias("build"), F.lit(name).alias("name"), "id")
            for name in ("a", "b", "c")}


def builds(spark, out):
    return {name: [r.build for r in df.select("build").distinct().collect()]
            for name, df in P.published(spark, out).items()}


@pytest.mark.parametrize("dies_at", [0, 1, 2, "manifest"])
def test_a_dead_run_leaves_every_table_at_the_old_version(spark, tmp_path, monkeypatch, dies_at):
    out = str(tmp_path / "out")
    assert P.published(spark, out) == {}
    with monkeypatch.context() as m:
        m.setattr(P, "write_whole", lambda df, path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.publish(spark, tables(spark, 0), out)
    assert P.published(spark, out) == {}
    assert P.publish(spark, tables(spark, 1), out) == 1
    written, write = [], P.write_whole

    def failing(df, path):
        if len(written) == dies_at:
            raise RuntimeError("killed")
        written.append(path)
        write(df, path)

    with monkeypatch.context() as m:
        m.setattr(P, "write_whole", failing)
        if dies_at == "manifest":
            # a manifest file that was being written, not yet renamed
            m.setattr(type(spark), "createDataFrame", lambda *a: 1 / 0)
            task = f"{out}/manifest/000002-x/_temporary/0/task_0"
            os.makedirs(task)
            with open(f"{task}/part-0.json", "w") as f:
                f.write('{"version": 2, "run": "x", "name": "a", "path": "none"}')
        with pytest.raises((RuntimeError, ZeroDivisionError)):
            P.publish(spark, tables(spark, 2), out)
    assert builds(spark, out) == {"a": [1], "b": [1], "c": [1]}
    assert P.publish(spark, tables(spark, 3), out) == 2
    assert builds(spark, out) == {"a": [3], "b": [3], "c": [3]}


def test_a_day_filter_opens_only_that_days_files(spark, tmp_path):
    # one day holds half of all rows
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("impression_id"),
        F.when(F.col("id") % 2 == 0, 20240105).otherwise(
            20240101 + F.col("id") % 9).cast("int").alias("date_key"), F.col("id").alias("n"))
    out = str(tmp_path / "out")
    P.publish(spark, {"fact": df, "other": df.limit(3)}, out, {"fact": "impression_id"})
    back = P.published(spark, out)["fact"]
    assert back.columns == df.columns and back.schema["date_key"].dataType.typeName() == "integer"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    folder = back.inputFiles()[0].split("date_key=")[0].removeprefix("file://").removeprefix("file:")
    files = {d: [f for f in os.listdir(f"{folder}/{d}") if f.endswith(".parquet")]
             for d in os.listdir(folder) if d.startswith("date_key=")}
    assert len(files) == 9 and len(files["date_key=20240105"]) >= 3
    assert sum(map(len, files.values())) <= 8 + 2 * 9
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for day, names in files.items():
            one = back.where(f"date_key = {day.split('=')[1]}")
            plan = one._jdf.queryExecution().executedPlan()
            plan.executeCollect()
            scan = plan.collectLeaves().apply(0)
            assert scan.metrics().apply("numFiles").value() == len(names)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
