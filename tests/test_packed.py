"""Packed sets, codes and keys against plain joins."""

import re

import pytest
from pyspark.sql import functions as F

from adlens.functions import joins as J
from adlens.functions import packed as P
from adlens.operators import marts


def plan_of(df, capsys, mode="formatted") -> str:
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_packed_texts_come_back(spark):
    texts = ["", "a", "0" * 32, "F" * 32, "f" * 32, "g" * 32, "0" * 31, "x" * 15, "y" * 16, "é" * 16, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", P.packed_text("t"))
    got = df.withColumn("back", P.unpacked_text("p")).withColumn("q", F.expr(P.PACKED_SQL.format("t"))).collect()
    assert [r.back for r in got] == texts and all(r.p == r.q for r in got)
    assert len({r.p for r in got}) == len(texts)
    assert len(got[2].p) == 17


def test_kept_ids_equal_a_semi_join(spark):
    ids = spark.range(0, 5000, 3).selectExpr("concat('s_', lpad(CAST(id AS STRING), 6, '0')) AS id").union(
        spark.createDataFrame([("7",), ("07",), (None,), ("s_000003",)], "id string"))
    rows = spark.range(6000).selectExpr("concat('s_', lpad(CAST(id AS STRING), 6, '0')) AS id").union(
        spark.createDataFrame([("7",), ("07",), ("007",), ("",), (None,), ("s_00000x",), ("s_000003",),
                               ("+07",), ("s_0003",)], "id string"))
    assert P.packs(ids)
    want = sorted(r.id for r in rows.join(ids, "id", "left_semi").collect())
    assert sorted(r.id for r in P.keep_held(rows, "id", ids).collect()) == want and len(want) > 1600
    assert not P.packs(ids.union(spark.createDataFrame([("abc",)], "id string")))
    assert not P.packs(spark.range(50).selectExpr("concat(id, '-000') AS id"))   # a block each
    assert not P.packs(spark.range(50).selectExpr("md5(CAST(id AS STRING)) AS id"))


def test_large_dimension_of_dense_ids_is_sent_packed(spark, monkeypatch, capsys):
    """Beyond the bound of an id set the rows of the fact are still not shuffled."""
    monkeypatch.setattr(J, "ID_SET_ROWS", 10)
    monkeypatch.setattr(J, "is_small", lambda df: False)
    fact = spark.range(900).selectExpr("id", "CAST(nullif(id % 700, 0) AS STRING) AS cid")
    dim = spark.range(500).selectExpr("md5(CAST(id AS STRING)) AS ckey", "CAST(id AS STRING) AS cid")
    out = J.attach_key(fact, dim, "ckey", "cid")
    assert sorted(out.collect()) == sorted(fact.join(dim, "cid").select(*out.columns).collect())
    assert "_bits" in plan_of(out, capsys) and "SortMergeJoin" not in plan_of(out, capsys)


@pytest.mark.parametrize("repeat", [False, True])
def test_looked_up_values_equal_a_join(spark, monkeypatch, capsys, repeat):
    table = spark.range(-100, 900).where("id % 7 <> 0").selectExpr(
        "id AS k", "nullif(concat('b', id % 5), 'b3') AS b", "concat('t', id % 3) AS t")
    if repeat:
        table = table.union(spark.createDataFrame([(5, "b9", "t9"), (None, "b0", "t0")], "k long, b string, t string"))
    rows = spark.range(-200, 1000).selectExpr("id", "nullif(id, 4) AS n")
    rows = rows.union(rows.where("id < 50"))
    want = sorted(map(str, rows.join(table, F.col("n") == F.col("k")).select("id", "n", "k", "b", "t").collect()))
    small = J.is_small
    monkeypatch.setattr(J, "is_small", lambda df, *most: bool(most) and small(df, *most))
    out = P.look_up(rows, "n", table, "k", ["b", "t"]).select("id", "n", "k", "b", "t")
    assert sorted(map(str, out.collect())) == want and len(want) > 800
    assert ("_codes" in plan_of(out, capsys)) == (not repeat)


def test_genres_are_combined_before_the_shuffle(spark, capsys, monkeypatch):
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_ROWS", 1)
    fact = spark.range(300).selectExpr("concat('c', id % 40) AS content_key", "CAST(id % 3 AS INT) AS date_key",
                                       "CAST(id AS DECIMAL(12,6)) AS revenue_usd",
                                       "CAST(id % 30 AS SMALLINT) AS view_duration_sec")
    dim = spark.range(30).selectExpr("concat('c', id) AS content_key", "concat('g', id % 4) AS genre")
    dim = dim.union(dim.where("content_key = 'c1'"))
    out = marts.mart_content_monetization(fact, dim)
    shuffled = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(out, capsys, "simple"))
    assert shuffled and not any("content_key" in x for x in shuffled)
    got = out.collect()
    monkeypatch.setattr(marts, "is_small_id_set", lambda df: False)
    assert sorted(got) == sorted(marts.mart_content_monetization(fact, dim).collect())


def test_facts_are_written_without_a_sort(spark, sf_small, monkeypatch):
    """A sort of rows of a kilobyte each spilled."""
    from adlens.plans.warehouse import Warehouse
    from pyspark.sql import DataFrame

    def sort(*_, **__):
        raise AssertionError("sorted")

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", sort)
    w = Warehouse(spark, {}, persist=True)
    df = spark.range(5).selectExpr("id AS date_key")
    assert sorted(r.date_key for r in w._fact("unsorted", df).collect()) == [0, 1, 2, 3, 4]
