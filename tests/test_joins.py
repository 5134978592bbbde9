"""Join helpers: one-row totals without a join, size-checked broadcast, and the
calendar over data-derived bounds."""

from datetime import date

import pytest

from pyspark.sql import functions as F

from adlens.functions import joins as J
from adlens.functions.joins import broadcast_if_small, is_small, with_totals
from adlens.operators.dims import calendar, calendar_between


def plan_text(df, capsys, mode="simple") -> str:
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_with_totals_attaches_one_row_values_without_a_join(spark, capsys):
    df = spark.range(10).select("id", F.col("id").cast("decimal(12,2)").alias("x"))
    totals = df.agg(F.sum("x").alias("tot"), F.count(F.lit(1)).alias("n"))
    out = with_totals(df, totals)
    assert out.columns == ["id", "x", "tot", "n"]
    rows = out.orderBy("id").collect()
    assert len(rows) == 10 and {(r.tot, r.n) for r in rows} == {(45, 10)}
    plan = plan_text(out, capsys)
    assert "Join" not in plan and "Subquery" in plan


def test_with_totals_keeps_an_empty_side_empty(spark):
    empty = spark.range(0).select("id")
    out = with_totals(empty, spark.range(5).agg(F.count(F.lit(1)).alias("n")))
    assert out.count() == 0


def test_is_small_bounds_rows(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert is_small(df, max_rows=100)
    assert not is_small(df, max_rows=99)


def test_is_small_bounds_bytes(spark):
    # 100 rows of 1,000-character strings: about 100 kB of column data
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert is_small(df, max_rows=1000, max_bytes=200_000)
    assert not is_small(df, max_rows=1000, max_bytes=50_000)


def test_broadcast_if_small_hints_only_under_the_bound(spark, capsys):
    small = spark.range(10).select(F.col("id").alias("k"))
    big = spark.range(1000).select(F.col("id").alias("k"))
    fact = spark.range(1000).select(F.col("id").alias("k"))
    hinted = fact.join(broadcast_if_small(small, max_rows=100), "k")
    plain = fact.join(broadcast_if_small(big, max_rows=100), "k")
    assert "strategy=broadcast" in plan_text(hinted, capsys, "extended")
    assert "strategy=broadcast" not in plan_text(plain, capsys, "extended")
    assert J.DEFAULT_BROADCAST_BYTES > 0


def test_calendar_between_matches_fixed_calendar(spark):
    fixed = calendar(spark, date(2024, 2, 27), date(2024, 3, 2))
    bounds = spark.range(1).select(F.lit(date(2024, 2, 27)).alias("start_date"),
                                   F.lit(date(2024, 3, 2)).alias("end_date"))
    derived = calendar_between(bounds)
    assert derived.schema == fixed.schema
    assert derived.exceptAll(fixed).count() == 0 and fixed.count() == 5
    days = [r.date_key for r in derived.orderBy("date_key").collect()]
    assert days == [20240227, 20240228, 20240229, 20240301, 20240302]


def test_cluster_sessions_get_shuffles_sized_by_cores():
    from adlens import session as S

    class Conf(dict):
        def contains(self, k):
            return k in self

        def set(self, k, v):
            self[k] = v

    class Ctx:
        def __init__(self, master, conf):
            self.master, self._conf, self.defaultParallelism = master, conf, 8000

        def getConf(self):
            return self._conf

    class Session:
        def __init__(self, master, launch=None):
            self.sparkContext = Ctx(master, Conf(launch or {}))
            self.conf = Conf()

    cluster = Session("yarn")
    S.size_shuffles(cluster)
    assert cluster.conf["spark.sql.shuffle.partitions"] == str(8 * 8000)
    assert cluster.conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    preset = Session("yarn", {"spark.sql.shuffle.partitions": "5000"})
    S.size_shuffles(preset)
    assert preset.conf == {}
    local = Session("local[8]")
    S.size_shuffles(local)
    assert local.conf == {}


def test_checkpoint_folder_when_the_session_names_none():
    """A local session without spark.checkpoint.dir gets a folder of its own on
    the context (the setting itself cannot change at run time); a cluster
    session without one is refused."""
    from adlens import session as S

    class Ctx:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d + "/ctx"

    class Conf:
        def get(self, k, default=None):
            return default

        def set(self, k, v):
            raise AssertionError("runtime change of a launch-time setting")

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Ctx(master), Conf()

    local = Session("local[2]")
    first = S.ensure_checkpoint_dir(local)
    assert local.sparkContext.dir == first + "/ctx"
    assert S.ensure_checkpoint_dir(local) == first + "/ctx"     # stable afterwards
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(Session("yarn"))


@pytest.mark.parametrize("id_rows", [5, 4])
def test_large_plain_dimension_only_filters(spark, capsys, monkeypatch, id_rows):
    """Over the bound of a dimension its ids alone are sent; over theirs the join shuffles."""
    monkeypatch.setattr(J, "ID_SET_ROWS", id_rows)
    monkeypatch.setattr(J, "is_small", lambda df: False)
    fact = spark.range(50).selectExpr("id", "CAST(nullif(id % 7, 0) AS STRING) AS cid")
    dim = spark.range(5).selectExpr("md5(CAST(id AS STRING)) AS ckey", "CAST(id AS STRING) AS cid")
    out = J.attach_key(fact, dim, "ckey", "cid")
    want = fact.join(dim, "cid").select(*out.columns)
    assert sorted(out.collect()) == sorted(want.collect()) and out.count() > 0
    plan = plan_text(out, capsys, "extended")
    assert "LeftSemi" in plan
    assert ("strategy=broadcast" in plan) == (id_rows == 5)


def test_repeated_or_foreign_keys_of_a_large_dimension_still_join(spark, monkeypatch):
    monkeypatch.setattr(J, "is_small", lambda df: False)
    fact = spark.createDataFrame([("1", 10), ("2", 20), (None, 30), ("9", 40)], "cid string, x int")
    for rows in ([("a", "1"), ("b", "1"), ("c", None)], [("k1", "1"), ("k2", "2")]):
        dim = spark.createDataFrame(rows, "ckey string, cid string")
        out = J.attach_key(fact, dim, "ckey", "cid")
        assert sorted(out.collect()) == sorted(fact.join(dim, "cid").select(*out.columns).collect())
        assert out.count() == 2
