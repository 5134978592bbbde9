"""Failing rows of planted defects, and their agreement with the counts."""

import __spark_entry__ as entry_mod
from adlens.operators import failures, recon
from adlens.operators import quality as Q
from pyspark.sql import functions as F

SPEC = {
    "child": {Q.NN: ["kind", "n"], Q.U: ["id"], Q.UC: [["id", "kind"]],
              Q.AV: {"kind": ["x", "y", "z"]}, Q.AR: {"n": (1, 10)},
              Q.FK: {"parent": ("parent_t", "pid")}},
    "parent_t": {Q.U: ["pid"]},
}


def models(spark):
    child = spark.createDataFrame(
        [("a", "x", 1, "p1"), ("a", "y", 50, "p1"), ("b", None, 7, "p9"), ("b", None, 7, "p9"),
         ("c", "z", None, None), ("c", "zz", 0, "p2"), ("d", "zz", 3, "p2"), (None, "x", 4, "p1")],
        "id string, kind string, n int, parent string")
    return {"child": child, "parent_t": spark.createDataFrame([("p1",), ("p2",)], "pid string")}


def rows(df):
    return sorted((tuple(r)[1:] for r in df.collect() if r.model == "child"), key=str)


def test_planted_defects_are_listed(spark):
    got = rows(failures.failing_rows(models(spark).__getitem__, checks=SPEC))
    assert got == sorted([
        (Q.NN, "kind", "b|", None, 1), (Q.NN, "kind", "b|", None, 1), (Q.NN, "n", "c|z", None, 1),
        (Q.AR, "n", "a|y", "50.000000", 1), (Q.AR, "n", "c|zz", "0.000000", 1),
        (Q.FK, "parent", "b|", "p9", 1), (Q.FK, "parent", "b|", "p9", 1),
        (Q.U, "id", None, "a", 2), (Q.U, "id", None, "b", 2), (Q.U, "id", None, "c", 2),
        (Q.UC, "id,kind", None, "b|", 2), (Q.AV, "kind", None, "zz", 2)], key=str)


def test_large_parents_give_the_same(spark, monkeypatch):
    want = rows(failures.failing_rows(models(spark).__getitem__, checks=SPEC))
    monkeypatch.setattr(failures, "is_small", lambda df: False)
    assert rows(failures.failing_rows(models(spark).__getitem__, checks=SPEC)) == want


def test_keys_join_back_to_their_rows(spark):
    tables = models(spark)
    failing = failures.failing_rows(tables.__getitem__, checks=SPEC)
    back = lambda kind, c: sorted(map(str, failures.rows_of(
        tables["child"], failing, "child", kind, c, SPEC).collect()))
    child = tables["child"]
    assert back(Q.U, "id") == sorted(map(str, child.where("id in ('a', 'b', 'c')").collect()))
    assert back(Q.AV, "kind") == sorted(map(str, child.where("kind = 'zz'").collect()))
    assert back(Q.AR, "n") == sorted(map(str, child.where("n in (0, 50)").collect()))
    assert back(Q.UC, "id,kind") == sorted(map(str, child.where("id = 'b'").collect()))


def test_counts_equal_the_report(spark, sf_small):
    q = entry_mod.queries()
    report = {(r.model, r.check_name, r.column_name): r.failures
              for r in q["dq_report"](spark, sf_small).where("failures > 0").collect()}
    listed = {(r.model, r.check_name, r.column_name): r["count"] for r in q["dq_failing_rows"](
        spark, sf_small).groupBy("model", "check_name", "column_name").count().collect()}
    assert report == listed and report


def test_reconciliations_list_what_did_not_pass(spark):
    shares = spark.createDataFrame([(60,), (30,)], "revenue_share_pct int")
    good = spark.createDataFrame([(1, True), (2, False), (3, None)], "x int, passed boolean")
    got = failures.failing_reconciliations(
        {"share": recon.recon_revenue_share(shares), "other": good}).collect()
    assert sorted(map(tuple, got)) == [
        ("other", '{"x":2,"passed":false}'), ("other", '{"x":3,"passed":null}'),
        ("share", '{"total_pct":90,"passed":false}')]
    assert failures.failing_reconciliations({"other": good.where(F.lit(False))}).count() == 0


def test_grouped_checks_aggregate_by_hash(spark, capsys):
    capsys.readouterr()
    failures.failing_rows(models(spark).__getitem__, types=[Q.U, Q.UC, Q.AV], checks=SPEC).explain()
    assert "SortAggregate" not in capsys.readouterr().out
