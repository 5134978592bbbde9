"""Checks over models that join their tables anew: read once, listed and counted alike."""

import re

import pytest

from adlens.operators import failures
from adlens.operators import quality as Q


def plan_of(df, capsys, mode="formatted") -> str:
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


@pytest.mark.parametrize("model", ["stg_ad_requests", "stg_ad_impressions"])
def test_checks_read_a_joined_model_once(spark, sf_small, capsys, model):
    from adlens.plans.catalog import wh
    w = wh(spark, sf_small)
    types = [t for t in Q.CHECK_TYPES if t != Q.FK]   # a parent of requests is read besides
    for df in (Q.run_checks(w.model, models=[model], types=types),
               failures.failing_rows(w.model, models=[model], types=types)):
        plan = plan_of(df, capsys)
        scans = [b for b in re.split(r"\n\(\d+\) ", plan) if b.startswith("Scan parquet")]
        assert len([s for s in scans if "l_orderkey" in s]) == 1


SPEC = {"stg_ad_requests": {Q.NN: ["device"], Q.U: ["request_id"], Q.AR: {"n": (1, 10)},
                            Q.FK: {"session_id": ("parents", "sid")}},
        "parents": {Q.U: ["sid"]}}


@pytest.mark.parametrize("parent", ["small", "packed", "hashed"])
def test_joined_models_list_and_count_the_same(spark, monkeypatch, parent):
    """A row that violates 2,500 times over is listed as often; all kinds of parents agree."""
    if parent != "small":
        monkeypatch.setattr(Q, "is_small", lambda df: False)
        monkeypatch.setattr(failures, "is_small", lambda df: False)
    text = "md5(CAST({} AS STRING))" if parent == "hashed" else "CAST({} AS STRING)"
    rows = spark.range(2500).selectExpr("'same' AS request_id", "CAST(NULL AS STRING) AS device", "11 AS n",
                                        f"{text.format(5)} AS session_id").union(
        spark.range(100).selectExpr("concat('r', id)", "'tv'", "5", text.format("nullif(id, 3)")))
    tables = {"stg_ad_requests": rows, "parents": spark.range(90).selectExpr(f"{text.format('id')} AS sid")}
    monkeypatch.setattr(Q, "CHECKS", SPEC)
    want = {(Q.NN, "device"): 2500, (Q.AR, "n"): 2500, (Q.U, "request_id"): 1, (Q.FK, "session_id"): 10}
    report = {(r.check_name, r.column_name): r.failures for r in Q.run_checks(
        tables.__getitem__).collect() if r.failures}
    got = failures.failing_rows(tables.__getitem__, checks=SPEC)
    listed = {(r.check_name, r.column_name): r["count"] for r in got.groupBy(
        "check_name", "column_name").count().collect()}
    assert report == listed == want
    assert {(r.row_key, r.value, r.n_rows) for r in got.where("check_name = 'not_null'").collect()} == {
        ("same", None, 1)}
    assert [(r.row_key, r.value, r.n_rows) for r in got.where("check_name = 'unique'").collect()] == [
        (None, "same", 2500)]
