"""Data-quality checks on frames with planted defects."""

import pytest
from pyspark.sql import functions as F

from adlens.operators import quality as Q
from adlens.sources.schemas import CONTRACTS


def test_declared_check_counts_match_the_suite():
    counts = Q.count_checks()
    assert counts == {"not_null": 194, "unique": 24, "unique_combination_of_columns": 3,
                      "accepted_values": 16, "relationships": 18, "accepted_range": 40}
    assert sum(counts.values()) == 295


def _report(spark, models, spec_override):
    saved = dict(Q.CHECKS)
    try:
        Q.CHECKS.clear()
        Q.CHECKS.update(spec_override)
        rows = Q.run_checks(models.__getitem__).collect()
    finally:
        Q.CHECKS.clear()
        Q.CHECKS.update(saved)
    return {(r.model, r.check_name, r.column_name): r.failures for r in rows}


def test_planted_defects_are_counted(spark):
    child = spark.createDataFrame(
        [("a", "x", 1, "p1"), ("a", "y", 50, "p1"), ("b", None, 7, "p9"),
         ("c", "z", None, None), ("c", "zz", 3, "p2")],
        "id string, kind string, n int, parent string")
    parent = spark.createDataFrame([("p1",), ("p2",)], "pid string")
    spec = {
        "child": {Q.NN: ["kind", "n"], Q.U: ["id"], Q.UC: [["id", "kind"]],
                  Q.AV: {"kind": ["x", "y", "z"]}, Q.AR: {"n": (1, 10)},
                  Q.FK: {"parent": ("parent_t", "pid")}},
        "parent_t": {Q.U: ["pid"]},
    }
    got = _report(spark, {"child": child, "parent_t": parent}, spec)
    assert got[("child", Q.NN, "kind")] == 1
    assert got[("child", Q.NN, "n")] == 1
    assert got[("child", Q.U, "id")] == 2              # 'a' and 'c' repeat
    assert got[("child", Q.UC, "id,kind")] == 0
    assert got[("child", Q.AV, "kind")] == 1           # distinct bad value 'zz'
    assert got[("child", Q.AR, "n")] == 1              # 50; null passes
    assert got[("child", Q.FK, "parent")] == 1         # p9; null child key passes
    assert got[("parent_t", Q.U, "pid")] == 0


def test_orphans_of_a_large_parent_are_counted_by_row(spark, monkeypatch):
    """A third of the rows have one lost parent; null keys pass."""
    child = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'lost' WHEN id % 3 = 1 THEN concat('p', id % 50) END AS parent")
    parent = spark.range(49).selectExpr("concat('p', id) AS pid")     # p49 is missing
    spec = {"child": {Q.FK: {"parent": ("parent_t", "pid")}}, "parent_t": {Q.U: ["pid"]}}
    frames = {"child": child, "parent_t": parent}
    small = _report(spark, frames, spec)
    monkeypatch.setattr(Q, "is_small", lambda df: False)
    assert _report(spark, frames, spec) == small
    assert small[("child", Q.FK, "parent")] == 1000 + sum(
        i % 3 == 1 and i % 50 == 49 for i in range(3000))
    clean = {**frames, "child": child.filter("parent = 'p1'")}
    assert _report(spark, clean, spec)[("child", Q.FK, "parent")] == 0


def test_assert_clean_raises_on_failure(spark):
    report = spark.createDataFrame([("m", "unique", "c", 2)],
                                   "model string, check_name string, column_name string, failures long")
    with pytest.raises(AssertionError):
        Q.assert_clean(report)


def test_contract_detects_type_and_shape_changes(spark):
    contract = CONTRACTS["dim_ad_slots"]
    ok = spark.createDataFrame([], contract)
    assert Q.contract_diff("dim_ad_slots", ok, contract) == []
    bad = ok.withColumn("typical_duration_sec", F.col("typical_duration_sec").cast("int")) \
        .withColumn("extra", F.lit(1))
    diffs = Q.contract_diff("dim_ad_slots", bad, contract)
    assert ("dim_ad_slots", "typical_duration_sec", "smallint", "int") in diffs
    assert any(d[1] == "extra" for d in diffs)
    with pytest.raises(ValueError):
        Q.enforce_contract("dim_ad_slots", bad, contract)


def test_every_model_keeps_its_contract_and_slots_are_the_fixed_six(spark, sf_small):
    from adlens import constants as C
    from adlens.plans.warehouse import Warehouse
    w = Warehouse.from_testdata(spark, sf_small)
    for model, contract in CONTRACTS.items():
        assert Q.contract_diff(model, w.model(model), contract) == [], model
    assert [r.slot_position for r in w.stg["stg_ad_slots"].collect()] == C.SLOT_ORDER
    assert w.dim_ad_slots.select("slot_key").distinct().count() == len(C.SLOT_ORDER)


def test_a_parent_over_the_row_bound_with_a_small_key_set_is_looked_up(spark, capsys, monkeypatch):
    """More rows than a broadcast dimension may have, but a small set of keys: checked
    in the counting pass, the children are not shuffled by the key."""
    parent = spark.range(200_001).selectExpr("id AS pk")
    child = spark.range(20).selectExpr("id + 199990 AS fk")
    monkeypatch.setattr(Q, "CHECKS", {"child": {Q.FK: {"fk": ("parent", "pk")}}})
    out = Q.run_checks({"parent": parent, "child": child}.__getitem__, types=[Q.FK])
    assert out.first().failures == 9
    capsys.readouterr()
    out.explain()
    assert "LeftAnti" not in capsys.readouterr().out
