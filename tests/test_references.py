import datetime as dt

import pytest

from clauseworks.operators import references as rf

T = lambda d: dt.datetime(2024, 1, d)
DOC = "document_id string, ingested_at timestamp, deleted_at timestamp, reason string"
PROV = "provision_id string, document_id string, ingested_at timestamp, deleted_at timestamp, period string"
REQ = "requirement_id string, document_id string, provision_id string, ingested_at timestamp"


def tables(spark, docs, provs, reqs):
    return {"documents": spark.createDataFrame(docs, DOC), "provisions": spark.createDataFrame(provs, PROV), "requirements": spark.createDataFrame(reqs, REQ)}


def found(t):
    return {tuple(r) for r in rf.all_orphans(t).select("field_name", "rec_id", "reason", "period").collect()}


def test_reasons_nulls_and_repeats(spark):
    t = tables(
        spark,
        [("d1", T(1), None, "x"), ("d1", T(9), None, "x"), ("gone", T(1), T(2), "x"), ("late", T(20), None, "x"), (None, T(1), None, "x"), ("", T(1), None, "x")],
        [("p1", "d1", T(3), None, "x"), ("p1", "d1", T(3), None, "x"), ("p2", "gone", T(3), None, "x"), ("p3", "late", T(3), None, "x"), ("p4", None, T(3), None, "x"), ("p5", "D1", T(3), None, "x"), ("p6", "", T(3), None, "x"), ("p7", "nope", None, None, "x")],
        [("r1", "d1", "p1", T(5)), ("r2", None, "absent", T(5)), ("r2", None, "absent", T(2)), (None, "nope", "nope", T(5))],
    )
    assert found(t) == {
        ("provisions.document_id", "p2", "deleted", "2024-01"), ("provisions.document_id", "p3", "late", "2024-01"), ("provisions.document_id", "p5", "missing", "2024-01"),
        ("provisions.document_id", "p7", "missing", None), ("requirements.provision_id", "r2", "missing", "2024-01"),
    }


def test_empty_tables_and_report(spark):
    assert found(tables(spark, [], [], [])) == set()
    t = tables(spark, [], [("p1", "d", T(1), None, "x")], [])
    rows = [r.asDict() for r in rf.orphan_report(t).collect()]
    assert rows == [{"field_name": "provisions.document_id", "period": "2024-01", "n_references": 1, "n_missing": 1, "n_deleted": 0, "n_late": 0}]


@pytest.mark.parametrize("hot", [2, 100, rf.HOT_ROWS])
def test_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(rf, "HOT_ROWS", hot)
    docs = [("d3", T(1), None, "x"), ("gone", T(1), T(2), "x"), ("after", T(9), None, "x"), ("fine", T(1), None, "x")]
    provs = [(f"p{i}", ("hot", "gone", "after", "fine")[i % 4] if i % 5 else f"d{i}", T(1 + i % 20), None, "x") for i in range(900)]
    got = found(tables(spark, docs, provs, []))
    parents = {d[0]: d for d in docs}
    wanted = set()
    for p, key, first, _, _ in provs:
        d = parents.get(key)
        reason = "missing" if d is None else "deleted" if d[2] else "late" if d[1] > first else None
        if reason:
            wanted.add(("provisions.document_id", p, reason, "2024-01"))
    assert got == wanted and {r[2] for r in got} == {"missing", "deleted", "late"}


def test_records_of_hot_keys_are_not_shuffled_by_key(spark):
    t = tables(spark, [("d", T(1), None, "x")], [(f"p{i}", "hot", T(1), None, "x") for i in range(50)], [])
    records = rf.referring_records(t["provisions"], rf.REFERENCES[1])
    bad = rf.bad_keys(records, rf.parent_states(t["documents"], "document_id"))
    assert [tuple(r)[:2] + (r["state"],) for r in bad.collect()] == [("hot", 50, "missing")]
    plan = rf.orphans(t["provisions"], t["documents"], rf.REFERENCES[1])._jdf.queryExecution().sparkPlan().toString()
    assert "LeftAnti, BuildRight" in plan and plan.count("BroadcastHashJoin") >= 2
