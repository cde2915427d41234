from graphloom.operators import drift
from graphloom.plans import problems
from graphloom.plans.tables import table
from tests.conftest import SMALL
from tests.test_drift_and_shred import raw


def test_defaults_and_casts_of_the_plan(spark):
    df = raw(
        spark, ("2026-01", "c1", {"k": 1, "gone": 5}), ("2026-02", "c1", {"k": 1, "gone": "5"}), ("2026-03", "c1", {"k": 1, "new": "x"}), ("2026-03", "c2", {"k": 2}),
    )
    flat = drift.flatten(df)
    plan = drift.MigrationPlan(drift.changes(flat), drift.field_types(flat))
    got = {(r["month"], r["capture_id"]): (r["fields"], r["cast"], r["defaulted"]) for r in drift.unify(df, plan).collect()}
    assert got["2026-01", "c1"] == ({"k": "1", "gone": "5", "new": None}, 1, 1)  # a number until it became a string
    assert got["2026-02", "c1"] == ({"k": "1", "gone": "5", "new": None}, 0, 1)
    assert got["2026-03", "c1"] == ({"k": "1", "new": "x"}, 0, 0) and got["2026-03", "c2"] == ({"k": "2", "new": None}, 0, 1)


def test_versions_in_one_notation(spark):
    df = spark.createDataFrame([(1, "w1", "1.24.1", " 0.4"), (10, "w2", "v1.35.3 ", None), (None, "w3", "1.34.3-rc.1", " "), (2, "w4", "nightly", "0.4.0")], "b int, w string, f string, g string")
    got = {r["capture_id"]: (r["month"], r["fields"], r["cast"], r["defaulted"]) for r in drift.unify_versions(df, "t", "b", "w", ["f", "g"]).collect()}
    assert got == {
        "w1": ("01", {"f": "1.24.1", "g": "0.4.0"}, 1, 0), "w2": ("10", {"f": "1.35.3", "g": None}, 1, 1),
        "w3": (None, {"f": "1.34.3-rc.1", "g": None}, 0, 1), "w4": ("02", {"f": "nightly", "g": "0.4.0"}, 0, 0),
    }


def test_unified_table_has_all_fields_and_all_of_derived_workflows(spark):
    got = problems.p2_unified(spark, SMALL).cache()
    assert got.filter("source = 'derived_workflows'").count() == table(spark, SMALL, "derived_workflows").count()
    types = drift.field_types(drift.flatten(table(spark, SMALL, "raw_artifacts"))).collect()
    last = {s: max(r["month"] for r in types if r["source"] == s) for s in {r["source"] for r in types}}
    newest = {s: {r["field"] for r in types if (r["source"], r["month"]) == (s, m)} for s, m in last.items()}
    records = got.filter("source <> 'derived_workflows'").collect()
    assert records and all(newest[r["source"]] <= set(r["fields"]) for r in records)
