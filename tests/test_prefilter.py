import json

from pyspark.sql import functions as F

from graphloom.functions.jsontext import decode_object
from graphloom.plans import catalog
from graphloom.plans.tables import table
from tests.conftest import SMALL


def test_flags_of_all_readable_records(spark):
    rows = table(spark, SMALL, "raw_artifacts").filter("source = 'galleryhub'").select("source_artifact_id", "source_meta").collect()
    want: dict = {}
    for r in rows:
        if (obj := decode_object(r["source_meta"])) is not None:
            old = want.get(r["source_artifact_id"], (False, False))
            want[r["source_artifact_id"]] = (old[0] or obj.get("hasMeta") is True, old[1] or 86 in (obj.get("toolIds") or []))
    got = catalog.prefilter_flags(spark, SMALL)
    assert {r["source_artifact_id"]: (r["has_meta"], r["marked"]) for r in got.collect()} == want


def test_flags_of_dirty_forms(spark, tmp_path):
    meta = {"hasMeta": True, "toolIds": [86]}
    texts = [json.dumps(meta), json.dumps(json.dumps(meta)), "  \n" + json.dumps(meta), "{", json.dumps([meta]), None]
    df = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "source_artifact_id string, source_meta string").withColumn("source", F.lit("galleryhub"))
    df.write.parquet(str(tmp_path / "raw_artifacts.parquet"))
    assert {tuple(r) for r in catalog.prefilter_flags(spark, str(tmp_path)).collect()} == {(n, True, True) for n in "012"}
