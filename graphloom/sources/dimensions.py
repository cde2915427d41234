"""Dimensions from their published documents: core classes, names of packs, registered packs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORE = "class_types array<string>, hidden_prompt_class_types array<string>, inputs map<string, array<string>>"
PACK_LINE = "pack_id string, cnr_id string, repo string, repo_url string"


def core_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(core_classes, core_inputs) of a JSON document with class_types, hidden_prompt_class_types
    and inputs. A document without classes is an error: everything would become unknown."""
    document = spark.read.schema(CORE).option("multiLine", "true").json(path)
    hidden = F.coalesce("hidden_prompt_class_types", F.array().cast("array<string>"))
    classes = document.select(F.explode("class_types").alias("class_type"), hidden.alias("hidden")).select(
        "class_type", F.array_contains("hidden", F.col("class_type")).alias("hidden_prompt")
    )
    if classes.isEmpty():
        raise ValueError(f"{path} lists no core classes")
    inputs = document.select(F.explode("inputs").alias("class_type", "names")).select("class_type", F.explode("names").alias("input"))
    return classes, inputs


def declared_inputs(inputs: DataFrame, limit: int = 100_000) -> dict[str, list[str]]:
    """Inputs by class for the derivation; core classes only, so the table is small and checked."""
    rows = inputs.groupBy("class_type").agg(F.sort_array(F.collect_set("input")).alias("names")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} classes declare inputs")
    return {r["class_type"]: r["names"] for r in rows}


def name_map(spark: SparkSession, path: str) -> DataFrame:
    """Rows like those of pack_nodes from a document of repository to [[class names], {facts}]."""
    document = spark.read.option("wholetext", "true").text(path)
    pairs = document.select(F.explode(F.from_json("value", "map<string,string>")).alias("repo", "value"))
    names = F.from_json(F.get_json_object("value", "$[0]"), "array<string>")
    none = F.lit("")
    return pairs.select("repo", F.explode(names).alias("class_type")).select(
        "class_type", none.alias("pack_id"), "repo", none.alias("version"), none.alias("schema_hash"), F.lit("manager-node-map").alias("source")
    )


def pack_lines(spark: SparkSession, path: str) -> DataFrame:
    """Registered packs, one JSON object a line; broken lines are skipped."""
    return spark.read.schema(PACK_LINE).option("mode", "DROPMALFORMED").json(path)
