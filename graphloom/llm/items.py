"""Shared preparation of the item columns: packs of a workflow, its classes, its captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import squeeze, strip
from graphloom.operators.skew import small_join
from graphloom.sources.shared import materialize


def pack_ids(packs: DataFrame) -> DataFrame:
    """(repo, pack_id): normalised, one row a repo; the least pack_id if several have it."""
    return (
        packs.select(F.lower(strip("repo")).alias("repo"), F.lower(strip("pack_id")).alias("pack_id"))
        .filter((F.col("repo") != "") & (F.col("pack_id") != ""))
        .groupBy("repo").agg(F.min("pack_id").alias("pack_id"))
    )


def pack_rows(workflows: DataFrame, packs: DataFrame, key: str) -> DataFrame:
    """(key, item): the distinct normalised packs of each key; elements stripped and lower-cased,
    a repository replaced by its pack_id, blanks and nulls dropped. Rows with a null key or a
    null array give nothing. The packs are few and go to every task, so rows are sent once, after
    each task has made its own distinct."""
    spelled = (
        workflows.filter(F.col(key).isNotNull())
        .select(key, F.explode("pack_set").alias("raw"))
        .select(key, F.lower(strip("raw")).alias("repo"))
        .filter(F.col("repo") != "")
    )
    return (
        small_join(spelled, materialize(pack_ids(packs), "pack-ids"), ["repo"], [key])
        .select(key, F.coalesce("pack_id", "repo").alias("item")).distinct()
    )


def class_rows(nodes: DataFrame) -> DataFrame:
    """(workflow_id, item): the distinct stripped class_types of each workflow; nulls and blanks
    dropped."""
    return (
        nodes.filter(F.col("workflow_id").isNotNull())
        .select("workflow_id", strip("class_type").alias("item"))
        .filter(F.col("item") != "").distinct()
    )


def class_terms(nodes: DataFrame) -> DataFrame:
    """(field, term, record): one row an occurrence of a class_type, repeats kept."""
    return nodes.select(
        F.lit("class_type").alias("field"), strip("class_type").alias("term"), F.col("workflow_id").alias("record")
    ).filter(F.col("term").isNotNull() & F.col("record").isNotNull())


def tag_terms(raw: DataFrame, *more: Column) -> DataFrame:
    """(field, term, record): one row an occurrence of a normalised tag, repeats kept; ``more`` columns
    stand behind them."""
    tags = raw.filter(F.col("capture_id").isNotNull()).select(
        F.lit("tags").alias("field"), F.col("tags").alias("tags"), F.col("capture_id").alias("record"), *more
    )
    return (
        tags.withColumn("tag", F.explode("tags")).withColumn("term", squeeze("tag")).filter(F.col("term") != "")
        .select("field", "term", "record", *[c for c in tags.columns if c not in ("field", "tags", "record")])
    )
