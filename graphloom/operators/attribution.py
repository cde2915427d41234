"""Attribution of nodes to the packs that provide them, by joins.

Dimensions are made unique by their key before the join, so a node row never multiplies; they
are of catalogue size and go to every task only after they were counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.graph import CANVAS_CLASSES, CORE_STAMP
from graphloom.functions.text import normal_repo
from graphloom.operators.skew import small_join


def repo_packs(packs: DataFrame) -> DataFrame:
    """(repo, pack_id): the pack of each repository; a registered one (with cnr_id) first, then the
    least pack_id."""
    repo = normal_repo(F.coalesce(F.nullif(F.col("repo"), F.lit("")), F.col("repo_url")))
    rank = F.struct((F.coalesce("cnr_id", F.lit("")) == "").cast("int"), F.col("pack_id"))
    return (
        packs.select(repo.alias("repo"), "pack_id", rank.alias("rank")).filter((F.col("repo") != "") & (F.col("pack_id") != ""))
        .groupBy("repo").agg(F.min_by("pack_id", "rank").alias("pack_id"))
    )


def class_packs(pack_nodes: DataFrame, repos: DataFrame) -> DataFrame:
    """(class_type, named_packs): all packs that name a class, canonical, sorted, distinct."""
    ident = F.coalesce(F.nullif(F.col("pack_id"), F.lit("")), F.col("repo"))
    listed = pack_nodes.filter(F.col("class_type").isNotNull()).select("class_type", ident.alias("ident")).filter(F.col("ident") != "").distinct()
    canonical = listed.withColumn("repo", normal_repo("ident")).join(repos.withColumnRenamed("pack_id", "of_repo"), "repo", "left")
    return canonical.groupBy("class_type").agg(
        F.array_sort(F.collect_set(F.coalesce("of_repo", "ident"))).alias("named_packs")
    )


def core_flags(core_classes: DataFrame) -> DataFrame:
    """(class_type, is_core, hidden_prompt) of the core classes and those of the canvas."""
    canvas = core_classes.sparkSession.createDataFrame([(c, False) for c in CANVAS_CLASSES], "class_type string, hidden_prompt boolean")
    both = core_classes.select("class_type", F.coalesce("hidden_prompt", F.lit(False)).alias("hidden_prompt")).unionByName(canvas)
    return both.filter(F.col("class_type").isNotNull()).groupBy("class_type").agg(F.lit(True).alias("is_core"), F.max("hidden_prompt").alias("hidden_prompt"))


def attribute(nodes: DataFrame, core: DataFrame, named: DataFrame, repos: DataFrame, spread_by: list[str]) -> DataFrame:
    """``nodes`` (class_type, cnr_id and any other columns) with is_core, hidden_prompt, packs,
    pack_ambiguous and pack_unknown.

    A stamp other than the core one is the pack. Without one a core class has no pack; any other
    has the packs that name it: several are ambiguous, none is unknown. A null or blank stamp is
    no stamp; a null class is an unknown one. Input columns of the result's names are replaced.
    """
    made = ["is_core", "hidden_prompt", "packs", "pack_ambiguous", "pack_unknown"]
    bare = nodes.drop(*made).withColumn("_repo", normal_repo("cnr_id"))
    joined = small_join(bare, core, ["class_type"], spread_by)
    joined = small_join(joined, named, ["class_type"], spread_by)
    joined = small_join(joined, repos.select(F.col("repo").alias("_repo"), F.col("pack_id").alias("_stamped")), ["_repo"], spread_by)
    return joined.withColumns(attribution_columns(F.col("cnr_id"), F.coalesce("_stamped", "cnr_id"))).drop("named_packs", "_repo", "_stamped")


def attribution_columns(stamp: Column, stamped_pack: Column) -> dict[str, Column]:
    is_core = F.coalesce("is_core", F.lit(False))
    stamped = F.coalesce(stamp, F.lit("")).isin("", CORE_STAMP) == F.lit(False)
    none = F.array().cast("array<string>")
    named = F.coalesce("named_packs", none)
    return {
        "is_core": is_core,
        "hidden_prompt": F.coalesce("hidden_prompt", F.lit(False)),
        "packs": F.when(stamped, F.array(stamped_pack)).when(is_core, none).otherwise(named),
        "pack_ambiguous": ~stamped & ~is_core & (F.size(named) > 1),
        "pack_unknown": ~stamped & ~is_core & (F.size(named) == 0),
    }


def workflow_packs(nodes: DataFrame) -> DataFrame:
    """Per workflow: pack_set (sorted, distinct) with its size, and the counts of stamps, silent and
    hidden-prompt nodes. Repeated node rows count as often as they come."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return nodes.groupBy("workflow_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("packs")))).alias("pack_set"),
        F.size(F.array_distinct(F.flatten(F.collect_set("packs")))).alias("pack_set_size"),
        F.count_if(filled("cnr_id") | filled("aux_id")).alias("stamped_nodes"),
        F.count_if(filled("cnr_id")).alias("cnr_nodes"),
        F.count_if(filled("aux_id")).alias("aux_nodes"),
        F.count_if(F.col("mode").isin(2, 4)).alias("muted_or_bypassed"),
        F.count_if("hidden_prompt").alias("hidden_prompt_nodes"),
    )
