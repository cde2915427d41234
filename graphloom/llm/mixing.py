"""P9. Mixing sources to target weights."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip
from graphloom.operators.skew import replicated

#: A public tokenizer's file; a parameter, never part of this package. The driver reads it and gives it
#: to the tasks, so executors need not have it.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Sources up to which the rates go to every task.
BROADCAST_SOURCES = 100_000


def source_name(column: str) -> Column:
    return F.replace(F.lower(strip(column)), F.lit("-"), F.lit("_"))


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of every document, whole text; 0 tokens for null or empty text,
    source normalised, null kept."""
    definition = documents.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))  # some megabytes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(definition.value)
        model.encode_special_tokens = True
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            sizes = []
            for at in range(0, len(texts), 256):
                sizes += [len(e) for e in model.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["doc_id", "source", "tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), source_name("source").alias("source"), "text").mapInArrow(
        count, "doc_id bigint, source string, tokens bigint"
    )


def rates(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, have_tokens, rate): times that each document of a source
    comes on average, so that the source has its share of the tokens of all documents, at most
    max_repeats; a null max_repeats allows one copy, a null share is 0. A source without tokens has
    rate 0. Of a source with several targets the shares add up and the smallest max_repeats holds.
    What a source at its max_repeats lacks is not given to others: they would exceed their shares."""
    have = counts.groupBy("source").agg(F.sum("tokens").alias("have_tokens"))
    total = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).head()["n"]
    wanted = (
        targets.select(source_name("source").alias("source"), "target_share", "max_repeats").filter(F.col("source").isNotNull())
        .groupBy("source").agg(F.coalesce(F.sum("target_share"), F.lit(0.0)).alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    )
    have_tokens = F.coalesce("have_tokens", F.lit(0).cast("long"))
    rate = F.when(have_tokens > 0, F.least(F.col("target_share") * total / have_tokens, F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
    return wanted.join(have, "source", "left").select("source", "target_share", "max_repeats", have_tokens.alias("have_tokens"), rate.alias("rate"))


def copies(rate: Column, seed: int) -> Column:
    """floor(rate), and one more with the fraction as its probability, drawn from a hash of the
    document and the seed: the same in every run and on every executor."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 40)).cast("double") / float(1 << 40)
    whole = F.floor(rate)
    return (whole + (drawn < rate - whole).cast("long")).cast("int")


def select(counts: DataFrame, rate_table: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, source, tokens, copy): each document as often as it was drawn, copies numbered
    from 1. Documents of sources without a target are left out."""
    columns = rate_table.select("source", "rate")
    joined = (
        counts.join(F.broadcast(columns), "source")
        if rate_table.count() <= BROADCAST_SOURCES
        else replicated(counts, columns, ["source"], ["doc_id"])
    )
    drawn = joined.withColumn("copies", copies(F.col("rate"), seed)).filter("copies > 0")
    return drawn.select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))


def shares(selection: DataFrame, rate_table: DataFrame) -> DataFrame:
    """Per source what was wanted and what was reached: tokens and share of the selection."""
    got = selection.groupBy("source").agg(F.sum("tokens").alias("selected_tokens"), F.count(F.lit(1)).alias("selected_documents"))
    total = got.agg(F.coalesce(F.sum("selected_tokens"), F.lit(0)).alias("n")).head()["n"]
    tokens = F.coalesce("selected_tokens", F.lit(0).cast("long"))
    return rate_table.join(got, "source", "left").select(
        "source", "target_share", "max_repeats", "have_tokens", "rate", tokens.alias("selected_tokens"),
        F.coalesce("selected_documents", F.lit(0).cast("long")).alias("selected_documents"),
        (tokens / F.lit(max(total, 1))).alias("actual_share"),
    )
