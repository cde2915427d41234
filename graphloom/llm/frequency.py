"""P7. Frequency of every term, kept up to date by signed changes.

A change set holds what was added and what was deleted, one row an occurrence; a changed record
is in both. It is aggregated once, together with what the store holds of the same records, into
the change of occurrences by (term, record), and that into the change of occurrences and records
by term. Both are stored in folders of the change set's own; nothing older is written again, and
the counts of a term are the sum over the folders. Folding puts old folders together into one.
Counting from nothing is the change from an empty store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources.shared import complete_folders, measured, remove

KEY = ["field", "term", "record"]
RECORDS = "field string, term string, record string, n bigint, presence int"
TERMS = "field string, term string, occurrences bigint, records bigint"
#: Records of a change set up to which their keys go to every task that reads the store.
BROADCAST_RECORDS = 500_000


def changes(added: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """(field, term, record, n): +1 for each occurrence added, -1 for each deleted. A changed record is
    given in both: as it was in ``deleted``, as it is in ``added``."""
    parts = [df.select(*KEY, F.lit(sign).cast("long").alias("n")) for df, sign in ((added, 1), (deleted, -1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class TermStore:
    """Counts kept at a path, one writer at a time. ``records-<epoch>`` holds the change of each (field,
    term, record), ``terms-<epoch>`` that of each term; an epoch counts once its terms are complete.
    ``base-<epoch>`` in front of either stands for all epochs up to that one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _epochs(self, before: int | None = None) -> list[str]:
        """Suffixes of the folders that make up the store, a base first."""
        names = [n.removeprefix("terms-") for n in complete_folders(self.spark, self.path) if n.startswith("terms-")]
        bases = [n for n in names if n.startswith("base-")]
        since = int(bases[-1].removeprefix("base-")) if bases else -1
        own = [n for n in names if not n.startswith("base-") and int(n) > since and (before is None or int(n) < before)]
        return bases[-1:] + own

    def _read(self, what: str, schema: str, epochs: list[str]) -> DataFrame:
        if not epochs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{what}-{e}" for e in epochs])

    def apply(self, epoch: int, delta: DataFrame) -> None:
        """Merge one change set; epochs rise. Of the store only rows of records in the change set are
        sent on. A run that died is run again with the same epoch and writes the same folders. More
        occurrences deleted than there were leave none; an empty change set changes nothing."""
        older = self._epochs(before=epoch)
        new = delta.select(*KEY, "n", F.lit(0).cast("long").alias("old"))
        if older:
            keys, n = measured(delta.select("field", "record").distinct(), "touched")
            held = self._read("records", RECORDS, older).join(F.broadcast(keys) if n <= BROADCAST_RECORDS else keys, ["field", "record"], "left_semi")
            new = new.unionByName(held.select(*KEY, F.lit(0).cast("long").alias("n"), F.col("n").alias("old")))
        merged = new.groupBy(*KEY).agg(F.sum("n").alias("n"), F.sum("old").alias("old")).withColumn("n", F.greatest(F.col("n"), -F.col("old")))
        presence = (F.col("old") + F.col("n") > 0).cast("int") - (F.col("old") > 0).cast("int")
        label = f"{epoch:012d}"
        merged.filter("n <> 0").select(*KEY, "n", presence.alias("presence")).write.mode("overwrite").parquet(f"{self.path}/records-{label}")
        self._sum_terms([label]).write.mode("overwrite").parquet(f"{self.path}/terms-{label}")

    def _sum_terms(self, epochs: list[str]) -> DataFrame:
        rows = self._read("records", RECORDS, epochs)
        return rows.groupBy("field", "term").agg(F.sum("n").alias("occurrences"), F.sum("presence").cast("long").alias("records"))

    def fold(self) -> None:
        """Put all epochs there are into one base; what it replaces goes only once it is complete."""
        epochs = self._epochs()
        if len(epochs) < 2:
            return
        label = f"base-{int(epochs[-1].removeprefix('base-')):012d}"
        rows = self._read("records", RECORDS, epochs).groupBy(*KEY).agg(F.sum("n").alias("n"), F.sum("presence").cast("int").alias("presence"))
        rows.filter("n > 0").write.mode("overwrite").parquet(f"{self.path}/records-{label}")
        self._sum_terms([label]).write.mode("overwrite").parquet(f"{self.path}/terms-{label}")
        for old in epochs:
            for what in ("terms", "records"):
                remove(self.spark, f"{self.path}/{what}-{old}")

    def counts(self) -> DataFrame:
        """(field, term, occurrences, records) of every term there is."""
        rows = self._read("terms", TERMS, self._epochs())
        summed = rows.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
        return summed.filter("occurrences > 0")

    def records(self) -> DataFrame:
        """(field, term, record, n): occurrences by record."""
        rows = self._read("records", RECORDS, self._epochs())
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n")).filter("n > 0")


def marked(counts: DataFrame, totals: dict[str, tuple[int, float]], rare_under: int = 3) -> DataFrame:
    """Counts with ``mark``: ``rare`` in fewer than ``rare_under`` records, ``common`` in more than
    the given share of the field's records, else ''. ``totals``: by field the number of records
    and that share."""
    common = F.lit(False)
    for field, (records, share) in totals.items():
        common = common | ((F.col("field") == field) & (F.col("records") > records * share))
    return counts.withColumn("mark", F.when(common, "common").when(F.col("records") < rare_under, "rare").otherwise(""))
