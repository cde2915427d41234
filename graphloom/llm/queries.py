"""Queries of the training-data problems, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.jsontext import clean, decode_object, encode
from graphloom.functions.text import normal_hash
from graphloom.llm import frequency, history, items, leak, mixing, nearsets, private, together
from graphloom.operators.shred import graphs
from graphloom.operators.skew import lookup
from graphloom.plans.tables import table
from graphloom.sources.shared import materialize, scratch_path

#: Least coverage of a near-duplicate.
NEAR = 0.8


def _workflow_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "derived_workflows").select(F.count_distinct("workflow_id").alias("n")).head()["n"]


# --- p1 ---------------------------------------------------------------------------------


def batch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch_no, record, kind, value): the identities of each row of derived_workflows, once each: its
    id, its canonical hash and the payloads of its captures, normalised. record: the workflow_id."""
    rows = table(spark, sf_dir, "derived_workflows").select(F.col("batch_no").cast("int").alias("batch_no"), F.col("workflow_id").alias("record"), "canonical_hash")
    rows = rows.filter(F.col("batch_no").isNotNull() & (F.col("record") != ""))
    own = rows.select(
        "batch_no", "record",
        F.explode(
            F.array(
                F.struct(F.lit("workflow").alias("kind"), F.col("record").alias("value")),
                F.struct(F.lit("canonical").alias("kind"), normal_hash("canonical_hash").alias("value")),
            )
        ).alias("x"),
    ).select("batch_no", "record", "x.kind", "x.value").filter(F.col("value").isNotNull())
    payloads = (
        table(spark, sf_dir, "raw_artifacts").select(F.col("workflow_id").alias("record"), normal_hash("payload_sha256").alias("value"))
        .filter((F.col("record") != "") & F.col("value").isNotNull()).distinct()
    )
    placed = _with_batches(payloads, rows)
    return own.distinct().unionByName(placed.select("batch_no", "record", F.lit("payload").alias("kind"), "value"))


def _with_batches(values: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct (record, value) once for each batch that the record is in. A record is joined once,
    with the list of its batches; only records with very many values are salted."""
    values = materialize(values, "values")
    batches = rows.groupBy("record").agg(F.collect_set("batch_no").alias("batches"))
    weighted = materialize(values.groupBy("record").agg(F.count(F.lit(1)).alias("n")).join(batches, "record"), "weighted")
    return lookup(values, weighted, ["record"], "n", ["value"]).select(F.explode("batches").alias("batch_no"), "record", "value")


def _held_by_batch(spark: SparkSession, records: DataFrame, label: str, threshold: float, exact: bool) -> tuple[DataFrame, DataFrame]:
    """(values, matches) of all batches, each checked against the stored table of those before it."""
    values = materialize(history.distinct_values(records), "values")
    chunks = materialize(history.chunked(values), "chunks", "batch_no")
    store = history.ChunkHistory(spark, scratch_path(spark, label))
    matches = spark.createDataFrame([], history.MATCHES + ", batch_no int")
    for (number,) in sorted(chunks.select("batch_no").distinct().collect()):
        held = store.take(number, chunks.filter(F.col("batch_no") == number), threshold, exact)
        matches = matches.unionByName(held.withColumn("batch_no", F.lit(number)))
    return values, matches


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of derived_workflows that repeat something that an earlier batch already held: batch by
    batch through the stored chunk table, decided by full coverage by one held value, which is
    then checked to be equal."""
    records = materialize(batch_records(spark, sf_dir), "records")
    values, matches = _held_by_batch(spark, records, "history", 1.0, exact=True)
    key = ["batch_no", *history.KEY]
    held = materialize(matches.select(*key).distinct().join(values.select(*key, "n"), key), "held")
    found = lookup(records.withColumn("value_id", history.value_id()), held, key, "n", ["record"], "left_semi")
    return found.select("batch_no", F.col("record").alias("workflow_id")).distinct()


def _graph_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for record, meta in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held = decode_object(meta)
            for _, _, graph in graphs(held) if held is not None else ():
                out.append((record, clean(encode(graph, separators=(",", ":"), ensure_ascii=False))))
        columns = zip(*out, strict=True) if out else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["record", "value"])


def p1_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates: of each workflow of a batch the graph that is covered best, by at least 0.8 of
    its bytes, by one graph held from an earlier batch; the workflow that brought that one, its
    batch and the coverage. One row a workflow and batch; equal graphs count too."""
    rows = table(spark, sf_dir, "derived_workflows").select(F.col("batch_no").cast("int").alias("batch_no"), F.col("workflow_id").alias("record"))
    rows = rows.filter(F.col("batch_no").isNotNull() & (F.col("record") != ""))
    metas = table(spark, sf_dir, "raw_artifacts").filter("workflow_id <> '' AND source_meta IS NOT NULL").select("workflow_id", "source_meta")
    texts = metas.mapInArrow(_graph_values, "record string, value string").distinct()
    records = materialize(_with_batches(texts, rows).withColumns({"kind": F.lit("graph"), "value_id": history.value_id()}), "records")
    values, matches = _held_by_batch(spark, records, "graphs", NEAR, exact=False)
    key = ["batch_no", *history.KEY]
    coverage = F.round(F.col("shared_bytes") / F.col("value_bytes"), 4)
    best = matches.groupBy(*key).agg(F.max(F.struct(coverage.alias("coverage"), "held_record", "held_batch")).alias("best"))
    held = materialize(best.join(values.select(*key, "n"), key), "held")
    found = lookup(records.select(*key, "record"), held, key, "n", ["record"])
    return found.groupBy("batch_no", F.col("record").alias("workflow_id")).agg(F.max("best").alias("best")).select(
        "batch_no", "workflow_id", F.col("best.held_record").alias("held_workflow_id"), "best.held_batch", "best.coverage"
    )


P1_SQL = r"""
WITH w AS (
  SELECT DISTINCT batch_no, workflow_id,
    nullif(regexp_replace(lower(regexp_replace(canonical_hash, '\s', '', 'g')), '^sha256:', ''), '') AS c
  FROM derived_workflows WHERE workflow_id <> ''
), p AS (
  SELECT DISTINCT workflow_id, nullif(regexp_replace(lower(regexp_replace(payload_sha256, '\s', '', 'g')), '^sha256:', ''), '') AS s
  FROM raw_artifacts
), keys AS (
  SELECT batch_no, workflow_id, 'w' AS kind, workflow_id AS value FROM w
  UNION SELECT batch_no, workflow_id, 'c', c FROM w WHERE c IS NOT NULL
  UNION SELECT w.batch_no, w.workflow_id, 'p', s FROM w JOIN p USING (workflow_id) WHERE s IS NOT NULL
), first AS (SELECT kind, value, min(batch_no) AS since FROM keys GROUP BY 1, 2)
SELECT DISTINCT CAST(batch_no AS INT) AS batch_no, workflow_id FROM keys JOIN first USING (kind, value) WHERE since < batch_no
"""

# --- p5 ---------------------------------------------------------------------------------


def _near_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(classes, members, pairs of classes, names): keys are compact; names has the hash of each."""
    flows = table(spark, sf_dir, "derived_workflows").filter(F.col("structural_hash").isNotNull())
    flows = flows.withColumn("key", nearsets.compact("structural_hash"))
    packs = materialize(items.pack_rows(flows, table(spark, sf_dir, "packs"), "key"), "packs")
    named = materialize(flows.groupBy("key").agg(F.max("node_count").alias("node_count"), F.any_value("structural_hash").alias("structural_hash")), "names")
    each, members = nearsets.classes(packs, named, "key", "node_count")
    each = materialize(each, "classes")
    return each, members, materialize(nearsets.class_pairs(each), "pairs"), named.select("key", "structural_hash")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of structural hashes with nearly the same packs and node count: all pairs, as its columns
    ask. :func:`p5_groups` says the same with one row a hash."""
    _, members, pairs, names = _near_sets(spark, sf_dir)
    called = materialize(members.join(names, "key").select("structural_hash", "class_id"), "members")
    return nearsets.key_pairs(pairs, called, "structural_hash")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a structural hash with at least 6 packs: its class of equal sets and the group of linked
    classes, each called by its least hash, the number of hashes in its class and of other
    classes linked to that."""
    each, members, pairs, names = _near_sets(spark, sf_dir)
    groups = nearsets.components(each, pairs)
    ends = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    called = materialize(members.join(names, "key").select("structural_hash", "class_id"), "members")
    least = called.groupBy("class_id").agg(F.min("structural_hash").alias("class_name"), F.count(F.lit(1)).alias("n_equal"))
    own = materialize(groups.join(least, "class_id").join(ends, "class_id", "left"), "own")
    group_names = own.groupBy("group_id").agg(F.min("class_name").alias("group_name"))
    facts = materialize(own.join(group_names, "group_id"), "facts")
    return lookup(called, facts, ["class_id"], "n_equal", ["structural_hash"]).join(least.select("class_id", "n_equal"), "class_id").select(
        "structural_hash", F.col("class_name").alias("class_id"), "n_equal", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("group_name").alias("group_id")
    )


PACKS_SQL = r"""
repos AS (
  SELECT lower(trim(repo)) AS repo, min(lower(trim(pack_id))) AS pack_id FROM packs WHERE trim(repo) <> '' GROUP BY 1
), flat AS (
  SELECT structural_hash, workflow_id, node_count, lower(regexp_replace(x, '^\s+|\s+$', '', 'g')) AS x
  FROM (SELECT structural_hash, workflow_id, node_count, unnest(pack_set) AS x FROM derived_workflows)
), named AS (
  SELECT structural_hash, workflow_id, node_count, coalesce(r.pack_id, f.x) AS item FROM flat f LEFT JOIN repos r ON r.repo = f.x WHERE f.x <> ''
)"""

P5_SQL = f"""
WITH {PACKS_SQL}, sets AS (
  SELECT structural_hash AS h, max(node_count) AS n, list(DISTINCT item) AS s FROM named GROUP BY 1 HAVING count(DISTINCT item) >= 6
), inter AS (
  SELECT a.h AS ha, b.h AS hb, a.n AS na, b.n AS nb, len(a.s) AS la, len(b.s) AS lb, len(list_intersect(a.s, b.s)) AS c
  FROM sets a JOIN sets b ON a.h < b.h AND abs(a.n - b.n) * 10 <= greatest(a.n, b.n)
)
SELECT ha AS structural_hash_a, hb AS structural_hash_b FROM inter WHERE c * 10 >= 7 * (la + lb - c)
"""
P5_GROUPS_SQL = f"""
WITH RECURSIVE {PACKS_SQL.strip()}, sets AS (
  SELECT structural_hash AS h, max(node_count) AS n, list_sort(list(DISTINCT item)) AS s FROM named GROUP BY 1
  HAVING count(DISTINCT item) >= 6 AND max(node_count) IS NOT NULL
), classes AS (SELECT min(h) AS c, n, s, count(*) AS k FROM sets GROUP BY n, s
), links AS (
  SELECT a.c AS x, b.c AS y FROM classes a JOIN classes b ON a.c <> b.c AND abs(a.n - b.n) * 10 <= greatest(a.n, b.n)
  WHERE len(list_intersect(a.s, b.s)) * 17 >= 7 * (len(a.s) + len(b.s))
), reach AS (SELECT c AS start, c AS seen FROM classes UNION SELECT start, y FROM reach JOIN links ON x = seen)
SELECT sets.h AS structural_hash, classes.c AS class_id, classes.k AS n_equal,
  (SELECT count(*) FROM links WHERE x = classes.c) AS n_links, (SELECT min(seen) FROM reach WHERE start = classes.c) AS group_id
FROM sets JOIN classes ON sets.n = classes.n AND sets.s = classes.s
"""

# --- p6 ---------------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = {"workflow_id": nearsets.compact("workflow_id")}  # 16 bytes travel instead of 64
    packs = items.pack_rows(table(spark, sf_dir, "derived_workflows").withColumns(short), table(spark, sf_dir, "packs"), "workflow_id")
    classes = items.class_rows(table(spark, sf_dir, "derived_workflow_nodes").withColumns(short))
    rows = packs.select(F.lit("pack").alias("item_kind"), F.col("workflow_id").alias("record"), "item").unionByName(
        classes.select(F.lit("class").alias("item_kind"), F.col("workflow_id").alias("record"), "item")
    )
    return together.pairs(materialize(rows, "baskets"), _workflow_count(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of packs or classes that occur together at least three times as often as by chance."""
    pairs = _pairs(spark, sf_dir).filter("lift >= 3 - 1e-9")  # as the problem defines it; see p6_pairs for significance
    return pairs.select("item_kind", "item_a", "item_b")


def p6_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs with enough support: counts, lift over chance, log-likelihood ratio, and whether they
    come together more often than chance would bring them in one of a thousand cases."""
    return _pairs(spark, sf_dir).withColumns({"lift": F.round("lift", 6), "llr": F.round("llr", 4)})


P6_BASE = f"""
WITH {PACKS_SQL}, n AS (SELECT count(DISTINCT workflow_id) AS n FROM derived_workflows), rows AS (
  SELECT DISTINCT 'pack' AS item_kind, workflow_id AS record, item FROM named WHERE workflow_id IS NOT NULL
  UNION ALL
  SELECT DISTINCT 'class', workflow_id, regexp_replace(class_type, '^\\s+|\\s+$', '', 'g') FROM derived_workflow_nodes
  WHERE trim(class_type) <> '' AND workflow_id IS NOT NULL
), one AS (SELECT item_kind, item, count(*) AS c FROM rows GROUP BY 1, 2
), two AS (
  SELECT a.item_kind, a.item AS item_a, b.item AS item_b, count(*) AS n_ab
  FROM rows a JOIN rows b ON a.item_kind = b.item_kind AND a.record = b.record AND a.item < b.item GROUP BY 1, 2, 3
), full_pairs AS (
  SELECT two.*, x.c AS n_a, y.c AS n_b, n.n AS n FROM two CROSS JOIN n
  JOIN one x ON x.item_kind = two.item_kind AND x.item = item_a JOIN one y ON y.item_kind = two.item_kind AND y.item = item_b
  WHERE n_ab >= 12 AND n_ab * 2000 >= n.n
)"""
P6_SQL = P6_BASE + " SELECT item_kind, item_a, item_b FROM full_pairs WHERE n_ab * n >= 3 * n_a * n_b"
P6_PAIRS_SQL = (
    P6_BASE
    + """
, cells AS (SELECT *, n_ab::DOUBLE AS a, (n_a - n_ab)::DOUBLE AS b, (n_b - n_ab)::DOUBLE AS c, (n - n_a - n_b + n_ab)::DOUBLE AS d FROM full_pairs)
SELECT item_kind, item_a, item_b, n_ab, n_a, n_b, round(n_ab::DOUBLE * n / (n_a * n_b), 6) AS lift,
  round(2 * (a * ln(a * n / (n_a * n_b)) + CASE WHEN b > 0 THEN b * ln(b * n / (n_a * (n - n_b)::DOUBLE)) ELSE 0 END
    + CASE WHEN c > 0 THEN c * ln(c * n / ((n - n_a)::DOUBLE * n_b)) ELSE 0 END
    + CASE WHEN d > 0 THEN d * ln(d * n / ((n - n_a)::DOUBLE * (n - n_b))) ELSE 0 END), 4) AS llr,
  llr >= 10.828 AND n_ab::DOUBLE * n > n_a * n_b AS significant
FROM cells"""
)

# --- p7 ---------------------------------------------------------------------------------


def _term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all terms, built up as they came: the classes, whose table has no times, then the tags of
    each month of manifests as a change set of its own."""
    raw = table(spark, sf_dir, "raw_artifacts")
    month = F.regexp_extract(F.coalesce("manifest_key", F.lit("")), r"/(\d{4}-\d{2})/", 1)
    tags = materialize(items.tag_terms(raw, month.alias("month")), "tags", "month")
    store = frequency.TermStore(spark, scratch_path(spark, "terms"))
    store.apply(0, frequency.changes(added=items.class_terms(table(spark, sf_dir, "derived_workflow_nodes"))))
    months = sorted(r["month"] or "" for r in tags.select("month").distinct().collect())  # one a month of history
    for epoch, name in enumerate(months, 1):
        store.apply(epoch, frequency.changes(added=tags.filter(F.coalesce("month", F.lit("")) == name)))
    counts = store.counts()
    captures = raw.select(F.count_distinct("capture_id").alias("n")).head()["n"]
    return frequency.marked(counts, {"class_type": (_workflow_count(spark, sf_dir), 1 / 4), "tags": (captures, 1 / 20)})


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms too rare or too common."""
    return _term_counts(spark, sf_dir).filter("mark <> ''").select("field", "term", "mark")


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences and records of every term, with its mark."""
    return _term_counts(spark, sf_dir)


P7_BASE = r"""
WITH terms AS (
  SELECT 'class_type' AS field, regexp_replace(class_type, '^\s+|\s+$', '', 'g') AS term, workflow_id AS record
  FROM derived_workflow_nodes WHERE class_type IS NOT NULL AND workflow_id IS NOT NULL
  UNION ALL
  SELECT 'tags', t, capture_id FROM (
    SELECT capture_id, trim(lower(regexp_replace(unnest(tags), '\s+', ' ', 'g'))) AS t FROM raw_artifacts WHERE capture_id IS NOT NULL)
  WHERE t <> ''
), counts AS (
  SELECT field, term, count(*) AS occurrences, count(DISTINCT record) AS records FROM terms GROUP BY 1, 2
), marked AS (
  SELECT field, term, occurrences, records,
    CASE WHEN field = 'class_type' AND records * 4 > (SELECT count(DISTINCT workflow_id) FROM derived_workflows) THEN 'common'
         WHEN field = 'tags' AND records * 20 > (SELECT count(DISTINCT capture_id) FROM raw_artifacts) THEN 'common'
         WHEN records < 3 THEN 'rare' ELSE '' END AS mark
  FROM counts
)"""
P7_SQL = P7_BASE + " SELECT field, term, mark FROM marked WHERE mark <> ''"
P7_COUNTS_SQL = P7_BASE + " SELECT field, term, occurrences, records, mark FROM marked"

# --- p8, p9, p10 ------------------------------------------------------------------------


def _overlaps(spark: SparkSession, sf_dir: str, masks: tuple[str, ...] = leak.MASKS) -> DataFrame:
    return leak.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), masks=masks)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with 13 neighbouring words of a test item, and the item."""
    return _overlaps(spark, sf_dir).filter("exact_words >= 13").select("doc_id", "item_id").distinct()


def p8_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and items that share at least 13 words with at most a fifth of them replaced, and items
    of 5 to 12 words that stand whole in a document."""
    return _overlaps(spark, sf_dir, leak.FULL_MASKS)


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = materialize(mixing.token_counts(table(spark, sf_dir, "documents")), "tokens")
    return counts, materialize(mixing.rates(counts, table(spark, sf_dir, "mix_targets")), "rates")


def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed collection: a row for each copy of each document."""
    return mixing.select(*_mix(spark, sf_dir))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    counts, rates = _mix(spark, sf_dir)
    return mixing.shares(mixing.select(counts, rates), rates)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information as it stands in the texts."""
    found = private.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "person_names"))
    return found.select("doc_id", "kind", "found_text").distinct()


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with placeholders in place of the findings."""
    documents = table(spark, sf_dir, "documents")
    return private.redact(documents, private.findings(documents, table(spark, sf_dir, "person_names")))


QUERIES = {
    "p1_found": p1_found, "p1_near": p1_near, "p5_found": p5_found, "p5_groups": p5_groups,
    "p6_found": p6_found, "p6_pairs": p6_pairs, "p7_found": p7_found, "p7_counts": p7_counts,
    "p8_found": p8_found, "p8_overlaps": p8_overlaps, "p9_selection": p9_selection, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_redacted": p10_redacted,
}
SQL = {
    "p1_found": P1_SQL, "p5_found": P5_SQL, "p5_groups": P5_GROUPS_SQL, "p6_found": P6_SQL, "p6_pairs": P6_PAIRS_SQL, "p7_found": P7_SQL, "p7_counts": P7_COUNTS_SQL,
}
