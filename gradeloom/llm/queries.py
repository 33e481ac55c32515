"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.tables import table
from ..storage import materialize, shared_dir
from . import leakage, overlap, packing, pii, sampling, sentences, splits


# ---- 1: splits that keep related records together -----------------------------------
def p1_found(spark, d):
    records = table(spark, d, "records")
    st = splits.fold(records, "record_key")
    return splits.components_of(records, "record_key", st).select("record_key", F.col("component").alias("group_key"))


def p1_assignment(spark, d):
    """Every record with its component and its split."""
    records = table(spark, d, "records")
    st = splits.fold(records, "record_key")
    return splits.assign(records, "record_key", table(spark, d, "split_targets"), st).select("record_key", "component", "split")


def p1_shares(spark, d):
    """Rows and share of each split against its target."""
    got = p1_assignment(spark, d).groupBy("split").agg(F.count("*").alias("n"))
    t = table(spark, d, "split_targets")
    n = F.coalesce("n", F.lit(0))
    whole = F.sum(n).over(Window.partitionBy())  # a few rows, one for each split
    return t.join(got, "split", "left").select("split", "target_share", n.alias("n_rows"), (n / whole).alias("share"))


def _two_deliveries(spark, d):
    """All records after two deliveries cut at the median arrival, with what the first one gave to its own."""
    records, targets = table(spark, d, "records"), table(spark, d, "split_targets")
    at = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    middle = records.agg(F.percentile_approx(at, 0.5)).first()[0] or 0
    early = F.coalesce(at <= middle, F.lit(False))
    st = splits.fold(records.where(early), "record_key")
    done = materialize(splits.assign(records.where(early), "record_key", targets, st), "first-delivery")
    state = splits.save_state(st, f"{shared_dir(spark)}/gradeloom/state-{uuid.uuid4().hex}")
    st2 = splits.fold(records.where(~early), "record_key", state)
    out = splits.assign(records, "record_key", targets, st2)
    return out.join(done.select("record_key", F.col("split").alias("first_split")), "record_key", "left")


def p1_two_deliveries(spark, d):
    """The table built in two deliveries: all records by split and status."""
    return _two_deliveries(spark, d).groupBy("split", "status").agg(F.count_distinct("component").alias("components"), F.count("*").alias("n_rows"))


def _held(out, extra):
    """Counts of what must hold of an assignment, one row each."""
    parts = out.groupBy("component").agg(F.count_distinct("split").alias("s"), F.count("*").alias("n"))
    whole = parts.agg(F.sum("n").alias("rows"), F.sum((F.col("s") > 1).cast("int")).alias("torn"))
    sums = out.agg(F.sum((F.col("split").isNull() & (F.col("status") != "quarantined")).cast("int")).alias("lost"), *extra)
    names = ["rows", "torn", "lost", *(f"extra{i}" for i in range(len(extra)))]
    labels = ["records", "components in two splits", "records without a split", "unquarantined records that moved"][: len(names)]
    pairs = F.array(*[F.struct(F.lit(x).alias("fact"), F.coalesce(F.col(n).cast("bigint"), F.lit(0)).alias("n")) for x, n in zip(labels, names)])
    return whole.crossJoin(sums).select(F.explode(pairs).alias("p")).select("p.fact", "p.n")  # one row by one row


def p1_invariants(spark, d):
    """Facts of the assignment that must hold whatever components went where."""
    return _held(p1_assignment(spark, d).withColumn("status", F.lit("assigned")), [])


def p1_delivery_invariants(spark, d):
    """The same after two deliveries, and that no record outside quarantine changed its split."""
    out = materialize(_two_deliveries(spark, d), "two-deliveries")
    moved = F.col("first_split").isNotNull() & (F.col("status") != "quarantined") & ~F.col("split").eqNullSafe(F.col("first_split"))
    return _held(out, [F.sum(moved.cast("int")).alias("extra0")])


# ---- 2: the same text across splits -------------------------------------------------
def p2_found(spark, d):
    return overlap.near_pairs(table(spark, d, "records"))


def p2_report(spark, d):
    """Pairs and evaluation rows by split, exam family and field."""
    records = table(spark, d, "records")
    ev = records.where(F.col("metadata.split").isin(*overlap.EVAL)).select(F.col("record_key").alias("k"), F.col("metadata.split").alias("split"), F.col("metadata.exam_family").alias("exam_family"))
    pairs = overlap.near_pairs(records)
    ends = pairs.select("field", F.explode(F.array("record_key_a", "record_key_b")).alias("k"))
    # one end of each pair is an evaluation row
    return ends.join(ev, "k").groupBy("split", "exam_family", "field").agg(F.count("*").alias("n_pairs"), F.count_distinct("k").alias("n_records"))


# ---- 3: samples with target shares --------------------------------------------------
def _plans(spark, d):
    plans = sampling.Plans(table(spark, d, "sample_targets"))
    return plans, sampling.reservoirs(table(spark, d, "records"), plans)


def p3_found(spark, d):
    plans, res = _plans(spark, d)
    return sampling.category_report(res, plans).where("short").select("plan_id", "category")


def p3_report(spark, d):
    plans, res = _plans(spark, d)
    return sampling.category_report(res, plans)


def p3_sample(spark, d):
    plans, res = _plans(spark, d)
    return sampling.draw(res, plans)


def p3_quotas(spark, d):
    """Quota and achieved share of each target row."""
    plans, res = _plans(spark, d)
    return sampling.quotas(res, plans).drop("norm")


def p3_totals(spark, d):
    """Records drawn for each plan, and categories drawn below what their minimum and stock allow or beyond the stock."""
    plans, res = _plans(spark, d)
    q = sampling.quotas(res, plans)
    n = sampling.draw(res, plans).groupBy("plan_id", "field", "category").agg(F.count("*").alias("drawn"), F.count_distinct("record_key").alias("different"))
    both = q.join(n, ["plan_id", "field", "category"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    bad = (F.col("drawn") < F.least(F.coalesce("min_count", F.lit(0)), "available")) | (F.col("drawn") > F.col("available")) | (F.col("drawn") != F.coalesce("different", F.lit(0)))
    return both.groupBy("plan_id").agg(F.sum("drawn").alias("n_drawn"), F.sum(bad.cast("bigint")).alias("n_wrong"))


# ---- 5: personal information --------------------------------------------------------
def p5_found(spark, d):
    return pii.find_pii(table(spark, d, "records"), table(spark, d, "works")).select("record_key", "field", "pii_type", "start_char")


def p5_redacted(spark, d):
    return pii.redact_texts(table(spark, d, "records"), table(spark, d, "works"))


# ---- 6: packing ---------------------------------------------------------------------
def _packed(spark, d):
    return packing.pack(table(spark, d, "documents"), table(spark, d, "pack_plans"))


def p6_found(spark, d):
    return packing.oversized(_packed(spark, d))


def p6_pieces(spark, d):
    return _packed(spark, d)


def p6_fill(spark, d):
    return packing.fill_report(_packed(spark, d))


def p6_invariants(spark, d):
    return packing.invariants(_packed(spark, d))


# ---- 7: evaluation texts in the corpus ----------------------------------------------
def p7_found(spark, d):
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_items(spark, d):
    """Each item with the number of documents that leak it."""
    items = table(spark, d, "eval_items").select("item_id", "split", "kind")
    n = p7_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    return items.join(n, "item_id", "left").na.fill({"n_docs": 0})


# ---- 8: sentences -------------------------------------------------------------------
def p8_found(spark, d):
    return sentences.sentence_units(table(spark, d, "documents")).select("doc_id", "start_char", "end_char")


def p8_lengths(spark, d):
    """Units, documents and mean length of a unit by language as delivered."""
    units = sentences.sentence_units(table(spark, d, "documents"))
    docs = table(spark, d, "documents").select("doc_id", F.lower(F.trim("lang")).alias("lang"))
    size = (F.col("end_char") - F.col("start_char")).cast("bigint")
    return units.join(docs, "doc_id").groupBy("lang").agg(F.count("*").alias("n_units"), F.count_distinct("doc_id").alias("n_docs"), F.sum(size).alias("n_chars"))


QUERIES = {f.__name__: f for f in (p1_found, p1_assignment, p1_shares, p1_two_deliveries, p1_invariants, p1_delivery_invariants, p2_found, p2_report, p3_found, p3_report, p3_sample, p3_quotas, p3_totals, p5_found, p5_redacted, p6_found, p6_pieces, p6_fill, p6_invariants, p7_found, p7_items, p8_found, p8_lengths)}

_NORM3 = "replace(regexp_replace(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '\\s', '_', 'g'), '-', '_')"
_P3 = f"""
WITH r AS (
  SELECT id, arg_max(struct_pack(status := metadata.status, pii := metadata.pii_reviewed, m := modality, g := CAST(grade AS VARCHAR),
     q := metadata.response_quality, h := metadata.hard_case_types, k := record_key), struct_pack(a := ingested_at IS NOT NULL, t := coalesce(ingested_at, TIMESTAMP '1970-01-01'), k := record_key)) AS x
  FROM records GROUP BY id),
e AS (SELECT x.k AS record_key, {_NORM3.format("x.m")} AS m, {_NORM3.format("x.g")} AS g, {_NORM3.format("x.q")} AS q, x.h AS h
  FROM r WHERE {_NORM3.format("x.status")} IN ('ai_verified', 'teacher_verified') AND x.pii),
v AS (
  SELECT record_key, 'modality' AS field, m AS v FROM e UNION ALL SELECT record_key, 'grade', g FROM e
  UNION ALL SELECT record_key, 'response_quality', q FROM e
  UNION ALL SELECT DISTINCT record_key, 'hard_case_types', {_NORM3.format("hh")} FROM (SELECT record_key, unnest(h) AS hh FROM e)
  UNION ALL SELECT record_key, 'modality+response_quality', m || '+' || q FROM e
  UNION ALL SELECT record_key, 'modality+grade', m || '+' || g FROM e),
c AS (SELECT field, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL),
t AS (SELECT *, greatest(coalesce(min_count, 0), CAST(ceil(CAST(target_share AS DECIMAL(18,9)) * sample_size) AS BIGINT)) AS need FROM sample_targets)
"""

SQL = {
    "p1_found": """
WITH RECURSIVE v AS (
  SELECT record_key, f || '=' || val AS kv FROM (
    SELECT record_key, 'task_id' AS f, lower(regexp_replace(task.task_id, '^\\s+|\\s+$', '', 'g')) AS val FROM records
    UNION ALL SELECT record_key, 'subject_group_id', lower(regexp_replace(metadata.subject_group_id, '^\\s+|\\s+$', '', 'g')) FROM records
    UNION ALL SELECT record_key, 'exam_family', lower(regexp_replace(metadata.exam_family, '^\\s+|\\s+$', '', 'g')) FROM records
    UNION ALL SELECT record_key, 'question_family', lower(regexp_replace(metadata.question_family, '^\\s+|\\s+$', '', 'g')) FROM records)
  WHERE val IS NOT NULL AND val NOT IN ('', '-', 'n/a', 'yok')),
star AS (SELECT record_key, min(kv) AS a FROM v GROUP BY record_key),
e AS (SELECT DISTINCT a, kv AS b FROM star JOIN v USING (record_key)),
both_ AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT DISTINCT a AS node, a AS lab FROM both_ UNION SELECT b.b, r.lab FROM reach r JOIN both_ b ON b.a = r.node WHERE r.lab < b.b),
lab AS (SELECT node, min(lab) AS lab FROM reach GROUP BY node)
SELECT s.record_key, lab.lab AS group_key FROM star s JOIN lab ON lab.node = s.a
""",
    "p1_invariants": """SELECT 'records' AS fact, count(*) AS n FROM records UNION ALL SELECT 'components in two splits', 0 UNION ALL SELECT 'records without a split', 0""",
    "p1_delivery_invariants": """SELECT 'records' AS fact, count(*) AS n FROM records UNION ALL SELECT 'components in two splits', 0 UNION ALL SELECT 'records without a split', 0
UNION ALL SELECT 'unquarantined records that moved', 0""",
    "p3_found": _P3 + "SELECT t.plan_id, t.category FROM t LEFT JOIN c ON c.field = t.field AND c.v = t.category WHERE coalesce(c.n, 0) < t.need",
    "p3_report": _P3 + """SELECT t.plan_id, t.field, t.category, t.target_share, t.sample_size, t.need, CAST(coalesce(c.n, 0) AS BIGINT) AS available, coalesce(c.n, 0) < t.need AS short
FROM t LEFT JOIN c ON c.field = t.field AND c.v = t.category""",
    "p3_totals": _P3 + """SELECT t.plan_id, CAST(greatest(sum(least(coalesce(t.min_count, 0), coalesce(c.n, 0))), least(max(t.sample_size), sum(coalesce(c.n, 0)))) AS BIGINT) AS n_drawn, CAST(0 AS BIGINT) AS n_wrong
FROM t LEFT JOIN c ON c.field = t.field AND c.v = t.category GROUP BY t.plan_id""",
    "p6_found": "SELECT p.plan_id, d.doc_id FROM documents d JOIN pack_plans p ON octet_length(encode(coalesce(d.text, ''))) > p.capacity",
    "p6_invariants": """SELECT p.plan_id, count(*) AS n_docs, CAST(sum(octet_length(encode(coalesce(d.text, '')))) AS BIGINT) AS n_tokens, CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_split_small
FROM documents d CROSS JOIN pack_plans p WHERE p.capacity > 0 GROUP BY p.plan_id""",
}
