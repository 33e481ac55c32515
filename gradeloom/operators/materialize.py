"""From candidate families to canonical records: scores, evidence, texts, ids, overrides."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clip, number_g, sentences, today, ustrip
from ..schemas import RESPONSE_SOURCES
from .quota import canonical_summary

# Parts of a criterion's id that choose its evidence; the first hit wins.
EVIDENCE_RULES = {
    "batch": (("first_two", ("evidence", "textual", "supporting", "detail")), ("last", ("explanation", "effect", "function", "reasoning", "relationship", "inference")), ("first_two", ("organization", "clarity"))),
    "wave1": (("first_two", ("evidence", "textual", "supporting")), ("last", ("explanation", "effect", "interpretation")), ("first_two", ("organization", "clarity"))),
}
# Feedback by share of the maximum, as (at least, text).
FEEDBACK_UNCLEAR = "Mevcut girdi güvenilir bir final puanı için yeterli değildir; kaynak belirsizliği doğrulanmalıdır."
FEEDBACK_BATCH = (
    (0.999, "Yanıt rubriğin temel beklentilerini tam olarak karşılıyor."),
    (0.7, "Yanıtın ana yönü doğru; bazı ölçütlerde sınırlı eksikler bulunuyor."),
    (0.4, "Yanıt kısmi başarı gösteriyor; kanıt, açıklama veya gerekçelendirmede belirgin eksikler var."),
)
FEEDBACK_SOME = "Yanıtta sınırlı doğru unsurlar var; rubriğin temel beklentileri büyük ölçüde karşılanmıyor."
FEEDBACK_NONE = "Yanıt rubriğin temel beklentilerini karşılamıyor."
ANCHOR_TEXT = " için yanıt {} puan düzeyindeki çıpayla uyumludur: "
NO_SCORE_TEXT = " açısından gerekli unsur yanıtta gösterilmemiştir."
SOME_SCORE_TEXT = " ölçütü mevcut öğrenci cevabına göre kısmen karşılanmıştır."


def anchor_for(anchors: Column, score: Column) -> Column:
    """Description of the anchor with the nearest score; an exact one is nearest, ties go to the first listed."""
    # the filter keeps the original order, so the index is that of the list without nulls
    ranked = F.transform(F.filter(anchors, lambda a: a.isNotNull()), lambda a, i: F.struct(F.abs(F.coalesce(a["score"], F.lit(0.0)) - score).alias("d"), i.alias("i"), a["description"].alias("t")))
    return F.array_min(ranked)["t"]


def evidence_for(text: Column, criterion_id: Column, score: Column, rules: str = "batch") -> Column:
    """Sentences that serve as evidence; none for a score of zero or less or an empty text."""
    parts = sentences(text)
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(text))
    cid = F.lower(criterion_id)
    chosen = F.slice(parts, 1, 1)
    for how, tokens in reversed(EVIDENCE_RULES[rules]):
        pick = F.slice(parts, 1, 2) if how == "first_two" else F.slice(parts, -1, 1)
        chosen = F.when(cid.rlike("|".join(tokens)), pick).otherwise(chosen)
    cut = F.transform(F.filter(chosen, lambda s: ustrip(s) != ""), lambda s: clip(s))
    return F.when((score <= 0) | text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(cut)


def justification(name: Column, criterion_id: Column, anchors: Column, score: Column) -> Column:
    label = F.coalesce(F.nullif(name, F.lit("")), F.nullif(criterion_id, F.lit("")), F.lit("Ölçüt"))
    anchor = F.nullif(anchor_for(anchors, score), F.lit(""))
    pre, post = ANCHOR_TEXT.split("{}")
    return F.when(anchor.isNotNull(), F.concat(label, F.lit(pre), number_g(score), F.lit(post), anchor)).when(score <= 0, F.concat(label, F.lit(NO_SCORE_TEXT))).otherwise(F.concat(label, F.lit(SOME_SCORE_TEXT)))


def feedback(total: Column, maximum: Column, needs_review: Column) -> Column:
    ratio = F.coalesce(F.try_divide(total, maximum), F.lit(0.0))
    out = F.when(needs_review.eqNullSafe(F.lit(True)), FEEDBACK_UNCLEAR)
    for at, t in FEEDBACK_BATCH:
        out = out.when(ratio >= at, t)
    return out.when(total > 0, FEEDBACK_SOME).otherwise(FEEDBACK_NONE)


def record_id(grade: Column, modality: Column, serial: Column) -> Column:
    return F.format_string("tde%02d-%s-%06d", grade, modality, serial)


def next_record_id(records: DataFrame) -> DataFrame:
    """``(grade, modality, next_id)`` after the greatest serial of each grade and modality."""
    parts = records.select(F.regexp_extract("id", r"^tde(\d+)-(\w+)-(\d+)$", 1).alias("g"), F.regexp_extract("id", r"^tde(\d+)-(\w+)-(\d+)$", 2).alias("modality"), F.regexp_extract("id", r"^tde(\d+)-(\w+)-(\d+)$", 3).alias("n")).where("n <> ''")
    top = parts.groupBy(F.col("g").cast("int").alias("grade"), "modality").agg(F.max(F.col("n").cast("int")).alias("n"))
    return top.select("grade", "modality", record_id(F.col("grade"), F.col("modality"), F.col("n") + 1).alias("next_id"))


def running_serial(df: DataFrame, group: Sequence[str], order: Sequence[str], start: Column | int = 1) -> DataFrame:
    """Adds ``serial``: the start plus the place within the group."""
    first = start if isinstance(start, Column) else F.lit(start)
    return df.withColumn("serial", (first + F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1).cast("int"))


# ---- overrides -------------------------------------------------------------------------
def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key that is neither null nor empty."""
    fields = F.struct(*[c for c in df.columns if c != key])
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.max_by(fields, order).alias("r")).select(key, "r.*")


def has_key(raw: Column, name: str) -> Column:
    """Is the key in the JSON object at all, null or not?"""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), name), F.lit(False))


def override_text(base: Column, raw: Column) -> Column:
    """``text_override`` wins if the key is there, a null one being empty text."""
    return ustrip(F.when(has_key(raw, "text_override"), F.coalesce(F.get_json_object(raw, "$.text_override"), F.lit(""))).otherwise(F.coalesce(base, F.lit(""))))


def override_quality(base: Column, raw: Column) -> Column:
    """``effective_response_quality`` wins only if it is not empty; the base defaults to ``mid_partial``."""
    return F.coalesce(F.nullif(F.get_json_object(raw, "$.effective_response_quality"), F.lit("")), F.nullif(base, F.lit("")), F.lit("mid_partial"))


def override_hard_cases(base: Column, raw: Column) -> Column:
    """``hard_case_types_override`` wins if the key is there, null giving an empty list."""
    none = F.array().cast("array<string>")
    given = F.coalesce(F.from_json(F.get_json_object(raw, "$.hard_case_types_override"), "array<string>"), none)
    return F.when(has_key(raw, "hard_case_types_override"), given).otherwise(F.coalesce(base, none))


def merge_scores(base: Column, raw: Column, fields: Sequence[str] = ("scores", "content_scores", "final_scores")) -> Column:
    """Key-wise merge of score maps, later fields winning (without relying on a session setting)."""
    out = F.coalesce(base, F.create_map().cast("map<string,double>"))
    for f in fields:
        new = F.coalesce(F.from_json(F.get_json_object(raw, f"$.{f}"), "map<string,double>"), F.create_map().cast("map<string,double>"))
        out = _overlay(out, new)
    return out


def _overlay(old: Column, new: Column) -> Column:
    keep = F.filter(F.map_entries(old), lambda e: ~F.array_contains(F.map_keys(new), e["key"]))
    return F.map_from_entries(F.concat(keep, F.map_entries(new)))


def positional_scores(criteria: Column, scores: Column) -> Column:
    """Scores by the place of their criterion; a shorter list scores the first ones."""
    ids = F.transform(F.slice(criteria, 1, F.least(F.size(criteria), F.size(scores))), lambda c: c["criterion_id"])
    return F.map_from_entries(F.transform(ids, lambda c, i: F.struct(c.alias("key"), F.get(scores, i).alias("value"))))


def transcript_criteria(criteria: Column, modality: Column) -> Column:
    """Speaking loses criteria that need audio or observation; others keep all."""
    nontext = F.array(F.lit("audio_delivery"), F.lit("teacher_observation"))
    kept = F.filter(criteria, lambda c: ~F.coalesce(F.arrays_overlap(c["evidence_sources"], nontext), F.lit(False)))
    return F.when(modality == "speaking", kept).otherwise(criteria)


FAMILY_DDL = """file string, record_id_start int, grade int, modality string, created_at string, tags array<string>, exam_family string, question_family string,
rubric struct<rubric_id:string, version:string, criteria:array<struct<criterion_id:string, name:string, description:string, max_score:double,
  scoring_anchors:array<struct<score:double, description:string>>, evidence_sources:array<string>>>>,
tasks array<struct<task_id:string, prompt:string, context:string, responses:array<struct<candidate_id:string, text:string, scores:array<double>,
  response_quality:string, hard_case_types:array<string>, adversarial:boolean, needs_review:boolean, review_reason:string, source:string>>>>"""


def build_batch(families: DataFrame, overrides: DataFrame | None = None, second_pass: DataFrame | None = None, batch: str = "batch") -> DataFrame:
    """Canonical records of candidate families (``FAMILY_DDL``).

    ``overrides(candidate_id, pos, raw)`` holds each override as JSON text, so that an absent
    key differs from a null one; the last one of a candidate counts and those without an id are
    ignored.  ``second_pass(candidate_id)`` lists candidates reviewed twice.  Serials run within
    a family in written order.  Rows carry an ``error`` column: a source that is not known, raw
    recognition without uncertainties, a criterion without a score or a score out of range.
    """
    t = families.select("*", F.posexplode("tasks").alias("task_pos", "t")).drop("tasks")
    r = t.select("*", F.posexplode("t.responses").alias("resp_pos", "r"))
    r = running_serial(r, ["file"], ["task_pos", "resp_pos"], F.col("record_id_start")).withColumn("candidate_id", F.col("r.candidate_id"))
    if overrides is not None:
        r = r.join(last_by(overrides, "candidate_id", "pos").select("candidate_id", "raw"), "candidate_id", "left")
    else:
        r = r.withColumn("raw", F.lit(None).cast("string"))
    if second_pass is not None:
        r = r.join(second_pass.select("candidate_id", F.lit(2).alias("passes")).distinct(), "candidate_id", "left")
    else:
        r = r.withColumn("passes", F.lit(None).cast("int"))
    raw = F.col("raw")
    review, reason = _review_target(raw)
    source = F.when(has_key(raw, "source_override"), F.get_json_object(raw, "$.source_override")).otherwise(F.coalesce("r.source", F.lit("manual")))
    unsure = F.from_json(F.get_json_object(raw, "$.input_uncertainties_override"), "array<struct<span:string,candidates:array<string>>>")
    r = r.select(
        "*",
        override_text(F.col("r.text"), raw).alias("text"),
        review.alias("review"),
        reason.alias("reason"),
        source.alias("source"),
        unsure.alias("unsure"),
        merge_scores(positional_scores(F.col("rubric.criteria"), F.col("r.scores")), raw).alias("scores"),
        override_quality(F.col("r.response_quality"), raw).alias("quality"),
        override_hard_cases(F.col("r.hard_case_types"), raw).alias("hard"),
    )
    return _assemble(r, batch, "batch")


def _review_target(raw: Column) -> tuple[Column, Column]:
    """Review flag and reason: both from the override if it has the flag; no reason without the flag."""
    given = has_key(raw, "needs_review")
    review = F.coalesce(F.when(given, F.get_json_object(raw, "$.needs_review") == "true").otherwise(F.col("r.needs_review")), F.lit(False))
    return review, F.when(review, F.when(given, F.get_json_object(raw, "$.review_reason")).otherwise(F.col("r.review_reason")))


def build_wave(families: DataFrame, recalibration: DataFrame, review: DataFrame, batch: str = "wave") -> DataFrame:
    """Canonical records of transcript waves: recalibration first, then the AI review, which wins.

    Both are tables ``(candidate_id, pos, raw)``.  Recalibration cannot set hard cases; the review's
    final scores overlay the recalibrated ones.  Speaking families lose criteria that need audio or
    observation, their rubric becomes ``-transcript`` version 1.1 and scores of lost criteria are
    dropped.  Serials run per modality across families in written order (``file``, task, response).
    """
    t = families.select("*", F.posexplode("tasks").alias("task_pos", "t")).drop("tasks")
    r = t.select("*", F.posexplode("t.responses").alias("resp_pos", "r")).withColumn("candidate_id", F.col("r.candidate_id"))
    r = running_serial(r, ["modality"], ["file", "task_pos", "resp_pos"])
    for name, layer in (("recal", recalibration), ("ai", review)):
        r = r.join(last_by(layer, "candidate_id", "pos").select("candidate_id", F.col("raw").alias(name)), "candidate_id", "left")
    recal, ai = F.col("recal"), F.col("ai")
    source = F.col("rubric.criteria")
    kept = transcript_criteria(source, F.col("modality"))
    lost = (F.col("modality") == "speaking") & (F.size(kept) != F.size(source))
    scores = merge_scores(merge_scores(positional_scores(source, F.col("r.scores")), recal, ("scores", "content_scores")), ai, ("final_scores",))
    known = F.transform(kept, lambda c: c["criterion_id"])
    scores = F.map_from_entries(F.filter(F.map_entries(scores), lambda e: F.array_contains(known, e["key"])))
    target, reason = _review_target(ai)
    rubric = F.struct(F.when(lost, F.concat("rubric.rubric_id", F.lit("-transcript"))).otherwise(F.col("rubric.rubric_id")).alias("rubric_id"), F.when(lost, "1.1").otherwise(F.col("rubric.version")).alias("version"), kept.alias("criteria"))
    r = r.select(
        *[c for c in r.columns if c != "rubric"],
        rubric.alias("rubric"),
        override_text(override_text(F.col("r.text"), recal), ai).alias("text"),
        target.alias("review"),
        reason.alias("reason"),
        F.coalesce("r.source", F.lit("manual")).alias("source"),
        F.lit(None).cast("array<struct<span:string,candidates:array<string>>>").alias("unsure"),
        scores.alias("scores"),
        override_quality(override_quality(F.col("r.response_quality"), recal), ai).alias("quality"),
        override_hard_cases(F.col("r.hard_case_types"), ai).alias("hard"),
        F.lit(None).cast("int").alias("passes"),
    )
    return _assemble(r, batch, "wave1")


def _assemble(r: DataFrame, batch: str, rules: str) -> DataFrame:
    """Nested canonical records from resolved columns, with an ``error`` column."""
    crit = F.col("rubric.criteria")
    score = lambda c: F.try_element_at("scores", c["criterion_id"])
    results = F.transform(crit, lambda c: F.struct(c["criterion_id"].alias("criterion_id"), score(c).alias("score"), evidence_for(F.col("text"), c["criterion_id"], score(c), rules).alias("evidence"), justification(c["name"], c["criterion_id"], c["scoring_anchors"], score(c)).alias("justification")))
    r = r.withColumn("results", results).withColumn("total", F.aggregate("results", F.lit(0.0), lambda a, x: a + x["score"])).withColumn("maximum", F.aggregate(crit, F.lit(0.0), lambda a, x: a + x["max_score"]))
    bad = F.exists(crit, lambda c: score(c).isNull() | (score(c) < 0) | (score(c) > c["max_score"]))
    error = F.when(~F.coalesce(F.col("source").isin(*RESPONSE_SOURCES), F.lit(False)), "source").when(F.col("source").isin("raw_ocr", "raw_stt") & (F.coalesce(F.size("unsure"), F.lit(0)) <= 0), "uncertainties").when(bad | F.exists(F.map_keys("scores"), lambda k: ~F.exists(crit, lambda c: c["criterion_id"] == k)), "scores")
    tags = F.array_sort(F.array_distinct(F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(F.lit(batch), F.lit("synthetic")))))
    return r.select(
        record_id(F.col("grade"), F.col("modality"), F.col("serial")).alias("id"), F.lit("1.0").alias("schema_version"), "modality", F.lit("tr").alias("language"), "grade",
        F.struct(F.col("t.task_id"), F.col("t.prompt"), F.col("t.context"), F.col("maximum").alias("max_score")).alias("task"), "rubric",
        F.struct("text", "source", F.array().cast("array<struct<label:string,value:string,source:string>>").alias("observations"), F.when(F.size("unsure") > 0, F.col("unsure")).alias("input_uncertainties")).alias("student_response"),
        F.struct(F.col("results").alias("criterion_results"), F.col("total").alias("total_score"), F.col("maximum").alias("max_score"), F.col("review").alias("needs_review"), F.col("reason").alias("review_reason"), feedback(F.col("total"), F.col("maximum"), F.col("review")).alias("overall_feedback")).alias("gold_evaluation"),
        F.struct(F.lit("ai_verified").alias("status"), F.lit(None).cast("string").alias("split"), "created_at", tags.alias("tags"), F.lit(True).alias("pii_reviewed"), F.lit(None).cast("string").alias("subject_group_id"), "exam_family", "question_family", F.lit("synthetic").alias("provenance"), F.lit("ai").alias("verification_source"), F.col("quality").alias("response_quality"), F.col("hard").alias("hard_case_types"), F.coalesce("r.adversarial", F.lit(False)).alias("adversarial"), F.coalesce("passes", F.lit(1)).alias("review_count"), F.lit(False).alias("adjudicated")).alias("metadata"),
        "candidate_id", error.alias("error"),
    )


def overwrite_conflicts(new: DataFrame, existing: DataFrame, batch: str) -> DataFrame:
    """Ids of new records that exist already and were not made by this batch."""
    mine = F.coalesce(F.array_contains("metadata.tags", batch), F.lit(False))
    return new.select("id").join(existing.where(~mine).select("id"), "id", "left_semi").distinct()


def draft_records(rows: DataFrame) -> DataFrame:
    """Draft canonical records from ``(id, grade, modality, prompt, context, text, source, criteria, created_at)``."""
    total = F.aggregate("criteria", F.lit(0.0), lambda a, c: a + c["max_score"])
    results = F.transform("criteria", lambda c: F.struct(c["criterion_id"].alias("criterion_id"), F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("evidence"), F.lit("").alias("justification")))
    return rows.select("id", F.lit("1.0").alias("schema_version"), "modality", F.lit("tr").alias("language"), "grade", F.struct("prompt", "context", total.alias("max_score")).alias("task"), F.struct("criteria").alias("rubric"), F.struct("text", "source").alias("student_response"), F.struct(results.alias("criterion_results"), F.lit(0.0).alias("total_score"), total.alias("max_score"), F.lit(True).alias("needs_review")).alias("gold_evaluation"), F.struct(F.lit("draft").alias("status"), "created_at").alias("metadata"))


def check_family_sizes(built: DataFrame, expected: int) -> None:
    """Raise unless every question family of a build has ``expected`` answers; names the first ten that have not."""
    per = built.groupBy(F.col("metadata.question_family").alias("family")).agg(F.count("*").alias("n")).where(F.col("n") != expected)
    wrong = [f"{r['family']}: {r['n']}" for r in per.orderBy("family").limit(10).collect()]
    if wrong:
        raise ValueError(f"families without {expected} answers: " + ", ".join(wrong))


def update_manifest(path: str, built: DataFrame, at: str | None = None) -> dict:
    """Write counts and distribution of a finished build into its manifest, a small JSON file on the driver.

    The file is replaced as a whole, so a reader sees the old one or the new one.
    """
    with open(path, encoding="utf-8") as f:
        manifest = json.load(f)
    spread: dict = {}
    for r in canonical_summary(built).orderBy("axis", "category").limit(10_000).collect():
        spread.setdefault(r["axis"], {})[r["category"]] = r["n"]
    total = sum(spread.get("modality", {}).values())
    flat = {k: v["yes"] if set(v) == {"yes"} else v for k, v in spread.items()}
    for k in ("hard_case_records", "adversarial_records", "needs_review_records", "second_pass_records"):
        flat.setdefault(k, 0)
    manifest |= {"status": "materialized", "canonical_records": total, "pending_records": 0, "materialized_at": at or today(), "canonical_distribution": flat}
    tmp = f"{path}.{uuid.uuid4().hex}"
    with open(tmp, "w", encoding="utf-8") as f:
        json.dump(manifest, f, ensure_ascii=False, indent=2)
    os.replace(tmp, path)
    return manifest
