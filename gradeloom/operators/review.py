"""Second-pass review corrections applied to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_true, number_g
from .materialize import FEEDBACK_UNCLEAR, anchor_for

# Feedback after a review by share of the maximum, as (at least, text).
FEEDBACK_REVIEW = (
    (0.9, "Yanıt rubriğin ölçütlerini güçlü ve tutarlı biçimde karşılıyor."),
    (0.7, "Yanıtın ana yönü güçlü; bazı ölçütlerde sınırlı eksikler bulunuyor."),
    (0.4, "Yanıt göreve kısmen yanıt veriyor; gerekçelendirme ve eksik ölçütler geliştirilmelidir."),
)
FEEDBACK_LOW = "Yanıt rubriğin çoğu ölçütünü karşılamıyor; temel görev ve kanıt ilişkisi güçlendirilmelidir."
SCORE_TEXT = (" için ikinci AI değerlendirmesi ", " puan verdi.", " Rubrik çıpası: ")


def latest_corrections(corrections: DataFrame) -> DataFrame:
    """One correction for each id: the one reviewed last, then with the greatest key."""
    order = F.struct(F.col("reviewed_at").isNotNull().alias("a"), F.col("reviewed_at").alias("t"), F.col("correction_key").alias("k"))
    body = F.struct("correction_key", "scores", "response_quality")
    return corrections.where("id is not null").groupBy("id").agg(F.max_by(body, order).alias("c")).select("id", "c.*")


def unmatched(corrections: DataFrame, records: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """``(id, problem)``: corrections of ids that no record has (``unknown``) or none in scope (``out_of_scope``)."""
    ids = records.select("id", F.coalesce(F.col("metadata.split").isin(*scope), F.lit(False)).alias("inside")).groupBy("id").agg(F.max("inside").alias("inside"))
    j = corrections.select("id").distinct().join(ids, "id", "left")
    return j.select("id", F.when(F.col("inside").isNull(), "unknown").when(~F.col("inside"), "out_of_scope").alias("problem")).where("problem is not null")


def check_scope(records: DataFrame, scope: tuple[str, ...], expected: int | None) -> None:
    """Raise unless the scope has the expected number of records; nothing is checked for 0 or None."""
    if expected:
        n = records.where(F.col("metadata.split").isin(*scope)).count()
        if n != expected:
            raise ValueError(f"expected {expected} records in scope, found {n}")


def _feedback(total: Column, maximum: Column, review: Column) -> Column:
    ratio = total / F.coalesce(F.nullif(maximum, F.lit(0.0)), F.lit(1.0))
    out = F.when(is_true(review), FEEDBACK_UNCLEAR)
    for at, t in FEEDBACK_REVIEW:
        out = out.when(ratio >= at, t)
    return out.otherwise(FEEDBACK_LOW)


def apply_review(records: DataFrame, corrections: DataFrame, scope: tuple[str, ...] = ("validation", "test")) -> DataFrame:
    """Records in scope after review, with ``changed_scores``, ``changed_quality`` and ``review_error``.

    Every record in scope gets a review count of at least 2.  A corrected one gets the new scores
    with their justification, a new total and feedback, and the quality if one is given.  A score
    of a criterion the rubric lacks or outside 0 to its maximum (no tolerance) is an error: such a
    record keeps all its values.  Corrections are one row per id, so the join cannot multiply rows.
    """
    inside = records.where(F.col("metadata.split").isin(*scope))
    c = corrections.select("id", F.col("scores").alias("new_scores"), F.col("response_quality").alias("new_quality"), F.lit(True).alias("corrected"))
    j = inside.join(c, "id", "left")
    crit, res = F.col("rubric.criteria"), F.col("gold_evaluation.criterion_results")
    asked = F.coalesce("new_scores", F.create_map().cast("map<string,double>"))
    named = lambda k: F.element_at(F.filter(crit, lambda x: x["criterion_id"] == k), -1)
    known = lambda k: F.exists(F.coalesce(crit, F.array()), lambda x: F.coalesce(x["criterion_id"] == k, F.lit(False)))
    outside = F.filter(F.map_entries(asked), lambda e: ~known(e["key"]) | ~F.coalesce(e["value"].between(F.lit(0.0), F.element_at(F.transform(F.filter(crit, lambda x: x["criterion_id"] == e["key"]), lambda x: x["max_score"]), -1)), F.lit(False)))
    error = F.when(F.size(outside) > 0, F.array_join(F.array_sort(F.transform(outside, lambda e: e["key"])), ","))
    j = j.withColumn("review_error", error)
    ok = F.col("corrected").isNotNull() & F.col("review_error").isNull()
    touched = lambda r: F.coalesce(F.map_contains_key(asked, r["criterion_id"]), F.lit(False))
    a, b, t = SCORE_TEXT

    def words(r: Column) -> Column:
        k = named(r["criterion_id"])
        s = F.element_at(asked, r["criterion_id"])
        anchor = F.nullif(anchor_for(k["scoring_anchors"], s), F.lit(""))
        return F.concat(F.coalesce(k["name"], F.lit("")), F.lit(a), number_g(s), F.lit("/"), number_g(k["max_score"]), F.lit(b), F.coalesce(F.concat(F.lit(t), anchor), F.lit("")))

    new = F.transform(res, lambda r: F.when(touched(r), F.struct(r["criterion_id"].alias("criterion_id"), F.element_at(asked, r["criterion_id"]).alias("score"), r["evidence"].alias("evidence"), words(r).alias("justification"))).otherwise(r))
    changed = F.size(F.filter(res, lambda r: touched(r) & ~F.element_at(asked, r["criterion_id"]).eqNullSafe(r["score"])))
    total = F.aggregate(F.filter(new, lambda r: r.isNotNull()), F.lit(0.0), lambda x, r: x + F.coalesce(r["score"], F.lit(0.0)))
    j = j.select("*", new.alias("__new"), total.alias("__total"), F.when(ok, F.coalesce(changed, F.lit(0))).otherwise(0).alias("changed_scores"))
    gold = F.col("gold_evaluation")
    after = gold.withField("criterion_results", F.col("__new")).withField("total_score", F.coalesce("__total", F.lit(0.0)))
    after = after.withField("overall_feedback", _feedback(F.coalesce("__total", F.lit(0.0)), gold["max_score"], gold["needs_review"]))
    m = F.col("metadata")
    quality = F.when(ok & F.col("new_quality").isNotNull(), F.col("new_quality")).otherwise(m["response_quality"])
    meta = m.withField("review_count", F.greatest(F.lit(2), F.coalesce(m["review_count"], F.lit(0)))).withField("response_quality", quality)
    out = j.withColumn("changed_quality", (ok & F.col("new_quality").isNotNull() & ~F.col("new_quality").eqNullSafe(m["response_quality"])).cast("int"))
    out = out.withColumn("gold_evaluation", F.when(ok, after).otherwise(gold)).withColumn("metadata", meta)
    return out.select(*records.columns, "changed_scores", "changed_quality", "review_error", F.col("corrected").isNotNull().alias("corrected"))


def review_summary(applied: DataFrame) -> DataFrame:
    return applied.agg(F.count("*").alias("records_reviewed"), F.count_if("corrected").alias("records_corrected"), F.coalesce(F.sum("changed_scores"), F.lit(0)).alias("criterion_scores_changed"), F.coalesce(F.sum("changed_quality"), F.lit(0)).alias("response_quality_changed"), F.count("review_error").alias("errors"))
