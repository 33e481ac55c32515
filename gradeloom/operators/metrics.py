"""Agreement of predictions with gold evaluations, by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import is_true, safe_div
from ..schemas import TOLERANCE


def latest_gold(records: DataFrame, splits: tuple[str, ...] | None = None) -> DataFrame:
    """One gold record for each id: the one delivered last (``max_by`` combines before the shuffle)."""
    df = records if splits is None else records.where(F.col("metadata.split").isin(*splits))
    order = F.struct(F.col("ingested_at").isNotNull().alias("a"), F.col("ingested_at").alias("t"), F.col("record_key").alias("k"))
    body = F.struct("record_key", "modality", "grade", "rubric", "gold_evaluation", "metadata")
    return df.where("id is not null").groupBy("id").agg(F.max_by(body, order).alias("r")).select("id", "r.*")


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """One prediction for each run and id: the one produced last, then with the greatest key."""
    order = F.struct(F.col("produced_at").isNotNull().alias("a"), F.col("produced_at").alias("t"), F.col("prediction_key").alias("k"))
    body = F.struct("prediction_key", "criterion_scores", "needs_review")
    return predictions.where("id is not null").groupBy("run_id", "id").agg(F.max_by(body, order).alias("p")).select("run_id", "id", "p.*")


def prediction_errors(predictions: DataFrame) -> DataFrame:
    """``(prediction_key, error)`` of malformed predictions: no id, no flag, no map, blank keys or scores that are no finite numbers."""
    m = F.col("criterion_scores")
    bad_value = F.exists(F.map_values(m), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    bad_key = F.exists(F.map_keys(m), lambda k: k == "")
    error = (
        F.when(F.coalesce(F.col("id") == "", F.lit(True)), "id")
        .when(F.col("needs_review").isNull(), "needs_review")
        .when(m.isNull(), "criterion_scores")
        .when(bad_key, "criterion_id")
        .when(bad_value, "score")
    )
    return predictions.select("prediction_key", error.alias("error")).where("error is not null")


def unknown_predictions(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Predictions whose id no gold record has."""
    return predictions.join(gold.select("id"), "id", "left_anti")


def missing_predictions(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """``(run_id, id)`` that a run lacks.  Runs times gold ids less what is there; the list of runs is checked to be small."""
    runs = predictions.select("run_id").where("run_id is not null").distinct().limit(10_001).collect()
    if len(runs) > 10_000:
        raise ValueError("more than 10,000 runs")
    names = F.array(*[F.lit(r["run_id"]) for r in sorted(runs, key=lambda r: r["run_id"])]).cast("array<string>")
    want = gold.select("id", F.explode(names).alias("run_id"))
    return want.join(predictions.select("run_id", "id"), ["run_id", "id"], "left_anti").select("run_id", "id")


def missing_counts(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """``(run_id, n_missing)`` of every run, without listing the ids: all gold ids less those the run has."""
    have = predictions.where("run_id is not null").join(gold.select("id"), "id").groupBy("run_id").agg(F.count_distinct("id").alias("n"))
    runs = predictions.where("run_id is not null").select("run_id").distinct().join(have, "run_id", "left")
    return runs.crossJoin(gold.agg(F.count("*").alias("n_gold"))).select("run_id", (F.col("n_gold") - F.coalesce("n", F.lit(0))).alias("n_missing"))  # by one row


def strict_problems(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """``(run_id, problem, id)`` of everything that forbids scoring a run: ``malformed`` predictions,
    ``duplicate``, ``unknown`` and ``missing`` ids.  A null run is a run of its own; a malformed
    prediction without id stands under its key."""
    bad = predictions.join(prediction_errors(predictions).select("prediction_key"), "prediction_key", "left_semi")
    ids = predictions.where("id is not null and id <> ''").groupBy("run_id", "id").agg(F.count("*").alias("n"))
    parts = [
        bad.select("run_id", F.lit("malformed").alias("problem"), F.coalesce(F.nullif("id", F.lit("")), F.concat(F.lit("#"), F.col("prediction_key").cast("string"))).alias("id")),
        ids.where("n > 1").select("run_id", F.lit("duplicate").alias("problem"), "id"),
        unknown_predictions(ids, gold).select("run_id", F.lit("unknown").alias("problem"), "id"),
        missing_predictions(predictions, gold).select("run_id", F.lit("missing").alias("problem"), "id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_offenders(problems: DataFrame, top: int = 10) -> DataFrame:
    """``(run_id, problem, n, first_ids)``: count and the first ``top`` ids of each problem, comma-separated."""
    keys = ["run_id", "problem"]
    n = problems.groupBy(*keys).agg(F.count("*").alias("n"))
    # the rank limit is applied before the shuffle, so no task sees more than top rows of a key from each partition
    w = Window.partitionBy(*keys).orderBy("id")
    few = problems.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    few = few.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("first_ids"))
    same = [n[k].eqNullSafe(few[k]) for k in keys]
    return n.join(few, same[0] & same[1]).select(n["run_id"], n["problem"], "n", "first_ids")


def targeted_rates(scored: DataFrame, overridden: Column | None = None) -> DataFrame:
    """``(hard_case_type, records, items, under_rate, over_rate, review_rate, override_rate)`` of each hard-case type.

    ``override_rate`` is the share of records whose predicted total reaches the maximum although
    the gold one does not (``overridden``), as an injected instruction would have it.
    """
    kind = F.explode(F.coalesce(F.col("metadata.hard_case_types"), F.array().cast("array<string>")))
    over = F.coalesce(overridden if overridden is not None else F.lit(None).cast("boolean"), F.lit(False))
    g = scored.withColumn("hard_case_type", kind).groupBy("hard_case_type")
    out = g.agg(F.count("*").alias("records"), F.sum("items").alias("items"), F.sum("under").alias("u"), F.sum("over").alias("o"), F.count_if("pred_review").alias("r"), F.count_if(over).alias("x"))
    return out.select("hard_case_type", "records", "items", safe_div(F.col("u"), F.col("items")).alias("under_rate"), safe_div(F.col("o"), F.col("items")).alias("over_rate"), safe_div(F.col("r"), F.col("records")).alias("review_rate"), safe_div(F.col("x"), F.col("records")).alias("override_rate"))


def _criteria(path: str) -> Column:
    return F.filter(F.col(path), lambda x: x.isNotNull() & x["criterion_id"].isNotNull())


def contract_errors(joined: DataFrame) -> DataFrame:
    """``(run_id, id, missing, extra, out_of_range)`` of joined rows that break the contract.

    The predicted criteria must be those of the rubric and each score within 0 and the
    criterion's maximum, without tolerance.
    """
    crit = _criteria("rubric.criteria")
    want, got = F.array_distinct(F.transform(crit, lambda c: c["criterion_id"])), F.map_keys("criterion_scores")
    limit = lambda k: F.element_at(F.transform(F.filter(crit, lambda c: c["criterion_id"] == k), lambda c: c["max_score"]), -1)
    known = F.array_intersect(got, want)
    score = lambda k: F.try_element_at("criterion_scores", k)
    outside = F.filter(known, lambda k: (score(k) < 0) | (score(k) > limit(k)))
    out = joined.select(
        "run_id",
        "id",
        F.array_join(F.array_sort(F.array_except(want, got)), ",").alias("missing"),
        F.array_join(F.array_sort(F.array_except(got, want)), ",").alias("extra"),
        F.array_join(F.array_sort(outside), ",").alias("out_of_range"),
    )
    return out.where("missing <> '' or extra <> '' or out_of_range <> ''")


def joined(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Inner join on id.  Both sides have one row per key, so no id can blow up."""
    return predictions.join(gold, "id")


def score_rows(rows: DataFrame) -> DataFrame:
    """Per joined row: errors against each gold criterion and against the total, all in the row.

    A criterion without a prediction has no error; repeated gold results count each.
    """
    results = F.filter(_criteria("gold_evaluation.criterion_results"), lambda x: x["score"].isNotNull())
    err = F.transform(results, lambda r: F.try_element_at("criterion_scores", r["criterion_id"]) - r["score"])
    err = F.filter(err, lambda e: e.isNotNull() & ~F.isnan(e))
    gold = F.col("gold_evaluation")
    rows = rows.withColumn("errs", err)
    full = F.coalesce(gold["max_score"], F.lit(0.0))
    predicted = F.aggregate(F.transform(results, lambda r: F.coalesce(F.try_element_at("criterion_scores", r["criterion_id"]), F.lit(0.0))), F.lit(0.0), lambda a, b: a + b)
    total = F.abs(predicted - gold["total_score"])
    count = lambda c: F.size(c).cast("bigint")
    scoreable = ~is_true(gold["needs_review"])
    return rows.select(
        "run_id", "id", "modality", "grade", "metadata",
        scoreable.alias("scoreable"),
        is_true(gold["needs_review"]).alias("gold_review"),
        is_true(F.col("needs_review")).alias("pred_review"),
        F.when(scoreable, count("errs")).otherwise(0).alias("items"),
        F.when(scoreable, count(F.filter("errs", lambda e: F.abs(e) <= TOLERANCE))).otherwise(0).alias("exact"),
        F.when(scoreable, count(F.filter("errs", lambda e: F.abs(e) <= 1 + TOLERANCE))).otherwise(0).alias("within_1"),
        F.when(scoreable, count(F.filter("errs", lambda e: e > TOLERANCE))).otherwise(0).alias("over"),
        F.when(scoreable, count(F.filter("errs", lambda e: e < -TOLERANCE))).otherwise(0).alias("under"),
        F.when(scoreable, F.aggregate("errs", F.lit(0.0), lambda a, b: a + F.abs(b))).otherwise(0.0).alias("abs_error"),
        F.when(scoreable, F.aggregate("errs", F.lit(0.0), lambda a, b: a + b)).otherwise(0.0).alias("signed_error"),
        F.when(scoreable, total).alias("total_error"),
        (scoreable & (full > 0) & (predicted >= full - TOLERANCE) & (gold["total_score"] < full - TOLERANCE)).alias("overridden"),
        F.when(scoreable, total / F.coalesce(F.nullif(gold["max_score"], F.lit(0.0)), F.lit(1.0))).alias("norm_error"),
    )


def slices() -> Column:
    """All slices a row belongs to; repeated hard-case labels count twice."""
    m = F.col("metadata")
    cell = lambda dim, c: F.struct(F.lit(dim).alias("dim"), F.coalesce(c.cast("string"), F.lit("<unclassified>")).alias("value"))
    hard = F.coalesce(m["hard_case_types"], F.array().cast("array<string>"))
    hard_case, adversarial = F.size(hard) > 0, is_true(m["adversarial"])
    one = F.array(
        cell("overall", F.lit("all")),
        cell("modality", F.col("modality")),
        cell("grade", F.col("grade")),
        cell("response_quality", m["response_quality"]),
        cell("question_family", m["question_family"]),
        cell("hard_case", F.when(hard_case, "hard").otherwise("normal")),
        cell("adversarial", F.when(adversarial, "adversarial").otherwise("plain")),
    )
    return F.concat(one, F.transform(hard, lambda h: cell("hard_case_type", h)))


def slice_metrics(scored: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """All metrics for each slice: one explode, one partial and final aggregation.

    Rates are null on an empty denominator.  Scores use rows whose gold needs no review;
    the review counts use all rows.
    """
    g = scored.withColumn("s", F.explode(slices())).groupBy(*keys, F.col("s.dim").alias("dim"), F.col("s.value").alias("value"))
    tp, fp, fn, tn = (F.count_if((F.col("gold_review") == a) & (F.col("pred_review") == b)) for a, b in ((True, True), (False, True), (True, False), (False, False)))
    out = g.agg(
        F.count("*").alias("records"),
        F.count_if("scoreable").alias("resolvable_records"),
        F.sum("items").alias("criterion_items"),
        F.sum("exact").alias("n_exact"),
        F.sum("within_1").alias("n_within_1"),
        F.sum("over").alias("n_over"),
        F.sum("under").alias("n_under"),
        F.sum("abs_error").alias("abs_error"),
        F.sum("signed_error").alias("signed_error"),
        F.count("total_error").alias("totals"),
        F.count_if(F.col("total_error") <= TOLERANCE).alias("n_total_exact"),
        F.sum("total_error").alias("total_error"),
        F.sum("norm_error").alias("norm_error"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
    )
    precision, recall = safe_div(F.col("tp"), F.col("tp") + F.col("fp")), safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.select(
        *keys, "dim", "value", "records", "resolvable_records", "criterion_items", "n_exact", "n_within_1", "n_over", "n_under", "n_total_exact", "tp", "fp", "fn", "tn",
        safe_div(F.col("n_exact"), F.col("criterion_items")).alias("criterion_exact_rate"),
        safe_div(F.col("n_within_1"), F.col("criterion_items")).alias("criterion_within_1_rate"),
        F.round(safe_div(F.col("abs_error"), F.col("criterion_items")), 6).alias("criterion_mae"),
        F.round(safe_div(F.col("signed_error"), F.col("criterion_items")), 6).alias("criterion_bias"),
        safe_div(F.col("n_total_exact"), F.col("totals")).alias("total_exact_rate"),
        F.round(safe_div(F.col("total_error"), F.col("totals")), 6).alias("total_mae"),
        F.round(safe_div(F.col("norm_error"), F.col("totals")), 6).alias("total_normalized_mae"),
        precision.alias("precision"),
        recall.alias("recall"),
        # null where precision or recall is, and where both are zero
        F.round(safe_div(2 * precision * recall, precision + recall), 9).alias("f1"),
        safe_div(F.col("tp") + F.col("tn"), F.col("records")).alias("accuracy"),
    )


def boundary_matrix(rows: DataFrame) -> DataFrame:
    """``(gold_score, predicted_score, n)`` over all scoreable criterion items."""
    results = F.filter(_criteria("gold_evaluation.criterion_results"), lambda x: x["score"].isNotNull())
    cells = rows.where(~is_true(F.col("gold_evaluation.needs_review"))).select(F.explode(F.transform(results, lambda r: F.struct(r["score"].alias("gold_score"), F.try_element_at("criterion_scores", r["criterion_id"]).alias("predicted_score")))).alias("c"))
    return cells.where("c.predicted_score is not null").groupBy("c.gold_score", "c.predicted_score").agg(F.count("*").alias("n"))


def mine_errors(scored: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent failures: kind, modality, grade, family and hard-case types (ties by name)."""
    kind = (
        F.when(F.col("gold_review") & ~F.col("pred_review"), "false_confident")
        .when(~F.col("gold_review") & F.col("pred_review"), "needless_review")
        .when(F.col("total_error") > 1 + TOLERANCE, "total_off_by_more_than_1")
        .when(F.col("total_error") > TOLERANCE, "total_off")
    )
    m = F.col("metadata")
    miss = lambda c: F.coalesce(c.cast("string"), F.lit("<missing>"))
    rows = scored.select(kind.alias("failure_type"), miss(F.col("modality")).alias("modality"), miss(F.col("grade")).alias("grade"), miss(m["question_family"]).alias("question_family"), F.array_join(F.array_sort(F.coalesce(m["hard_case_types"], F.array().cast("array<string>"))), ",").alias("hard_case_types"), "abs_error").where("failure_type is not null")
    g = rows.groupBy("failure_type", "modality", "grade", "question_family", "hard_case_types").agg(F.count("*").alias("n"), F.sum("abs_error").alias("abs_error"))
    return g.orderBy(F.desc("n"), "failure_type", "modality", "grade", "question_family", "hard_case_types").limit(top)
