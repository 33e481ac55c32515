"""Queries of quotas and score agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, quota
from .tables import table

STRATEGY = quota.Strategy()


def _records(spark, d):
    return table(spark, d, "records")


def agg_stats(spark, d):
    return quota.dataset_stats(_records(spark, d))


def agg_distribution(spark, d):
    return quota.distribution(quota.verified(_records(spark, d)), STRATEGY).drop("pos")


def agg_range_status(spark, d):
    return quota.range_status(quota.verified(_records(spark, d)), STRATEGY)


def agg_coverage_task(spark, d):
    return quota.coverage(quota.verified(_records(spark, d)), F.col("task.task_id"), *STRATEGY.per_task)


def agg_coverage_family(spark, d):
    return quota.coverage(quota.verified(_records(spark, d)), F.col("metadata.question_family"), *STRATEGY.per_family)


def agg_rubric_diversity(spark, d):
    return quota.rubric_diversity(quota.verified(_records(spark, d)))


def agg_two_way(spark, d):
    return quota.two_way(quota.verified(_records(spark, d)), F.col("modality"), F.col("metadata.response_quality"))


def alloc_next_batch(spark, d):
    return quota.next_batch(quota.verified(_records(spark, d)), STRATEGY, 500)


def alloc_no_deficit(spark, d):
    """A phase that is already full: shares fall back to the ratios."""
    return quota.next_batch(quota.verified(_records(spark, d)), quota.Strategy(target_records=0), 17)


def _sides(spark, d):
    return metrics.latest_predictions(table(spark, d, "predictions")), metrics.latest_gold(_records(spark, d))


def agg_report(spark, d):
    return quota.production_report(quota.verified(_records(spark, d)), STRATEGY)


def evaluate_strict(spark, d):
    """What forbids scoring the runs against the test split, with the first ten ids of each problem."""
    gold = metrics.latest_gold(_records(spark, d), ("test",))
    return metrics.first_offenders(metrics.strict_problems(table(spark, d, "predictions"), gold))


def missing_counts(spark, d):
    p, g = _sides(spark, d)
    return metrics.missing_counts(p, g)


def eval_targeted(spark, d):
    """Rates of each hard-case type."""
    s = _scored(spark, d)
    return metrics.targeted_rates(s, F.col("overridden"))


def join_eval_inner(spark, d):
    p, g = _sides(spark, d)
    return metrics.joined(p, g).select("run_id", "id", "prediction_key", "record_key")


def anti_unknown(spark, d):
    p, g = _sides(spark, d)
    return metrics.unknown_predictions(p, g).select("run_id", "id", "prediction_key")


def anti_missing(spark, d):
    p, g = _sides(spark, d)
    return metrics.missing_predictions(p, g)


def prediction_errors(spark, d):
    return metrics.prediction_errors(table(spark, d, "predictions"))


def prediction_contract(spark, d):
    p, g = _sides(spark, d)
    return metrics.contract_errors(metrics.joined(p.where("criterion_scores is not null"), g))


def _scored(spark, d):
    p, g = _sides(spark, d)
    return metrics.score_rows(metrics.joined(p.where("criterion_scores is not null"), g))


def eval_slices(spark, d):
    return metrics.slice_metrics(_scored(spark, d))


def eval_overall(spark, d):
    return metrics.slice_metrics(_scored(spark, d), ()).where("dim = 'overall'").drop("dim", "value")


def eval_hard_cases(spark, d):
    """Signed rates by hard-case type: where scores run over or under."""
    return metrics.slice_metrics(_scored(spark, d), ()).where("dim = 'hard_case_type'").select("value", "records", "criterion_items", "n_over", "n_under", "criterion_bias", "fn")


def eval_boundary_matrix(spark, d):
    p, g = _sides(spark, d)
    return metrics.boundary_matrix(metrics.joined(p.where("criterion_scores is not null"), g))


def error_mining_top10(spark, d):
    return metrics.mine_errors(_scored(spark, d)).drop("abs_error")


_FUNCS = (
    agg_stats, agg_distribution, agg_range_status, agg_coverage_task, agg_coverage_family, agg_rubric_diversity, agg_two_way, alloc_next_batch, alloc_no_deficit,
    agg_report, evaluate_strict, missing_counts, eval_targeted,
    join_eval_inner, anti_unknown, anti_missing, prediction_errors, prediction_contract, eval_slices, eval_overall, eval_hard_cases, eval_boundary_matrix, error_mining_top10,
)
QUERIES = {f.__name__: f for f in _FUNCS}

_V = "v AS (SELECT * FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed)"
_T = "t(axis, category, ratio, pos) AS (VALUES " + ", ".join(f"('{a}', '{c}', CAST({r} AS DOUBLE), {k})" for a, x in STRATEGY.distribution.items() for k, (c, r) in enumerate(x.items())) + ")"
_AXIS = """cnt AS (SELECT axis, category, count(*) AS actual FROM (
  SELECT 'modality' AS axis, coalesce(modality, '<missing>') AS category FROM v UNION ALL SELECT 'grade', coalesce(CAST(grade AS VARCHAR), '<missing>') FROM v
  UNION ALL SELECT 'response_quality', coalesce(metadata.response_quality, '<missing>') FROM v) GROUP BY ALL),
obs AS (SELECT axis, sum(actual) AS observed FROM cnt GROUP BY axis)"""


def _dist(target: int) -> str:
    return f"""{_V}, {_T}, {_AXIS}, dist AS (SELECT t.axis, t.category, t.ratio, t.pos, CAST(coalesce(actual, 0) AS BIGINT) AS actual,
  CAST(round_even({float(target)} * ratio, 0) AS BIGINT) AS target, greatest(0, CAST(round_even({float(target)} * ratio, 0) AS BIGINT) - coalesce(actual, 0)) AS gap,
  coalesce(coalesce(actual, 0) / nullif(CAST(observed AS DOUBLE), 0), 0.0) AS share FROM t LEFT JOIN cnt USING (axis, category) LEFT JOIN obs USING (axis))"""


def _batch(target: int, count: int) -> str:
    low = ", ".join(f"('{k}', CAST({lo} AS DOUBLE))" for k, (lo, _) in STRATEGY.ranges.items())
    return f"""WITH {_dist(target)}, w AS (SELECT *, CASE WHEN sum(gap) OVER (PARTITION BY axis) = 0 THEN ratio ELSE CAST(gap AS DOUBLE) END AS w FROM dist),
r AS (SELECT *, {float(count)} * w / sum(w) OVER (PARTITION BY axis) AS raw FROM w), b AS (SELECT *, floor(raw) AS base FROM r),
l AS (SELECT *, {count} - sum(base) OVER (PARTITION BY axis) AS rest, row_number() OVER (PARTITION BY axis ORDER BY raw - base DESC, w DESC, pos) AS rn FROM b),
low(k, lo) AS (VALUES {low})
SELECT axis, category, CAST(base + CASE WHEN rn <= rest THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM l
UNION ALL SELECT 'special_minimum', k, CAST(round_even({float(count)} * lo, 0) AS BIGINT) FROM low"""


def _cov(key: str, lo: int, hi: int) -> str:
    return f"""WITH {_V}, p AS (SELECT {key} AS k, count(*) AS n FROM v WHERE {key} IS NOT NULL AND {key} <> '' GROUP BY ALL)
SELECT count(*) AS keys, coalesce(avg(n), 0.0) AS mean, count(*) FILTER (n < {lo}) AS below_min, count(*) FILTER (n BETWEEN {lo} AND {hi}) AS in_range, count(*) FILTER (n > {hi}) AS above_max FROM p"""


_RANGE = " UNION ALL ".join(
    f"SELECT '{k}' AS name, count(*) FILTER ({c}) AS n, count(*) AS total, CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high FROM v"
    for (k, (lo, hi)), c in zip(STRATEGY.ranges.items(), ("gold_evaluation.needs_review", "len(metadata.hard_case_types) > 0", "metadata.adversarial", "metadata.review_count >= 2"))
)
_EVAL = """
g AS (SELECT id, arg_max(struct_pack(record_key := record_key, modality := modality, grade := grade, rubric := rubric, gold := gold_evaluation, m := metadata),
      struct_pack(a := ingested_at IS NOT NULL, t := coalesce(ingested_at, TIMESTAMP '1970-01-01'), k := record_key)) AS r FROM records WHERE id IS NOT NULL GROUP BY id),
p AS (SELECT run_id, id, arg_max(struct_pack(prediction_key := prediction_key, s := criterion_scores, nr := needs_review),
      struct_pack(a := produced_at IS NOT NULL, t := coalesce(produced_at, TIMESTAMP '1970-01-01'), k := prediction_key)) AS q FROM predictions WHERE id IS NOT NULL GROUP BY run_id, id)"""
_SCORED = _EVAL + """,
j AS (SELECT p.run_id, p.id, r, q, coalesce(r.gold.needs_review, false) AS gr, coalesce(q.nr, false) AS pr,
      list_filter(r.gold.criterion_results, lambda x: x IS NOT NULL AND x.criterion_id IS NOT NULL AND x.score IS NOT NULL) AS res FROM p JOIN g USING (id) WHERE q.s IS NOT NULL),
e AS (SELECT *, list_filter(list_transform(res, lambda x: q.s[x.criterion_id] - x.score), lambda v: v IS NOT NULL AND NOT isnan(v)) AS errs,
      coalesce(list_sum(list_transform(res, lambda x: coalesce(q.s[x.criterion_id], 0.0))), CASE WHEN r.gold.criterion_results IS NULL THEN NULL ELSE 0.0 END) AS ptotal FROM j),
sc AS (SELECT run_id, id, r.modality AS modality, r.grade AS grade, r.m AS m, gr, pr, NOT gr AS ok,
      CASE WHEN NOT gr THEN len(errs) ELSE 0 END AS items, CASE WHEN NOT gr THEN len(list_filter(errs, lambda v: abs(v) <= 1e-9)) ELSE 0 END AS exact,
      CASE WHEN NOT gr THEN len(list_filter(errs, lambda v: abs(v) <= 1 + 1e-9)) ELSE 0 END AS within_1,
      CASE WHEN NOT gr THEN len(list_filter(errs, lambda v: v > 1e-9)) ELSE 0 END AS over_, CASE WHEN NOT gr THEN len(list_filter(errs, lambda v: v < -1e-9)) ELSE 0 END AS under_,
      CASE WHEN NOT gr THEN CASE WHEN r.gold.criterion_results IS NULL THEN NULL ELSE coalesce(list_sum(list_transform(errs, lambda v: abs(v))), 0.0) END ELSE 0.0 END AS ae, CASE WHEN NOT gr THEN CASE WHEN r.gold.criterion_results IS NULL THEN NULL ELSE coalesce(list_sum(errs), 0.0) END ELSE 0.0 END AS se,
      CASE WHEN NOT gr THEN abs(ptotal - r.gold.total_score) END AS te,
      CASE WHEN NOT gr THEN abs(ptotal - r.gold.total_score) / coalesce(nullif(r.gold.max_score, 0), 1) END AS ne FROM e),
sl AS (SELECT *, unnest(list_concat([struct_pack(dim := 'overall', val := 'all'), struct_pack(dim := 'modality', val := coalesce(modality, '<unclassified>')),
      struct_pack(dim := 'grade', val := coalesce(CAST(grade AS VARCHAR), '<unclassified>')), struct_pack(dim := 'response_quality', val := coalesce(m.response_quality, '<unclassified>')),
      struct_pack(dim := 'question_family', val := coalesce(m.question_family, '<unclassified>')),
      struct_pack(dim := 'hard_case', val := CASE WHEN coalesce(len(m.hard_case_types), 0) > 0 THEN 'hard' ELSE 'normal' END),
      struct_pack(dim := 'adversarial', val := CASE WHEN m.adversarial THEN 'adversarial' ELSE 'plain' END)],
      list_transform(coalesce(m.hard_case_types, []), lambda h: struct_pack(dim := 'hard_case_type', val := coalesce(h, '<unclassified>'))))) AS s FROM sc)"""


def _slices(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    return f"""WITH {_SCORED},
a AS (SELECT {k}s.dim AS dim, s.val AS value, count(*) AS records, count(*) FILTER (ok) AS resolvable_records, CAST(sum(items) AS BIGINT) AS criterion_items,
  CAST(sum(exact) AS BIGINT) AS n_exact, CAST(sum(within_1) AS BIGINT) AS n_within_1, CAST(sum(over_) AS BIGINT) AS n_over, CAST(sum(under_) AS BIGINT) AS n_under, sum(ae) AS ae, sum(se) AS se, count(te) AS totals,
  count(*) FILTER (te <= 1e-9) AS n_total_exact, sum(te) AS te, sum(ne) AS ne, count(*) FILTER (gr AND pr) AS tp, count(*) FILTER (NOT gr AND pr) AS fp,
  count(*) FILTER (gr AND NOT pr) AS fn, count(*) FILTER (NOT gr AND NOT pr) AS tn FROM sl GROUP BY ALL),
b AS (SELECT *, tp / nullif(CAST(tp + fp AS DOUBLE), 0) AS precision, tp / nullif(CAST(tp + fn AS DOUBLE), 0) AS recall FROM a)
SELECT {k}dim, value, records, resolvable_records, criterion_items, n_exact, n_within_1, n_over, n_under, n_total_exact, tp, fp, fn, tn,
  n_exact / nullif(CAST(criterion_items AS DOUBLE), 0) AS criterion_exact_rate, n_within_1 / nullif(CAST(criterion_items AS DOUBLE), 0) AS criterion_within_1_rate,
  round(ae / nullif(CAST(criterion_items AS DOUBLE), 0), 6) AS criterion_mae, round(se / nullif(CAST(criterion_items AS DOUBLE), 0), 6) AS criterion_bias,
  n_total_exact / nullif(CAST(totals AS DOUBLE), 0) AS total_exact_rate, round(te / nullif(CAST(totals AS DOUBLE), 0), 6) AS total_mae,
  round(ne / nullif(CAST(totals AS DOUBLE), 0), 6) AS total_normalized_mae, precision, recall, round(2 * precision * recall / nullif(precision + recall, 0), 9) AS f1,
  (tp + tn) / nullif(CAST(records AS DOUBLE), 0) AS accuracy FROM b"""


_CRIT = "list_filter(r.rubric.criteria, lambda x: x IS NOT NULL AND x.criterion_id IS NOT NULL)"

_MALFORMED = """coalesce(id, '') = '' OR needs_review IS NULL OR criterion_scores IS NULL OR list_contains(map_keys(criterion_scores), '')
  OR len(list_filter(map_values(criterion_scores), lambda v: v IS NULL OR isnan(v) OR isinf(v))) > 0"""

SQL = {
    "agg_stats": """SELECT axis, category, count(*) AS n FROM (SELECT 'total' AS axis, 'all' AS category FROM records UNION ALL SELECT 'modality', coalesce(modality, '<missing>') FROM records
  UNION ALL SELECT 'status', coalesce(metadata.status, '<missing>') FROM records UNION ALL SELECT 'split', coalesce(metadata.split, 'unassigned') FROM records
  UNION ALL SELECT 'verified', 'yes' FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed
  UNION ALL SELECT 'needs_review', 'yes' FROM records WHERE gold_evaluation.needs_review) GROUP BY ALL""",
    "agg_distribution": f"WITH {_dist(STRATEGY.target_records)} SELECT axis, category, ratio, actual, target, gap, share FROM dist",
    "agg_range_status": f"""WITH {_V}, r AS ({_RANGE}) SELECT name, n, total, coalesce(n / nullif(CAST(total AS DOUBLE), 0), 0.0) AS rate, low, high,
  CASE WHEN coalesce(n / nullif(CAST(total AS DOUBLE), 0), 0.0) < low THEN 'under' WHEN coalesce(n / nullif(CAST(total AS DOUBLE), 0), 0.0) > high THEN 'over' ELSE 'in_range' END AS status,
  CAST(round_even({float(STRATEGY.target_records)} * low, 0) AS BIGINT) AS min_count, CAST(round_even({float(STRATEGY.target_records)} * high, 0) AS BIGINT) AS max_count FROM r""",
    "agg_coverage_task": _cov("task.task_id", *STRATEGY.per_task),
    "agg_coverage_family": _cov("metadata.question_family", *STRATEGY.per_family),
    "agg_rubric_diversity": f"WITH {_V} SELECT CAST(coalesce(len(rubric.criteria), 0) AS INTEGER) AS criterion_count, count(*) AS n, count(DISTINCT rubric.rubric_id) AS rubrics FROM v GROUP BY ALL",
    "agg_two_way": f"""WITH {_V}, x AS (SELECT coalesce(modality, '<missing>') AS a, coalesce(metadata.response_quality, '<missing>') AS b FROM v)
SELECT coalesce(a, '<all>') AS a, coalesce(b, '<all>') AS b, count(*) AS n FROM x GROUP BY CUBE (x.a, x.b)""",
    "alloc_next_batch": _batch(STRATEGY.target_records, 500),
    "alloc_no_deficit": _batch(0, 17),
    "join_eval_inner": f"WITH {_EVAL} SELECT run_id, id, q.prediction_key AS prediction_key, r.record_key AS record_key FROM p JOIN g USING (id)",
    "anti_unknown": f"WITH {_EVAL} SELECT run_id, id, q.prediction_key AS prediction_key FROM p WHERE id NOT IN (SELECT id FROM g)",
    "anti_missing": f"WITH {_EVAL} SELECT run_id, id FROM (SELECT DISTINCT run_id FROM p WHERE run_id IS NOT NULL) CROSS JOIN (SELECT id FROM g) EXCEPT SELECT run_id, id FROM p",
    "prediction_errors": """SELECT prediction_key, CASE WHEN coalesce(id, '') = '' THEN 'id' WHEN needs_review IS NULL THEN 'needs_review' WHEN criterion_scores IS NULL THEN 'criterion_scores'
  WHEN list_contains(map_keys(criterion_scores), '') THEN 'criterion_id'
  WHEN len(list_filter(map_values(criterion_scores), lambda v: v IS NULL OR isnan(v) OR isinf(v))) > 0 THEN 'score' END AS error FROM predictions WHERE error IS NOT NULL""",
    "prediction_contract": f"""WITH {_EVAL}, j AS (SELECT run_id, id, r, q, map_keys(q.s) AS got, list_distinct(list_transform({_CRIT}, lambda c: c.criterion_id)) AS want FROM p JOIN g USING (id) WHERE q.s IS NOT NULL),
k AS (SELECT run_id, id, coalesce(array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(got, x))), ','), '') AS missing,
  coalesce(array_to_string(list_sort(list_filter(got, lambda x: NOT list_contains(want, x))), ','), '') AS extra,
  coalesce(array_to_string(list_sort(list_filter(got, lambda x: list_contains(want, x) AND (q.s[x] < 0 OR q.s[x] > list_filter({_CRIT}, lambda c: c.criterion_id = x)[-1].max_score))), ','), '') AS out_of_range FROM j)
SELECT * FROM k WHERE missing <> '' OR extra <> '' OR out_of_range <> ''""",
    "eval_slices": _slices("run_id"),
    "eval_overall": f"SELECT * EXCLUDE (dim, value) FROM ({_slices('')}) WHERE dim = 'overall'",
    "eval_hard_cases": f"SELECT value, records, criterion_items, n_over, n_under, criterion_bias, fn FROM ({_slices('')}) WHERE dim = 'hard_case_type'",
    "eval_boundary_matrix": f"""WITH {_SCORED}, c AS (SELECT unnest(list_transform(res, lambda x: struct_pack(g := x.score, p := q.s[x.criterion_id]))) AS c FROM j WHERE NOT gr)
SELECT c.g AS gold_score, c.p AS predicted_score, count(*) AS n FROM c WHERE c.p IS NOT NULL GROUP BY ALL""",
    "error_mining_top10": f"""WITH {_SCORED}, f AS (SELECT CASE WHEN gr AND NOT pr THEN 'false_confident' WHEN NOT gr AND pr THEN 'needless_review' WHEN te > 1 + 1e-9 THEN 'total_off_by_more_than_1' WHEN te > 1e-9 THEN 'total_off' END AS failure_type,
  coalesce(modality, '<missing>') AS modality, coalesce(CAST(grade AS VARCHAR), '<missing>') AS grade, coalesce(m.question_family, '<missing>') AS question_family,
  array_to_string(list_sort(coalesce(m.hard_case_types, [])), ',') AS hard_case_types FROM sc)
SELECT failure_type, modality, grade, question_family, hard_case_types, count(*) AS n FROM f WHERE failure_type IS NOT NULL GROUP BY ALL
ORDER BY n DESC, failure_type, modality, grade, question_family, hard_case_types LIMIT 10""",
    "evaluate_strict": f"""WITH gt AS (SELECT DISTINCT id FROM records WHERE metadata.split = 'test' AND id IS NOT NULL),
i AS (SELECT run_id, id, count(*) AS n FROM predictions WHERE id <> '' GROUP BY ALL),
x AS (SELECT run_id, 'malformed' AS problem, coalesce(nullif(id, ''), '#' || prediction_key) AS id FROM predictions WHERE {_MALFORMED}
  UNION ALL SELECT run_id, 'duplicate', id FROM i WHERE n > 1 UNION ALL SELECT run_id, 'unknown', id FROM i WHERE id NOT IN (SELECT id FROM gt)
  UNION ALL (SELECT run_id, 'missing', id FROM (SELECT DISTINCT run_id FROM predictions WHERE run_id IS NOT NULL) CROSS JOIN gt EXCEPT SELECT run_id, 'missing', id FROM predictions))
SELECT run_id, problem, count(*) AS n, array_to_string(list_sort(list(id))[1:10], ',') AS first_ids FROM x GROUP BY run_id, problem""",
    "missing_counts": f"""WITH {_EVAL} SELECT a.run_id, (SELECT count(*) FROM g) - (SELECT count(DISTINCT p.id) FROM p JOIN g USING (id) WHERE p.run_id = a.run_id) AS n_missing
FROM (SELECT DISTINCT run_id FROM p WHERE run_id IS NOT NULL) a""",
    "eval_targeted": f"""WITH {_SCORED}, h AS (SELECT sc.*, unnest(m.hard_case_types) AS hard_case_type,
  ok AND coalesce(e.r.gold.max_score, 0) > 0 AND coalesce(e.ptotal, -1) >= e.r.gold.max_score - 1e-9 AND coalesce(e.r.gold.total_score < e.r.gold.max_score - 1e-9, false) AS full_marks FROM sc JOIN e USING (run_id, id))
SELECT hard_case_type, count(*) AS records, CAST(sum(items) AS BIGINT) AS items, sum(under_) / nullif(CAST(sum(items) AS DOUBLE), 0) AS under_rate, sum(over_) / nullif(CAST(sum(items) AS DOUBLE), 0) AS over_rate,
  count(*) FILTER (pr) / CAST(count(*) AS DOUBLE) AS review_rate, count(*) FILTER (full_marks) / CAST(count(*) AS DOUBLE) AS override_rate FROM h GROUP BY hard_case_type""",
    "agg_report": f"""WITH {_dist(STRATEGY.target_records)}, r AS ({_RANGE}), rt AS (SELECT *, coalesce(n / nullif(CAST(total AS DOUBLE), 0), 0.0) AS rate FROM r),
cov AS (SELECT 'exact_tasks' AS name, * FROM ({_cov("task.task_id", *STRATEGY.per_task)}) UNION ALL SELECT 'question_families', * FROM ({_cov("metadata.question_family", *STRATEGY.per_family)}))
SELECT 'total' AS section, 'verified_records' AS name, 'all' AS category, CAST(count(*) AS DOUBLE) AS value, {float(STRATEGY.target_records)}::DOUBLE AS target, CASE WHEN count(*) >= {STRATEGY.target_records} THEN 'reached' ELSE 'open' END AS status FROM v
UNION ALL SELECT 'verification_source', 'verification_source', coalesce(nullif(metadata.verification_source, ''), '<missing>'), count(*), NULL, NULL FROM v GROUP BY ALL
UNION ALL SELECT 'distribution', axis, category, actual, target, CASE WHEN gap > 0 THEN 'under' ELSE 'reached' END FROM dist
UNION ALL SELECT 'range', name, 'rate', rate, low, CASE WHEN rate < low THEN 'under' WHEN rate > high THEN 'over' ELSE 'in_range' END FROM rt
UNION ALL SELECT 'coverage', name, unnest(['keys', 'mean', 'below_min', 'in_range', 'above_max']), unnest([CAST(keys AS DOUBLE), mean, below_min, in_range, above_max]), NULL, NULL FROM cov
UNION ALL SELECT 'rubric', 'criterion_count', CAST(coalesce(len(rubric.criteria), 0) AS VARCHAR), count(*), count(DISTINCT rubric.rubric_id), NULL FROM v GROUP BY ALL""",
}
