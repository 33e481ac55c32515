"""Queries of the rule sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import links, rules
from ..storage import spread
from .tables import table


def _records(spark, d):
    return table(spark, d, "records")


def rule_findings(spark, d):
    """Every consistency finding of a record."""
    found = rules.apply_rules(spread(_records(spark, d)), "record_key", rules.record_rules())
    return found.select("record_key", "level", "code")


def rule_details(spark, d):
    """Texts of the findings that name criteria or scores."""
    found = rules.apply_rules(_records(spark, d), "record_key", [r for r in rules.record_rules() if r.code in ("criterion_result_mismatch", "criterion_score_overflow", "missing_nontext_observation", "filename_id_mismatch")])
    return found.select("record_key", "code", "detail")


def rule_counts(spark, d):
    return rule_findings(spark, d).groupBy("level", "code").agg(F.count("*").alias("n"))


def rule_possible_pii(spark, d):
    found = rules.apply_rules(_records(spark, d), "record_key", [r for r in rules.record_rules() if r.code == "possible_pii"])
    return found.select("record_key", "detail")


def rule_duplicate_id(spark, d):
    return rules.duplicate_ids(_records(spark, d), "record_key").select("record_key", F.col("detail").alias("first_path"))


def policy_findings(spark, d):
    return rules.apply_rules(rules.verified_status(_records(spark, d)), "record_key", rules.policy_rules()).select("record_key", "level", "code", "detail")


def findings_union(spark, d):
    """Validation, policy and leakage findings together, counted by code."""
    rec = _records(spark, d)
    parts = rules.apply_rules(spread(rec), "record_key", rules.record_rules())
    parts = parts.unionByName(rules.duplicate_ids(rec, "record_key")).unionByName(rules.apply_rules(rules.verified_status(rec), "record_key", rules.policy_rules()))
    parts = parts.unionByName(rules.leakage_findings(links.leakage(rec)))
    return parts.groupBy("level", "code").agg(F.count("*").alias("n"))


def finding_lines(spark, d):
    """Rendered duplicate-id findings."""
    return rules.render(rules.duplicate_ids(_records(spark, d), "record_key"))


def type_findings(spark, d):
    return rules.type_findings(table(spark, d, "raw_records"), "raw_id", "payload")


def schema_findings(spark, d):
    """Errors of the typed rubrics against the JSON schema."""
    return rules.apply_rules(_records(spark, d), "record_key", rules.rubric_schema_rules())


def schema_raw_findings(spark, d):
    """The same of the payloads as delivered, with wrong types and unknown members."""
    return rules.raw_schema_findings(table(spark, d, "raw_records"), "raw_id", "payload")


def schema_prediction_findings(spark, d):
    return rules.apply_rules(table(spark, d, "predictions"), "prediction_key", rules.prediction_schema_rules())


QUERIES = {f.__name__: f for f in (rule_findings, rule_details, rule_counts, rule_possible_pii, rule_duplicate_id, policy_findings, findings_union, finding_lines, type_findings, schema_findings, schema_raw_findings, schema_prediction_findings)}

_SUM_C = "coalesce(list_sum(list_transform(list_filter(rubric.criteria, lambda x: x IS NOT NULL), lambda x: coalesce(x.max_score, 0))), 0)"
_SUM_R = "coalesce(list_sum(list_transform(list_filter(gold_evaluation.criterion_results, lambda x: x IS NOT NULL), lambda x: coalesce(x.score, 0))), 0)"
_C = "list_filter(rubric.criteria, lambda x: x IS NOT NULL)"
_R = "list_filter(gold_evaluation.criterion_results, lambda x: x IS NOT NULL)"
_BLANK = "(review IS NULL OR regexp_replace(review, '^\\s+|\\s+$', '', 'g') = '')"
# the same signs without look-around: a neighbour that is no letter or digit instead of a word boundary
_W = "[^\\p{L}\\p{N}_]"
_STRINGS = """' ' || replace(to_json(struct_pack(id, schema_version, modality, language, task, rubric, student_response, gold_evaluation, metadata)), '\\n', ' ') || ' '"""
_SIGN_SQL = {
    "email": f"(?i){_W}[A-Z0-9._%+-]*[\\p{{L}}\\p{{N}}_.%+-]@[A-Z0-9.-]+\\.[A-Z]{{2,}}{_W}",
    "okul_numarasi_etiketi": f"(?i){_W}(okul|öğrenci)\\s*(no|numara|numarası){_W}",
    "tc_kimlik_etiketi": f"(?i){_W}(kimlik|kimlik\\s*no|tc\\s*no){_W}",
    "telefon": "[^\\d](\\+?90\\s*)?(0?\\s*)?5\\d{2}[\\s.-]?\\d{3}[\\s.-]?\\d{2}[\\s.-]?\\d{2}[^\\d]",
}
_PII = "SELECT record_key, " + "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in _SIGN_SQL.items()) + f"], lambda x: x IS NOT NULL) AS signs FROM (SELECT record_key, {_STRINGS} AS t FROM records)"
_RULES = f"""
base AS (SELECT *, {_C} AS cs, {_R} AS rs, gold_evaluation.review_reason AS review, {_SUM_C} AS sum_c, {_SUM_R} AS sum_r FROM records),
ids AS (SELECT record_key, unnest(list_transform(cs, lambda x: coalesce(x.criterion_id, chr(0)))) AS cid FROM base),
rids AS (SELECT record_key, unnest(list_transform(rs, lambda x: coalesce(x.criterion_id, chr(0)))) AS cid FROM base),
dup_c AS (SELECT record_key FROM ids GROUP BY record_key HAVING count(*) <> count(DISTINCT cid)),
dup_r AS (SELECT record_key FROM rids GROUP BY record_key HAVING count(*) <> count(DISTINCT cid)),
mis AS (SELECT DISTINCT record_key FROM ((SELECT * FROM ids EXCEPT SELECT * FROM rids) UNION ALL (SELECT * FROM rids EXCEPT SELECT * FROM ids))
        JOIN base USING (record_key) WHERE len(cs) > 0 AND len(rs) > 0),
lim AS (SELECT record_key, c.criterion_id AS cid, arg_max(struct_pack(m := c.max_score), pos).m AS m FROM (SELECT record_key, unnest(cs) AS c, unnest(range(len(cs))) AS pos FROM base) WHERE c.criterion_id IS NOT NULL GROUP BY ALL),
over_ AS (SELECT record_key FROM (SELECT record_key, unnest(rs) AS r FROM base) b JOIN lim USING (record_key) WHERE lim.cid = b.r.criterion_id AND b.r.score > lim.m + 1e-9),
non AS (SELECT record_key FROM (SELECT record_key, unnest(cs) AS c, student_response.observations AS o FROM base) WHERE coalesce(len(o), 0) = 0 AND list_has_any(c.evidence_sources, ['audio_delivery', 'teacher_observation'])),
found AS (
 SELECT record_key, 'error' AS level, 'duplicate_criterion_id' AS code FROM dup_c
 UNION ALL SELECT record_key, 'error', 'duplicate_result_id' FROM dup_r
 UNION ALL SELECT record_key, 'error', 'criterion_result_mismatch' FROM mis
 UNION ALL SELECT record_key, 'error', 'criterion_score_overflow' FROM over_
 UNION ALL SELECT record_key, 'warning', 'missing_nontext_observation' FROM non
 UNION ALL SELECT record_key, 'error', 'rubric_task_max_mismatch' FROM base WHERE len(cs) > 0 AND abs(sum_c - task.max_score) > 1e-9
 UNION ALL SELECT record_key, 'error', 'task_gold_max_mismatch' FROM base WHERE abs(task.max_score - gold_evaluation.max_score) > 1e-9
 UNION ALL SELECT record_key, 'error', 'total_score_mismatch' FROM base WHERE len(rs) > 0 AND abs(sum_r - gold_evaluation.total_score) > 1e-9
 UNION ALL SELECT record_key, 'error', 'total_score_overflow' FROM base WHERE gold_evaluation.total_score > gold_evaluation.max_score + 1e-9
 UNION ALL SELECT record_key, 'error', 'review_reason_required' FROM base WHERE gold_evaluation.needs_review AND {_BLANK}
 UNION ALL SELECT record_key, 'warning', 'unexpected_review_reason' FROM base WHERE NOT gold_evaluation.needs_review AND NOT {_BLANK}
 UNION ALL SELECT record_key, 'error', 'verified_without_pii_review' FROM base WHERE metadata.status = 'teacher_verified' AND metadata.pii_reviewed IS NOT TRUE
 UNION ALL SELECT record_key, 'error', 'filename_id_mismatch' FROM base WHERE regexp_extract(file_path, '([^/]+?)(?:\\.[^./]*)?$', 1) <> id
 UNION ALL SELECT record_key, 'warning', 'possible_pii' FROM ({_PII}) WHERE len(signs) > 0
 UNION ALL SELECT record_key, 'error', 'modality_folder_mismatch' FROM base WHERE modality IN ('written', 'speaking', 'listening') AND regexp_extract(file_path, '([^/]+)/[^/]+$', 1) <> modality)
"""
_DUP = "dup AS (SELECT record_key, row_number() OVER w AS n, first_value(file_path) OVER w AS first_path FROM records WHERE id IS NOT NULL WINDOW w AS (PARTITION BY id ORDER BY file_path, record_key))"
_QUAL = "('full_correct','high_partial','mid_partial','low_partial','incorrect','blank_irrelevant','borderline')"
_HARD = "['correct_result_wrong_reason','wrong_result_valid_method','mixed_criterion_performance','long_irrelevant','short_correct','keyword_decoy','rubric_extra_info','paraphrase_equivalent','contradictory_answer','prompt_injection','ocr_ambiguity','stt_ambiguity','missing_evidence','rubric_ambiguity']"
_POLICY = f"""
v AS (SELECT record_key, metadata AS m, task.task_id AS t, coalesce(gold_evaluation.needs_review, false) AS nr, coalesce(metadata.review_count, 0) AS rc,
      coalesce(metadata.hard_case_types, []) AS h, coalesce(metadata.adversarial, false) AS adv,
      list_sort(list_filter(list_distinct(coalesce(metadata.hard_case_types, [])), lambda x: NOT list_contains({_HARD}, x))) AS bad
      FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified')),
pol AS (
 SELECT record_key, 'error' AS level, 'verification_source_mismatch' AS code, m.verification_source AS detail FROM v WHERE (CASE WHEN m.status = 'ai_verified' THEN 'ai' ELSE 'teacher' END) IS DISTINCT FROM m.verification_source
 UNION ALL SELECT record_key, 'error', 'production_task_id_required', NULL FROM v WHERE t IS NULL OR regexp_replace(t, '^\\s+|\\s+$', '', 'g') = ''
 UNION ALL SELECT record_key, 'error', 'response_quality_required', m.response_quality FROM v WHERE m.response_quality IS NULL OR m.response_quality NOT IN {_QUAL}
 UNION ALL SELECT record_key, 'error', 'hard_case_types_required', NULL FROM v WHERE m.hard_case_types IS NULL
 UNION ALL SELECT record_key, 'error', 'invalid_hard_case_type', array_to_string(bad, ', ') FROM v WHERE len(bad) > 0
 UNION ALL SELECT record_key, 'error', 'adversarial_required', NULL FROM v WHERE m.adversarial IS NULL
 UNION ALL SELECT record_key, 'error', 'review_count_required', NULL FROM v WHERE m.review_count IS NULL
 UNION ALL SELECT record_key, 'error', 'insufficient_review_count', NULL FROM v WHERE m.review_count < 1
 UNION ALL SELECT record_key, 'error', 'adjudicated_required', NULL FROM v WHERE m.adjudicated IS NULL
 UNION ALL SELECT record_key, 'error', 'evaluation_split_requires_dual_review', m.split FROM v WHERE m.split IN ('validation', 'test', 'benchmark') AND rc < 2
 UNION ALL SELECT record_key, 'error', 'borderline_requires_dual_review', NULL FROM v WHERE m.response_quality = 'borderline' AND rc < 2
 UNION ALL SELECT record_key, 'error', 'needs_review_requires_dual_review', NULL FROM v WHERE nr AND rc < 2
 UNION ALL SELECT record_key, 'warning', 'adversarial_without_hard_case', NULL FROM v WHERE adv AND len(h) = 0
 UNION ALL SELECT record_key, 'error', 'prompt_injection_must_be_adversarial', NULL FROM v WHERE list_contains(h, 'prompt_injection') AND NOT adv
 UNION ALL SELECT record_key, 'warning', 'ambiguity_without_review_target', NULL FROM v WHERE list_has_any(h, ['missing_evidence', 'rubric_ambiguity']) AND NOT nr)
"""
_LINKS = """
lk AS (SELECT record_key, metadata.split AS split, 'task_id' AS field, task.task_id AS value FROM records
  UNION ALL SELECT record_key, metadata.split, 'subject_group_id', metadata.subject_group_id FROM records
  UNION ALL SELECT record_key, metadata.split, 'exam_family', metadata.exam_family FROM records
  UNION ALL SELECT record_key, metadata.split, 'question_family', metadata.question_family FROM records),
leak AS (SELECT field, value, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(DISTINCT split) AS n_splits FROM lk
  WHERE value IS NOT NULL AND value <> '' AND split IS NOT NULL GROUP BY field, value HAVING count(DISTINCT split) > 1)
"""

SQL = {
    "rule_findings": f"WITH {_RULES} SELECT * FROM found",
    "rule_possible_pii": f"SELECT record_key, array_to_string(signs, ', ') AS detail FROM ({_PII}) WHERE len(signs) > 0",
    "rule_details": f"""WITH {_RULES}, m AS (SELECT record_key, 'missing=' || array_to_string(list_sort(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))), ',') || ' extra=' || array_to_string(list_sort(list_filter(list_distinct(b), lambda x: NOT list_contains(a, x))), ',') AS detail
  FROM (SELECT record_key, list_transform(cs, lambda x: coalesce(x.criterion_id, chr(0))) AS a, list_transform(rs, lambda x: coalesce(x.criterion_id, chr(0))) AS b FROM base) JOIN mis USING (record_key)),
o AS (SELECT record_key, b.r.criterion_id || ': ' || regexp_replace(CAST(b.r.score AS VARCHAR), '\\.0$', '') AS detail FROM (SELECT record_key, unnest(rs) AS r FROM base) b JOIN lim USING (record_key) WHERE lim.cid = b.r.criterion_id AND b.r.score > lim.m + 1e-9)
SELECT record_key, 'criterion_result_mismatch' AS code, detail FROM m UNION ALL SELECT record_key, 'criterion_score_overflow', detail FROM o
UNION ALL SELECT record_key, 'missing_nontext_observation', c.criterion_id FROM (SELECT record_key, unnest(cs) AS c, student_response.observations AS o FROM base) WHERE coalesce(len(o), 0) = 0 AND list_has_any(c.evidence_sources, ['audio_delivery', 'teacher_observation'])
UNION ALL SELECT record_key, 'filename_id_mismatch', regexp_extract(file_path, '([^/]+?)(?:\\.[^./]*)?$', 1) FROM base WHERE regexp_extract(file_path, '([^/]+?)(?:\\.[^./]*)?$', 1) <> id""",
    "rule_counts": f"WITH {_RULES} SELECT level, code, count(*) AS n FROM found GROUP BY level, code",
    "rule_duplicate_id": f"WITH {_DUP} SELECT record_key, first_path FROM dup WHERE n > 1",
    "policy_findings": f"WITH {_POLICY} SELECT * FROM pol",
    "findings_union": f"""WITH {_RULES}, {_DUP}, {_POLICY}, {_LINKS}, every AS (SELECT level, code FROM found UNION ALL SELECT level, code FROM pol
      UNION ALL SELECT 'error', 'duplicate_record_id' FROM dup WHERE n > 1 UNION ALL SELECT 'error', 'split_leakage' FROM leak)
      SELECT level, code, count(*) AS n FROM every GROUP BY level, code""",
    "finding_lines": f"WITH {_DUP} SELECT 'ERROR   duplicate_record_id: ' || first_path AS line FROM dup WHERE n > 1",
}
