"""Queries of links, splits, materialisation, review, export and model output."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import export, links, materialize, predictions, quota, review, rules, split
from .tables import table

SEED = "gradeloom-1"


def _records(spark, d):
    return table(spark, d, "records")


def link_components(spark, d):
    return links.record_components(_records(spark, d), "record_key")


def link_leakage(spark, d):
    return links.leakage(_records(spark, d))


def link_bench_isolation(spark, d):
    return links.benchmark_collisions(_records(spark, d), "record_key")


def link_explode(spark, d):
    return links.explode_links(_records(spark, d), "record_key")


def _members(spark, d):
    rec = quota.verified(_records(spark, d)).where(F.coalesce(F.col("metadata.split") != "benchmark", F.lit(True)))
    comp = links.record_components(rec, "record_key")
    return rec.join(comp, "record_key")


def split_hash(spark, d):
    """The hash cut of components, existing splits set aside."""
    m = _members(spark, d).select("component", F.lit(None).cast("string").alias("split"))
    return split.hash_cut(m, 0.8, 0.1, SEED).select("component", "n", "split")


def split_hash_keep(spark, d):
    """The hash cut with existing splits kept; mixed components are conflicts."""
    m = _members(spark, d).select("component", F.col("metadata.split").alias("split"))
    return split.hash_cut(m, 0.8, 0.1, SEED)


def split_balanced(spark, d):
    return split.balanced_split(_members(spark, d), 0.8, 0.1, SEED, rebalance=True)


def split_manifest(spark, d):
    m = _members(spark, d)
    cut = split.hash_cut(m.select("component", F.lit(None).cast("string").alias("split")), 0.8, 0.1, SEED).select("component", F.col("split").alias("to"))
    rows = m.select("id", "component").join(cut, "component").select("id", F.col("to").alias("split"))
    return split.split_manifest(rows, "id", SEED, "hash-cut").drop("digest")


def _results(spark, d):
    r = _records(spark, d).select("record_key", F.col("student_response.text").alias("text"), "rubric", F.explode("gold_evaluation.criterion_results").alias("r")).where("r is not null")
    c = F.element_at(F.filter("rubric.criteria", lambda x: x["criterion_id"] == F.col("r.criterion_id")), -1)
    return r.select("record_key", "text", F.col("r.criterion_id").alias("criterion_id"), F.col("r.score").alias("score"), c.alias("c"))


def mat_evidence(spark, d):
    r = _results(spark, d)
    return r.select("record_key", "criterion_id", "score", F.array_join(materialize.evidence_for(F.col("text"), F.col("criterion_id"), F.col("score")), " | ").alias("evidence"))


def mat_justification(spark, d):
    r = _results(spark, d).where("c is not null and score is not null")
    return r.select("record_key", "criterion_id", "score", materialize.justification(F.col("c.name"), F.col("criterion_id"), F.col("c.scoring_anchors"), F.col("score")).alias("justification"))


def anchor_nearest(spark, d):
    r = _results(spark, d).where("c is not null and score is not null")
    return r.select("record_key", "criterion_id", "score", materialize.anchor_for(F.col("c.scoring_anchors"), F.col("score")).alias("anchor"))


def feedback_band(spark, d):
    g = F.col("gold_evaluation")
    return _records(spark, d).select("record_key", materialize.feedback(g["total_score"], g["max_score"], g["needs_review"]).alias("feedback"))


def next_record_id(spark, d):
    return materialize.next_record_id(_records(spark, d))


def serial_running(spark, d):
    r = _records(spark, d).select("record_key", "modality", "grade", "file_path")
    return materialize.running_serial(r, ["modality"], ["file_path", "record_key"]).select("record_key", "modality", "serial")


def positional_scores(spark, d):
    """Score maps by place, overlaid with the corrections of the id, key by key."""
    r = _records(spark, d).select("record_key", "id", F.transform("rubric.criteria", lambda c: F.struct(F.coalesce(c["criterion_id"], F.lit("?")).alias("criterion_id"))).alias("c"), F.transform("gold_evaluation.criterion_results", lambda x: x["score"]).alias("s"))
    unique = r.where((F.size("c") > 0) & (F.size("s") > 0) & (F.size("c") == F.size(F.array_distinct("c"))))
    fix = review.latest_corrections(table(spark, d, "review_corrections")).select("id", F.to_json(F.struct("scores")).alias("raw"))
    m = materialize.merge_scores(materialize.positional_scores(F.col("c"), F.col("s")), F.col("raw"))
    e = unique.join(fix, "id", "left").select("record_key", F.explode(F.map_entries(m)).alias("e"))
    return e.select("record_key", F.col("e.key").alias("criterion_id"), F.col("e.value").alias("score"))


def _applied(spark, d):
    return review.apply_review(_records(spark, d), review.latest_corrections(table(spark, d, "review_corrections")))


def review_apply(spark, d):
    a = _applied(spark, d)
    return a.select("record_key", F.col("gold_evaluation.total_score").alias("total_score"), F.col("metadata.review_count").alias("review_count"), F.col("metadata.response_quality").alias("response_quality"), "changed_scores", "changed_quality", "review_error")


def review_summary(spark, d):
    return review.review_summary(_applied(spark, d))


def review_unmatched(spark, d):
    return review.unmatched(table(spark, d, "review_corrections"), _records(spark, d), ("validation", "test"))


def sft_messages(spark, d):
    """Roles, sizes and label columns of the training rows."""
    r = export.sft_rows(_records(spark, d))
    return r.select("id", "split", F.size("messages").alias("n_messages"), F.element_at("messages", -1)["role"].alias("last_role"), F.col("metadata.task_id").alias("task_id"), F.col("metadata.rubric_id").alias("rubric_id"), F.col("metadata.adversarial").alias("adversarial"), F.contains(F.col("messages")[1]["content"], F.lit('"task_id"')).alias("leaks_task_id"), F.sha2(F.concat_ws("|", F.get_json_object(F.col("messages")[1]["content"], "$.task.prompt"), F.get_json_object(F.col("messages")[1]["content"], "$.student_response.text"), F.get_json_object(F.col("messages")[2]["content"], "$.overall_feedback")), 256).alias("digest"))


def sft_chat_lines(spark, d):
    return export.chat_only(export.sft_rows(_records(spark, d))).groupBy("ok").agg(F.count("*").alias("n"))


def sft_legacy_counts(spark, d):
    """Rows per split with and without those whose gold needs review."""
    a = export.sft_rows(_records(spark, d)).groupBy("split").agg(F.count("*").alias("n_all"))
    b = export.sft_rows(_records(spark, d), keep_review=False).groupBy("split").agg(F.count("*").alias("n_kept"))
    return a.join(b, "split", "left")


def json_outputs(spark, d):
    """Delivered payloads read as if they were model output: what parses and what is wrong with the rest."""
    p = table(spark, d, "raw_records").select("raw_id", F.concat(F.lit("```json\n"), "payload", F.lit("\n```")).alias("text"))
    return predictions.parse_outputs(p, "raw_id", "text").groupBy("error").agg(F.count("*").alias("n"))


def json_extract_fence(spark, d):
    p = table(spark, d, "raw_records").select("raw_id", F.concat(F.lit("Cevap: "), "payload", F.lit(" son")).alias("text"))
    return p.select("raw_id", F.sha2(predictions.json_object_text(F.col("text")), 256).alias("digest"))


def str_sentences(spark, d):
    t = _records(spark, d).select("record_key", F.posexplode(T.sentences(F.col("student_response.text"))).alias("pos", "sentence"))
    return t.select("record_key", "pos", "sentence")


def str_clip(spark, d):
    """Answers clipped as evidence is, at 180 code points."""
    return _records(spark, d).where("student_response.text is not null").select("record_key", T.clip(F.col("student_response.text"), 180).alias("clipped"))


def sha_signature(spark, d):
    return _records(spark, d).select("record_key", F.sha2(F.concat(F.lit(SEED + ":"), F.col("file_path")), 256).alias("digest"), F.round(T.stable_unit(F.col("file_path"), SEED), 9).alias("unit"))


def evidence_literal(spark, d):
    return rules.ungrounded_evidence(_records(spark, d), "record_key")


def uncertainty_grounding(spark, d):
    return rules.ungrounded_uncertainties(_records(spark, d), "record_key")


def answer_diagnostics(spark, d):
    return rules.diagnostic_prose(_records(spark, d), "record_key")


def answer_density(spark, d):
    """Families without 20 answers and tasks without 10."""
    return quota.density(_records(spark, d), 20, 10)


def canonical_summary(spark, d):
    return quota.canonical_summary(_records(spark, d))


def duplicate_answers(spark, d):
    r = _records(spark, d).select(F.col("student_response.text").alias("t")).where("t is not null and t <> ''")
    return r.groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select(F.sha2("t", 256).alias("digest"), "n")


_FUNCS = (
    link_components, link_leakage, link_bench_isolation, link_explode, split_hash, split_hash_keep, split_balanced, split_manifest, mat_evidence, mat_justification, anchor_nearest,
    feedback_band, next_record_id, serial_running, positional_scores, review_apply, review_summary, review_unmatched, sft_messages, sft_chat_lines, sft_legacy_counts, json_outputs,
    json_extract_fence, str_sentences, str_clip, answer_diagnostics, answer_density, canonical_summary, sha_signature, evidence_literal, uncertainty_grounding, duplicate_answers,
)
QUERIES = {f.__name__: f for f in _FUNCS}

_LINKS = """lk AS (SELECT record_key, split, field, value FROM (
  SELECT record_key, metadata.split AS split, 'task_id' AS field, task.task_id AS value FROM {0}
  UNION ALL SELECT record_key, metadata.split, 'subject_group_id', metadata.subject_group_id FROM {0}
  UNION ALL SELECT record_key, metadata.split, 'exam_family', metadata.exam_family FROM {0}
  UNION ALL SELECT record_key, metadata.split, 'question_family', metadata.question_family FROM {0}) WHERE value IS NOT NULL AND value <> '')"""
_COMP = """star AS (SELECT record_key, min(field || '=' || value) AS a FROM lk GROUP BY record_key),
edge AS (SELECT DISTINCT a, field || '=' || value AS b FROM star JOIN lk USING (record_key)), two AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT DISTINCT a AS node, a AS lab FROM two UNION SELECT t.b, r.lab FROM reach r JOIN two t ON t.a = r.node WHERE r.lab < t.b),
lab AS (SELECT node, min(lab) AS lab FROM reach GROUP BY node),
comp AS (SELECT r.record_key, coalesce(lab.lab, 'id=' || CAST(r.record_key AS VARCHAR)) AS component FROM {0} r LEFT JOIN star USING (record_key) LEFT JOIN lab ON lab.node = star.a)"""
_ELIG = "elig AS (SELECT * FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed AND coalesce(metadata.split <> 'benchmark', true))"
_UNIT = f"('0x' || substr(sha256('{SEED}:' || {{0}}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0"
_CUT = f"CASE WHEN {_UNIT.format('component')} < 0.8 THEN 'train' WHEN {_UNIT.format('component')} < 0.8 + 0.1 THEN 'validation' ELSE 'test' END"
_RES = """res AS (SELECT record_key, student_response.text AS text, rubric, unnest(gold_evaluation.criterion_results) AS r FROM records),
rc AS (SELECT record_key, text, r.criterion_id AS criterion_id, r.score AS score, list_filter(rubric.criteria, lambda x: x.criterion_id = r.criterion_id)[-1] AS c FROM res WHERE r IS NOT NULL)"""
_NUM = "regexp_replace(CAST({0} AS VARCHAR), '\\.0$', '')"
_ANCHOR = "list_sort(list_transform(list_filter(c.scoring_anchors, lambda a: a IS NOT NULL), lambda a, i: struct_pack(d := abs(coalesce(a.score, 0) - score), i := i, t := a.description)))[1].t"
_SENT = "list_filter(list_transform(string_split(regexp_replace(regexp_replace({0}, '([.!?])\\s+', '\\1' || chr(1), 'g'), '\\s*/\\s*', chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"
_CLIP = "CASE WHEN length({0}) <= {1} THEN {0} ELSE regexp_replace(substr({0}, 1, {1} - 1), '\\s+$', '') || '…' END"
_FB = "CASE WHEN g.needs_review THEN '" + materialize.FEEDBACK_UNCLEAR + "' " + " ".join(f"WHEN coalesce(g.total_score / nullif(g.max_score, 0), 0) >= {a} THEN '{t}'" for a, t in materialize.FEEDBACK_BATCH) + f" WHEN g.total_score > 0 THEN '{materialize.FEEDBACK_SOME}' ELSE '{materialize.FEEDBACK_NONE}' END"
_CORR = "corr AS (SELECT id, arg_max(struct_pack(s := scores, q := response_quality), struct_pack(a := reviewed_at IS NOT NULL, t := coalesce(reviewed_at, TIMESTAMP '1970-01-01'), k := correction_key)) AS c FROM review_corrections WHERE id IS NOT NULL GROUP BY id)"
_APPLIED = f"""WITH {_CORR}, j AS (SELECT r.*, corr.c AS c, corr.id IS NOT NULL AS corrected, coalesce(map_entries(corr.c.s), []) AS asked FROM records r LEFT JOIN corr USING (id) WHERE metadata.split IN ('validation', 'test')),
e AS (SELECT *, array_to_string(list_sort(list_transform(list_filter(asked, lambda a: NOT coalesce(a.value >= 0 AND a.value <= list_filter(rubric.criteria, lambda x: x.criterion_id = a.key)[-1].max_score, false)), lambda a: a.key)), ',') AS bad FROM j),
f AS (SELECT *, nullif(bad, '') AS review_error, corrected AND bad = '' AS ok FROM e),
g AS (SELECT *, list_filter(gold_evaluation.criterion_results, lambda x: x IS NOT NULL) AS rs FROM f),
applied AS (SELECT record_key, corrected, review_error,
  CASE WHEN ok THEN coalesce(list_sum(list_transform(rs, lambda x: coalesce(CASE WHEN list_contains(map_keys(c.s), x.criterion_id) THEN c.s[x.criterion_id] ELSE x.score END, 0))), 0.0) ELSE gold_evaluation.total_score END AS total_score,
  CAST(greatest(2, coalesce(metadata.review_count, 0)) AS INTEGER) AS review_count, CASE WHEN ok AND c.q IS NOT NULL THEN c.q ELSE metadata.response_quality END AS response_quality,
  CAST(CASE WHEN ok THEN coalesce(len(list_filter(rs, lambda x: coalesce(list_contains(map_keys(c.s), x.criterion_id), false) AND c.s[x.criterion_id] IS DISTINCT FROM x.score)), 0) ELSE 0 END AS INTEGER) AS changed_scores,
  CAST(coalesce(ok AND c.q IS NOT NULL AND c.q IS DISTINCT FROM metadata.response_quality, false) AS INTEGER) AS changed_quality FROM g)"""

SQL = {
    "link_components": f"WITH RECURSIVE {_LINKS.format('records')}, {_COMP.format('records')} SELECT * FROM comp",
    "link_leakage": f"WITH {_LINKS.format('records')} SELECT field, value, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(DISTINCT split) AS n_splits FROM lk WHERE split IS NOT NULL GROUP BY field, value HAVING count(DISTINCT split) > 1",
    "link_bench_isolation": f"WITH {_LINKS.format('records')}, b AS (SELECT DISTINCT field, value FROM lk WHERE split = 'benchmark') SELECT DISTINCT record_key FROM lk JOIN b USING (field, value) WHERE coalesce(split <> 'benchmark', true)",
    "link_explode": f"WITH {_LINKS.format('records')} SELECT record_key, field, value FROM lk",
    "split_hash": f"WITH RECURSIVE {_ELIG}, {_LINKS.format('elig')}, {_COMP.format('elig')} SELECT component, count(*) AS n, {_CUT} AS split FROM comp GROUP BY component",
    "split_hash_keep": f"""WITH RECURSIVE {_ELIG}, {_LINKS.format('elig')}, {_COMP.format('elig')}, x AS (SELECT component, count(*) AS n, count(DISTINCT metadata.split) AS k, max(metadata.split) AS s FROM comp JOIN elig USING (record_key) GROUP BY component)
SELECT component, n, CASE WHEN k <= 1 THEN coalesce(s, {_CUT}) END AS split, k > 1 AS conflict FROM x""",
    "split_manifest": f"""WITH RECURSIVE {_ELIG}, {_LINKS.format('elig')}, {_COMP.format('elig')} SELECT {_CUT} AS split, '{SEED}' AS seed, 'hash-cut' AS algorithm, count(*) AS n, min(id) AS first_id, max(id) AS last_id
FROM comp JOIN elig USING (record_key) GROUP BY ALL""",
    "mat_evidence": f"""WITH {_RES}, s AS (SELECT *, {_SENT.format('text')} AS parts FROM rc), p AS (SELECT *, CASE WHEN len(parts) > 0 THEN parts ELSE [text] END AS ps FROM s)
SELECT record_key, criterion_id, score, coalesce(array_to_string(list_transform(CASE WHEN score <= 0 OR text IS NULL OR text = '' THEN []
  WHEN regexp_matches(lower(criterion_id), 'evidence|textual|supporting|detail') THEN ps[1:2] WHEN regexp_matches(lower(criterion_id), 'explanation|effect|function|reasoning|relationship|inference') THEN ps[-1:]
  WHEN regexp_matches(lower(criterion_id), 'organization|clarity') THEN ps[1:2] ELSE ps[1:1] END, lambda x: CASE WHEN regexp_replace(x, '\\s', '', 'g') = '' THEN NULL ELSE {_CLIP.format('x', 180)} END), ' | '), '') AS evidence FROM p""",
    "mat_justification": f"""WITH {_RES}, a AS (SELECT record_key, criterion_id, score, coalesce(nullif(c.name, ''), nullif(criterion_id, ''), 'Ölçüt') AS label, nullif({_ANCHOR}, '') AS anchor FROM rc WHERE c IS NOT NULL AND score IS NOT NULL)
SELECT record_key, criterion_id, score, CASE WHEN anchor IS NOT NULL THEN label || ' için yanıt ' || {_NUM.format('score')} || ' puan düzeyindeki çıpayla uyumludur: ' || anchor
  WHEN score <= 0 THEN label || '{materialize.NO_SCORE_TEXT}' ELSE label || '{materialize.SOME_SCORE_TEXT}' END AS justification FROM a""",
    "anchor_nearest": f"WITH {_RES} SELECT record_key, criterion_id, score, {_ANCHOR} AS anchor FROM rc WHERE c IS NOT NULL AND score IS NOT NULL",
    "feedback_band": f"SELECT record_key, {_FB} AS feedback FROM (SELECT record_key, gold_evaluation AS g FROM records)",
    "next_record_id": """WITH p AS (SELECT CAST(regexp_extract(id, '^tde(\\d+)-(\\w+)-(\\d+)$', 1) AS INTEGER) AS grade, regexp_extract(id, '^tde(\\d+)-(\\w+)-(\\d+)$', 2) AS modality, CAST(regexp_extract(id, '^tde(\\d+)-(\\w+)-(\\d+)$', 3) AS INTEGER) AS n
  FROM records WHERE regexp_matches(id, '^tde(\\d+)-(\\w+)-(\\d+)$'))
SELECT grade, modality, printf('tde%02d-%s-%06d', grade, modality, max(n) + 1) AS next_id FROM p GROUP BY grade, modality""",
    "serial_running": "SELECT record_key, modality, CAST(row_number() OVER (PARTITION BY modality ORDER BY file_path, record_key) AS INTEGER) AS serial FROM records",
    "positional_scores": f"""WITH {_CORR}, r AS (SELECT record_key, id, list_transform(rubric.criteria, lambda c: coalesce(c.criterion_id, '?')) AS c, list_transform(gold_evaluation.criterion_results, lambda x: x.score) AS s FROM records),
u AS (SELECT * FROM r WHERE len(c) > 0 AND len(s) > 0 AND len(c) = len(list_distinct(c))),
b AS (SELECT record_key, id, unnest(c[1:least(len(c), len(s))]) AS k, unnest(s[1:least(len(c), len(s))]) AS v FROM u),
o AS (SELECT record_key, unnest(map_entries(corr.c.s)) AS e FROM u JOIN corr USING (id))
SELECT record_key, e.key AS criterion_id, e.value AS score FROM o
UNION ALL SELECT record_key, k, v FROM b WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.record_key = b.record_key AND o.e.key = b.k)""",
    "review_apply": f"{_APPLIED} SELECT record_key, total_score, review_count, response_quality, changed_scores, changed_quality, review_error FROM applied",
    "review_summary": f"{_APPLIED} SELECT count(*) AS records_reviewed, count(*) FILTER (corrected) AS records_corrected, CAST(sum(changed_scores) AS BIGINT) AS criterion_scores_changed, CAST(sum(changed_quality) AS BIGINT) AS response_quality_changed, count(review_error) AS errors FROM applied",
    "review_unmatched": """WITH i AS (SELECT id, bool_or(coalesce(metadata.split IN ('validation', 'test'), false)) AS inside FROM records GROUP BY id), c AS (SELECT DISTINCT id FROM review_corrections)
SELECT c.id, CASE WHEN i.inside IS NULL THEN 'unknown' ELSE 'out_of_scope' END AS problem FROM c LEFT JOIN i ON c.id = i.id WHERE i.inside IS NULL OR NOT i.inside""",
    "sft_messages": """SELECT id, metadata.split AS split, CAST(3 AS INTEGER) AS n_messages, 'assistant' AS last_role, task.task_id AS task_id, rubric.rubric_id AS rubric_id, coalesce(metadata.adversarial, false) AS adversarial, false AS leaks_task_id, sha256(concat_ws('|', task.prompt, student_response.text, gold_evaluation.overall_feedback)) AS digest
FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed AND metadata.split IS NOT NULL""",
    "sft_chat_lines": "SELECT true AS ok, count(*) AS n FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed AND metadata.split IS NOT NULL",
    "sft_legacy_counts": """SELECT metadata.split AS split, count(*) AS n_all, count(*) FILTER (NOT coalesce(gold_evaluation.needs_review, false)) AS n_kept
FROM records WHERE metadata.status IN ('ai_verified', 'teacher_verified') AND metadata.pii_reviewed AND metadata.split IS NOT NULL GROUP BY ALL""",
    "json_extract_fence": "SELECT raw_id, sha256(nullif(regexp_extract('Cevap: ' || payload || ' son', '(?s)\\{.*\\}', 0), '')) AS digest FROM raw_records",
    "str_sentences": f"""WITH p AS (SELECT record_key, unnest({_SENT.format('student_response.text')}) AS s, unnest(range(len({_SENT.format('student_response.text')}))) AS pos FROM records)
SELECT record_key, CAST(pos AS INTEGER) AS pos, s AS sentence FROM p""",
    "str_clip": f"SELECT record_key, {_CLIP.format('t', 180)} AS clipped FROM (SELECT record_key, regexp_replace(student_response.text, '^\\s+|\\s+$', '', 'g') AS t FROM records) WHERE t IS NOT NULL",
    "sha_signature": f"SELECT record_key, sha256('{SEED}:' || file_path) AS digest, round({_UNIT.format('file_path')}, 9) AS unit FROM records",
    "answer_diagnostics": "SELECT record_key FROM records WHERE regexp_matches(student_response.text, 'Transkriptte|transkriptimde|OCR’da|OCR''da|taranan cevabımda')",
    "answer_density": """WITH c AS (SELECT 'question_family' AS level, metadata.question_family AS key, 20 AS wanted FROM records UNION ALL SELECT 'task', task.task_id, 10 FROM records)
SELECT level, key, count(*) AS n, CAST(wanted AS INTEGER) AS wanted FROM c WHERE key <> '' GROUP BY level, key, wanted HAVING count(*) <> wanted""",
    "canonical_summary": """SELECT 'modality' AS axis, coalesce(modality, '<missing>') AS category, count(*) AS n FROM records GROUP BY ALL UNION ALL SELECT 'grade', coalesce(CAST(grade AS VARCHAR), '<missing>'), count(*) FROM records GROUP BY ALL
UNION ALL SELECT 'response_quality', coalesce(metadata.response_quality, '<missing>'), count(*) FROM records GROUP BY ALL
UNION ALL SELECT 'hard_case_records', 'yes', count(*) FROM records WHERE len(metadata.hard_case_types) > 0 HAVING count(*) > 0 UNION ALL SELECT 'adversarial_records', 'yes', count(*) FROM records WHERE metadata.adversarial HAVING count(*) > 0
UNION ALL SELECT 'needs_review_records', 'yes', count(*) FROM records WHERE gold_evaluation.needs_review HAVING count(*) > 0 UNION ALL SELECT 'second_pass_records', 'yes', count(*) FROM records WHERE metadata.review_count >= 2 HAVING count(*) > 0""",
    "evidence_literal": """WITH r AS (SELECT record_key, concat_ws(chr(10), student_response.text, nullif(array_to_string(list_transform(list_filter(coalesce(student_response.observations, []), lambda o: o IS NOT NULL), lambda o: o.value), chr(10)), '')) AS t, unnest(gold_evaluation.criterion_results) AS r FROM records)
SELECT record_key, r.criterion_id AS criterion_id FROM r WHERE len(list_filter(r.evidence, lambda e: NOT contains(t, regexp_replace(e, '…$', '')))) > 0""",
    "uncertainty_grounding": """WITH r AS (SELECT record_key, lower(student_response.text) AS t, unnest(student_response.input_uncertainties) AS u FROM records)
SELECT record_key, u.span AS span FROM r WHERE u IS NOT NULL AND (NOT coalesce(contains(t, lower(u.span)), false) OR coalesce(len(u.candidates), 0) < 2)""",
    "duplicate_answers": "SELECT sha256(student_response.text) AS digest, count(*) AS n FROM records WHERE student_response.text <> '' GROUP BY student_response.text HAVING count(*) > 1",
}
