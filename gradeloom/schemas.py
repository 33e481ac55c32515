"""Schemas and fixed values of canonical records."""

from __future__ import annotations

RECORD_DDL = """
id string, schema_version string, modality string, language string, grade int,
task struct<task_id:string, prompt:string, context:string, max_score:double>,
rubric struct<rubric_id:string, version:string, criteria:array<struct<criterion_id:string, name:string, description:string,
  max_score:double, scoring_anchors:array<struct<score:double, description:string>>, evidence_sources:array<string>>>>,
student_response struct<text:string, source:string, observations:array<struct<label:string, value:string, source:string>>,
  input_uncertainties:array<struct<span:string, candidates:array<string>>>>,
gold_evaluation struct<criterion_results:array<struct<criterion_id:string, score:double, evidence:array<string>, justification:string>>,
  total_score:double, max_score:double, needs_review:boolean, review_reason:string, overall_feedback:string>,
metadata struct<status:string, split:string, created_at:string, tags:array<string>, pii_reviewed:boolean, subject_group_id:string,
  exam_family:string, question_family:string, provenance:string, verification_source:string, response_quality:string,
  hard_case_types:array<string>, adversarial:boolean, review_count:int, adjudicated:boolean>
"""

PREDICTION_DDL = "id string, criterion_scores map<string, double>, needs_review boolean"

# Fixed values of the data model.
MODALITIES = ("written", "speaking", "listening")
SPLITS = ("train", "validation", "test")
EVALUATION_SPLITS = ("validation", "test", "benchmark")
VERIFIED_STATUSES = ("ai_verified", "teacher_verified")
QUALITY_LEVELS = ("full_correct", "high_partial", "mid_partial", "low_partial", "incorrect", "blank_irrelevant", "borderline")
HARD_CASE_TYPES = (
    "correct_result_wrong_reason", "wrong_result_valid_method", "mixed_criterion_performance", "long_irrelevant", "short_correct",
    "keyword_decoy", "rubric_extra_info", "paraphrase_equivalent", "contradictory_answer", "prompt_injection", "ocr_ambiguity",
    "stt_ambiguity", "missing_evidence", "rubric_ambiguity",
)
RESPONSE_SOURCES = ("manual", "teacher_corrected", "verified_ocr", "verified_stt", "raw_ocr", "raw_stt")
NONTEXT_EVIDENCE = ("audio_delivery", "teacher_observation")
LINK_KEYS = ("task_id", "subject_group_id", "exam_family", "question_family")

#: Scores within this distance are equal.
TOLERANCE = 1e-9

# The two JSON schemas of the data model.
_TEXT = {"type": "string", "minLength": 1}
_ANCHOR = {"type": "object", "additionalProperties": False, "required": ["score", "description"], "properties": {"score": {"type": "number", "minimum": 0}, "description": _TEXT}}
EVIDENCE_SOURCES = ("response_text", "task_context", *NONTEXT_EVIDENCE)
_CRITERION = {
    "type": "object", "additionalProperties": False, "required": ["criterion_id", "name", "description", "max_score", "scoring_anchors", "evidence_sources"],
    "properties": {
        "criterion_id": _TEXT, "name": _TEXT, "description": _TEXT, "max_score": {"type": "number", "exclusiveMinimum": 0},
        "scoring_anchors": {"type": "array", "minItems": 2, "items": _ANCHOR},
        "evidence_sources": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"enum": list(EVIDENCE_SOURCES)}},
    },
}
RUBRIC_SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["rubric_id", "version", "criteria"],
    "properties": {"rubric_id": _TEXT, "version": _TEXT, "criteria": {"type": "array", "minItems": 1, "items": _CRITERION}},
}
PREDICTION_SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["id", "criterion_scores", "needs_review"],
    "properties": {"id": _TEXT, "criterion_scores": {"type": "object", "minProperties": 1, "additionalProperties": {"type": "number", "minimum": 0}}, "needs_review": {"type": "boolean"}},
}
