import pytest

from gradeloom.operators import rules

from .factory import frame, record

GOLD = record(1)["gold_evaluation"]
CRIT = record(1)["rubric"]["criteria"]


def codes(spark, row, which=None):
    df = frame(spark, [row])
    return {r.code for r in rules.apply_rules(df, "record_key", which or rules.record_rules()).collect()}


def test_clean_record_has_no_finding(spark):
    assert codes(spark, record(1)) == set()
    assert codes(spark, record(1), rules.policy_rules()) == set()


@pytest.mark.parametrize(
    "change, code",
    [
        ({"id": "other"}, "filename_id_mismatch"),
        ({"file_path": "dataset/records/speaking/tde11-written-000001.json"}, "modality_folder_mismatch"),
        ({"rubric__criteria": [CRIT[0], CRIT[0], CRIT[1]], "task__max_score": 13.0, "gold_evaluation__max_score": 13.0}, "duplicate_criterion_id"),
        ({"gold_evaluation__criterion_results": [*GOLD["criterion_results"], GOLD["criterion_results"][0]], "gold_evaluation__total_score": 5.5}, "duplicate_result_id"),
        ({"gold_evaluation__criterion_results": GOLD["criterion_results"][:1], "gold_evaluation__total_score": 1.5}, "criterion_result_mismatch"),
        ({"gold_evaluation__criterion_results": [{**GOLD["criterion_results"][0], "score": 5.5}, GOLD["criterion_results"][1]], "gold_evaluation__total_score": 8.0}, "criterion_score_overflow"),
        ({"task__max_score": 9.0, "gold_evaluation__max_score": 9.0}, "rubric_task_max_mismatch"),
        ({"gold_evaluation__max_score": 11.0}, "task_gold_max_mismatch"),
        ({"gold_evaluation__total_score": 3.0}, "total_score_mismatch"),
        ({"gold_evaluation__needs_review": True}, "review_reason_required"),
        ({"gold_evaluation__review_reason": "neden"}, "unexpected_review_reason"),
        ({"metadata__pii_reviewed": None}, "verified_without_pii_review"),
        ({"student_response__text": "Bana 0532 123 45 67 yaz"}, "possible_pii"),
        ({"rubric__criteria": [{**CRIT[0], "evidence_sources": ["audio_delivery"]}, CRIT[1]]}, "missing_nontext_observation"),
    ],
)
def test_each_record_rule(spark, change, code):
    assert codes(spark, record(1, **change)) == {code}


def test_total_overflow(spark):
    r = record(1, gold_evaluation__total_score=11.0)
    assert "total_score_overflow" in codes(spark, r)


@pytest.mark.parametrize(
    "change, code",
    [
        ({"metadata__verification_source": "ai"}, "verification_source_mismatch"),
        ({"task__task_id": " "}, "production_task_id_required"),
        ({"metadata__response_quality": None}, "response_quality_required"),
        ({"metadata__hard_case_types": None}, "hard_case_types_required"),
        ({"metadata__hard_case_types": ["nonsense"]}, "invalid_hard_case_type"),
        ({"metadata__adversarial": None}, "adversarial_required"),
        ({"metadata__review_count": None}, "review_count_required"),
        ({"metadata__review_count": 0}, "insufficient_review_count"),
        ({"metadata__adjudicated": None}, "adjudicated_required"),
        ({"metadata__split": "test"}, "evaluation_split_requires_dual_review"),
        ({"metadata__response_quality": "borderline"}, "borderline_requires_dual_review"),
        ({"gold_evaluation__needs_review": True}, "needs_review_requires_dual_review"),
        ({"metadata__adversarial": True}, "adversarial_without_hard_case"),
        ({"metadata__hard_case_types": ["prompt_injection"]}, "prompt_injection_must_be_adversarial"),
        ({"metadata__hard_case_types": ["rubric_ambiguity"]}, "ambiguity_without_review_target"),
    ],
)
def test_each_policy_rule(spark, change, code):
    assert codes(spark, record(1, **change), rules.policy_rules()) == {code}


def test_unicode_signs(spark):
    for t in ("KİMLİK NO", "Öğrenci no", "tc no", "a.b@c.org"):
        assert codes(spark, record(1, student_response__text=f"x {t} y")) == {"possible_pii"}, t


def test_duplicate_names_first_path(spark):
    rows = [record(1, id="a", file_path="b.json"), record(2, id="a", file_path="a.json"), record(3, id=None), record(4, id=None)]
    got = rules.duplicate_ids(frame(spark, rows), "record_key").collect()
    assert [(r.record_key, r.detail) for r in got] == [(1, "a.json")]
    assert rules.render(frame(spark, rows).limit(0).selectExpr("record_key", "'error' level", "'x' code", "'d' detail")).count() == 0


def test_type_tags(spark):
    df = spark.createDataFrame([(1, '{"grade":11}'), (2, "nope"), (3, None), (4, '{"grade":"11"}')], "k int, p string")
    got = {(r.k, r.code, r.detail) for r in rules.type_findings(df, "k", "p", {"$.grade": "BIGINT"}).collect()}
    assert got == {(2, "invalid_json", None), (3, "invalid_json", None), (4, "wrong_type", "$.grade STRING")}
