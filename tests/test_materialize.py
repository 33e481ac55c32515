import json

from pyspark.sql import functions as F

from gradeloom.functions import text as T
from gradeloom.operators import materialize as M
from gradeloom.operators import predictions, review

from .factory import frame, record

CRIT = record(1)["rubric"]["criteria"]
CRIT[1]["criterion_id"] = "textual"


def family(**resp):
    r = {"candidate_id": "c1", "text": " Bir. İki! ", "scores": [3.0, 2.0], "response_quality": "high_partial", "hard_case_types": ["short_correct"], "adversarial": False, "needs_review": False, "review_reason": None, "source": None}
    second = {**r, "candidate_id": "c2"}
    return [{"file": "f", "record_id_start": 7, "grade": 9, "modality": "written", "created_at": "2025-01-01", "tags": ["b", "a"], "exam_family": "e", "question_family": "q", "rubric": {"rubric_id": "r", "version": "1", "criteria": CRIT}, "tasks": [{"task_id": "t", "prompt": "p", "context": None, "responses": [{**r, **resp}, second]}]}]


def built(spark, override=None, **resp):
    fam = spark.createDataFrame(family(**resp), M.FAMILY_DDL)
    ov = spark.createDataFrame([("c1", 0, '{"text_override":"eski"}'), ("c1", 1, json.dumps(override or {})), ("", 2, "{}")], "candidate_id string, pos int, raw string")
    second = spark.createDataFrame([("c1",)], "candidate_id string")
    return {r.candidate_id: r for r in M.build_batch(fam, ov, second, "wave").collect()}


def test_build(spark):
    got = built(spark)
    r = got["c1"]
    assert (r.id, got["c2"].id) == ("tde09-written-000007", "tde09-written-000008")
    assert r.student_response.text == "Bir. İki!" and r.gold_evaluation.total_score == 5.0
    assert r.metadata.tags == ["a", "b", "synthetic", "wave"] and r.metadata.review_count == 2 and got["c2"].metadata.review_count == 1
    assert r.error is None and r.gold_evaluation.criterion_results[1].evidence == ["Bir.", "İki!"]


def test_key_presence_is_not_null(spark):
    assert built(spark, {"text_override": None})["c1"].student_response.text == ""
    assert built(spark, {"hard_case_types_override": None})["c1"].metadata.hard_case_types == []
    assert built(spark, {"effective_response_quality": None})["c1"].metadata.response_quality == "high_partial"
    assert built(spark, {"scores": {"c1": 1}, "final_scores": {"c1": 4}})["c1"].gold_evaluation.total_score == 6.0


def test_build_errors(spark):
    assert built(spark, {"source_override": "raw_ocr"})["c1"].error == "uncertainties"
    assert built(spark, {"source_override": "fax"})["c1"].error == "source"
    assert built(spark, {"scores": {"c1": 9}})["c1"].error == "scores"
    assert built(spark, scores=[1.0])["c1"].error == "scores"


def test_wave_layers(spark):
    fam = family()
    audio = {**CRIT[1], "criterion_id": "audio", "evidence_sources": ["audio_delivery"]}
    fam[0]["modality"] = "speaking"
    fam[0]["rubric"]["criteria"] = [CRIT[0], audio]
    second = {**fam[0], "file": "g", "grade": 10}
    df = spark.createDataFrame([fam[0], second], M.FAMILY_DDL)
    layer = lambda o: spark.createDataFrame([("c1", 0, json.dumps(o))], "candidate_id string, pos int, raw string")
    got = M.build_wave(df, layer({"text_override": "r", "content_scores": {"c1": 1}, "hard_case_types_override": []}), layer({"final_scores": {"c1": 2}, "needs_review": True, "review_reason": "x"})).collect()
    one = next(r for r in got if r.id == "tde09-speaking-000001")
    assert sorted(r.id for r in got) == ["tde09-speaking-000001", "tde09-speaking-000002", "tde10-speaking-000003", "tde10-speaking-000004"]
    assert one.gold_evaluation.total_score == 2.0 and one.student_response.text == "r" and one.metadata.hard_case_types == ["short_correct"]
    assert one.rubric.rubric_id == "r-transcript" and one.rubric.version == "1.1" and len(one.rubric.criteria) == 1
    assert one.gold_evaluation.needs_review and one.gold_evaluation.review_reason == "x" and one.error is None


def test_scalars(spark):
    one = spark.createDataFrame([(" \tx ", "a. b!  c/d", 8.0, "z" * 200)], "a string, s string, n double, l string")
    r = one.select(T.ustrip(F.col("a")).alias("a"), T.sentences(F.col("s")).alias("s"), T.number_g(F.col("n")).alias("n"), T.clip(F.col("l")).alias("l"), T.half_even(F.lit(2.5)).alias("h")).first()
    assert (r.a, r.s, r.n, len(r.l), r.l[-1], r.h) == ("x", ["a.", "b!", "c", "d"], "8", 180, "…", 2)


def test_nearest_anchor(spark):
    a = [{"score": 0.0, "description": "zero"}, {"score": 2.0, "description": "two"}, {"score": 4.0, "description": "four"}]
    df = spark.createDataFrame([(a, 2.0), (a, 3.0), (a, 9.0), ([], 1.0)], "a array<struct<score:double,description:string>>, s double")
    assert [r[0] for r in df.select(M.anchor_for(F.col("a"), F.col("s"))).collect()] == ["two", "two", "four", None]


def corr(spark, rows):
    return spark.createDataFrame([(i, x, s, q, None) for i, (x, s, q) in enumerate(rows)], "correction_key bigint, id string, scores map<string,double>, response_quality string, reviewed_at timestamp_ntz")


def test_review(spark):
    a, b = record(1, metadata__split="test"), record(2, metadata__split="validation")
    df = frame(spark, [a, b, record(3)])
    out = {r.record_key: r for r in review.apply_review(df, review.latest_corrections(corr(spark, [(a["id"], {"c1": 5.0}, "full_correct")]))).collect()}
    assert set(out) == {1, 2} and out[1].gold_evaluation.total_score == 7.5 and out[1].changed_scores == 1 and out[1].changed_quality == 1
    assert out[1].metadata.review_count == out[2].metadata.review_count == 2 and out[2].gold_evaluation.total_score == 4.0
    assert "5/5" in out[1].gold_evaluation.criterion_results[0].justification
    bad = review.apply_review(df, review.latest_corrections(corr(spark, [(a["id"], {"c1": 5.5}, None)]))).where("record_key = 1").first()
    assert bad.review_error == "c1" and bad.gold_evaluation.total_score == 4.0
    assert {(r.id, r.problem) for r in review.unmatched(corr(spark, [("x", None, None), (record(3)["id"], None, None)]), df, ("test",)).collect()} == {("x", "unknown"), (record(3)["id"], "out_of_scope")}


def test_model_output(spark):
    fence = '```json\n{"criterion_results":[{"criterion_id":"a","score":3}],"needs_review":false}\n```'
    rows = [
        (1, fence, None), (2, 'x {"criterion_scores":{"a":2.5,"b":1},"needs_review":true} y', None), (3, "nothing", "no_json"), (4, '{"criterion_scores":{"a":1},"needs_review":"false"}', "needs_review"),
        (5, '{"criterion_results":[{"criterion_id":"a","score":1},{"criterion_id":"a","score":2}],"needs_review":true}', "duplicate_criterion_id"), (6, '{"criterion_results":[],"needs_review":true}', "criterion_results"),
        (7, '{"criterion_scores":{"a":true},"needs_review":true}', "score"), (8, '{"criterion_scores":{},"needs_review":true}', "empty"), (9, '{"criterion_results":[{"criterion_id":"","score":1}],"needs_review":true}', "criterion_id"), (10, None, "no_json"), (11, '{"a": {', "no_json"),
    ]
    df = spark.createDataFrame([(k, t) for k, t, _ in rows], "k int, t string")
    got = {r.k: r for r in predictions.parse_outputs(df, "k", "t").collect()}
    assert {k: got[k].error for k, _, _ in rows} == {k: e for k, _, e in rows}
    assert got[1].criterion_scores == {"a": 3.0} and got[2].criterion_scores == {"a": 2.5, "b": 1.0} and got[2].needs_review is True


def test_inference_loop(spark):
    chat = spark.createDataFrame([("a", [("system", "s"), ("user", "u"), ("assistant", "x")]), ("b", [("user", "u")])], "id string, messages array<struct<role:string,content:string>>")
    p = predictions.first_prompts(chat, 5)
    out = predictions.run_model(p, lambda chats: [str(len(c)) for c in chats]).collect()
    assert [(r.id, r.output) for r in out] == [("a", "2")]
