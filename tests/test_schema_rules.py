import copy
import json

from gradeloom.operators import rules
from gradeloom.plans.rules import schema_findings

from .conftest import SF
from .factory import frame, record


def good():
    r = record(1)["rubric"]
    r["criteria"][1]["scoring_anchors"] = copy.deepcopy(r["criteria"][0]["scoring_anchors"])
    return r


CASES = {
    "rubric: missing": lambda r: None,
    "rubric.version: shorter than 1": lambda r: r.update(version=""),
    "rubric.rubric_id: missing": lambda r: r.update(rubric_id=None),
    "rubric.criteria: fewer than 1 items": lambda r: r.update(criteria=[]),
    "rubric.criteria.1: missing": lambda r: r["criteria"].__setitem__(1, None),
    "rubric.criteria.0.max_score: not greater than 0": lambda r: r["criteria"][0].update(max_score=0.0),
    "rubric.criteria.0.scoring_anchors: fewer than 2 items": lambda r: r["criteria"][0].update(scoring_anchors=[{"score": 0.0, "description": "d"}]),
    "rubric.criteria.0.scoring_anchors.1.score: less than 0": lambda r: r["criteria"][0]["scoring_anchors"][1].update(score=-1.0),
    "rubric.criteria.1.evidence_sources: repeated items": lambda r: r["criteria"][1].update(evidence_sources=["response_text"] * 2),
    "rubric.criteria.1.evidence_sources.0: unknown value x": lambda r: r["criteria"][1].update(evidence_sources=["x"]),
}


def changed():
    for k, (want, f) in enumerate(CASES.items()):
        r = good()
        f(r)
        yield k, want, (None if want == "rubric: missing" else r)


def test_each_schema_error(spark):
    rows = [record(100, rubric=good())] + [record(k, rubric=r) for k, _, r in changed()]
    got = rules.apply_rules(frame(spark, rows), "record_key", rules.rubric_schema_rules()).collect()
    assert {r.code for r in got} == {"schema"}
    assert sorted((r.record_key, r.detail) for r in got) == sorted((k, want) for k, want, _ in changed())


def test_each_schema_error_of_raw_records(spark):
    rows = [(k, json.dumps({"rubric": r})) for k, _, r in changed()] + [(100, json.dumps({"rubric": good()})), (101, "no"), (102, "{}")]
    more = {103: ("rubric.criteria: is object", {**good(), "criteria": {}}), 104: ("rubric.note: unknown member", {**good(), "note": 1}), 105: ("rubric.version: is bigint", {**good(), "version": 1})}
    less = good()
    del less["criteria"][1]["name"]
    more[106] = ("rubric.criteria.1.name: missing", less)
    rows += [(k, json.dumps({"rubric": r})) for k, (_, r) in more.items()]
    got = {(r.k, r.detail) for r in rules.raw_schema_findings(spark.createDataFrame(rows, "k int, p string"), "k", "p").collect()}
    void = {"rubric: missing": "rubric: is void", "rubric.rubric_id: missing": "rubric.rubric_id: is void", "rubric.criteria.1: missing": "rubric.criteria.1: is void"}
    assert got == {(k, void.get(w, w)) for k, w, _ in changed()} | {(102, "rubric: missing")} | {(k, w) for k, (w, _) in more.items()}


def test_prediction_schema(spark):
    rows = [(1, "a", {"x": 1.0}, True), (2, "", {"x": 1.0}, True), (3, "a", {}, True), (4, "a", {"x": -1.0, "y": None}, None), (5, None, None, False)]
    df = spark.createDataFrame(rows, "k int, id string, criterion_scores map<string,double>, needs_review boolean")
    got = {(r.k, r.detail.removeprefix("prediction.")) for r in rules.apply_rules(df, "k", rules.prediction_schema_rules()).collect()}
    assert got == {(2, "id: shorter than 1"), (3, "criterion_scores: fewer than 1 members"), (4, "criterion_scores.x: less than 0"), (4, "criterion_scores.y: missing"), (4, "needs_review: missing"), (5, "id: missing"), (5, "criterion_scores: missing")}


def test_against_a_plain_count(spark):
    rec = spark.read.parquet(f"{SF}/records.parquet").select("rubric.criteria").collect()
    few = sum(c is not None and len(c["scoring_anchors"] or []) < 2 and c["scoring_anchors"] is not None for r in rec for c in r.criteria or [])
    got = schema_findings(spark, SF)
    assert got.where("detail rlike 'scoring_anchors: fewer'").count() == few
