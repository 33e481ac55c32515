from datetime import datetime

import pytest

from gradeloom.operators import metrics

from .factory import frame, record

P = "prediction_key bigint, run_id string, id string, criterion_scores map<string,double>, needs_review boolean, produced_at timestamp_ntz"


def preds(spark, rows):
    return spark.createDataFrame([(k, "run", i, s, nr, datetime(2025, 1, 1)) for k, (i, s, nr) in enumerate(rows)], P)


def overall(spark, recs, rows):
    gold = metrics.latest_gold(frame(spark, recs))
    j = metrics.joined(metrics.latest_predictions(preds(spark, rows)), gold)
    return metrics.slice_metrics(metrics.score_rows(j)).where("dim = 'overall'").first()


def test_agreement_numbers(spark):
    r = record(1)
    m = overall(spark, [r], [(r["id"], {"c1": 2.5, "c2": 0.5}, True)])
    assert m.criterion_mae == 1.5 and m.criterion_exact_rate == 0.0 and m.criterion_within_1_rate == 0.5
    assert m.total_mae == 1.0 and m.fp == 1 and m.n_over == 1 and m.n_under == 1


def test_review_rows_score_nothing(spark):
    a, b = record(1), record(2, gold_evaluation__needs_review=True)
    m = overall(spark, [a, b], [(a["id"], {"c1": 1.5, "c2": 2.5}, False), (b["id"], {"c1": 0.0}, True)])
    assert (m.records, m.resolvable_records, m.criterion_items, m.tp, m.tn) == (2, 1, 2, 1, 1)
    assert m.total_exact_rate == 1.0 and m.precision == 1.0 and m.f1 == 1.0


def test_empty_denominators_are_null(spark):
    r = record(1, gold_evaluation__needs_review=True, gold_evaluation__max_score=0.0)
    m = overall(spark, [r], [(r["id"], {}, False)])
    assert m.criterion_mae is None and m.precision is None and m.f1 is None and m.recall == 0.0


def test_coverage_and_contract(spark):
    gold = metrics.latest_gold(frame(spark, [record(1), record(2)]))
    p = metrics.latest_predictions(preds(spark, [(record(1)["id"], {"c1": 5.5, "other": 1.0}, False), ("nobody", {}, False)]))
    assert [r.id for r in metrics.unknown_predictions(p, gold).collect()] == ["nobody"]
    assert [r.id for r in metrics.missing_predictions(p, gold).collect()] == [record(2)["id"]]
    e = metrics.contract_errors(metrics.joined(p, gold)).first()
    assert (e.missing, e.extra, e.out_of_range) == ("c2", "other", "c1")


@pytest.mark.parametrize("row, error", [((None, {"a": 1.0}, True), "id"), (("x", {"a": 1.0}, None), "needs_review"), (("x", None, True), "criterion_scores"), (("x", {"a": float("nan")}, True), "score"), (("x", {"a": float("inf")}, True), "score"), (("x", {"": 1.0}, True), "criterion_id"), (("x", {"a": 1.0}, True), None)])
def test_malformed_predictions(spark, row, error):
    got = [r.error for r in metrics.prediction_errors(preds(spark, [row])).collect()]
    assert got == ([error] if error else [])


def test_late_rows_win(spark):
    r = record(1)
    late = record(2, id=r["id"], ingested_at=datetime(2026, 1, 1), modality="speaking")
    assert metrics.latest_gold(frame(spark, [r, late])).first().modality == "speaking"
