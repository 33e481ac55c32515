import json

import pytest
from pyspark.sql import functions as F

from gradeloom import cli
from gradeloom.functions.text import today, utc_now
from gradeloom.operators import links, materialize, metrics, nested, quota, rules
from gradeloom.sources.records import bad_lines

from .factory import frame, record

PRED = "prediction_key bigint, run_id string, id string, criterion_scores map<string,double>, needs_review boolean, produced_at timestamp_ntz"


@pytest.fixture
def salted(spark):
    spark.conf.set("gradeloom.skew.leastRows", "0")
    yield
    spark.conf.unset("gradeloom.skew.leastRows")


def test_envelopes_of_any_depth_and_chunks_by_bytes(spark, monkeypatch):
    inner = {"rubric": {"criteria": [{"criterion_id": "x"}]}}
    deep = inner
    for k in range(25):
        deep = {("record", "payload", "data")[k % 3]: json.dumps(deep) if k in (3, 9) else deep}
    rows = [(1, json.dumps(inner)), (2, json.dumps(deep)), (3, ""), (4, "{" + "x" * 5000)]
    df = spark.createDataFrame(rows, "raw_id bigint, payload string").coalesce(1)
    want = [(1, "criteria", 0), (2, "criteria", 0)]
    for size in (1, 1 << 20):
        monkeypatch.setattr(nested, "CHUNK_BYTES", size)
        assert sorted((r.raw_id, r.child, r.pos) for r in nested.flatten_payloads(df, "raw_id", "payload").collect()) == want


def test_duplicate_ids_salted(spark, salted):
    rows = [record(i, id="same" if i % 3 == 0 else f"id{i}", file_path=f"p/{(i * 7) % 50:02d}.json") for i in range(40)]
    rows += [record(90, id=None), record(91, id=None), record(92, id="z", file_path=None), record(93, id="z", file_path="a")]
    got = {(r.record_key, r.detail) for r in rules.duplicate_ids(frame(spark, rows), "record_key").collect()}
    same = sorted((r["file_path"], r["record_key"]) for r in rows if r["id"] == "same")
    assert got == {(k, same[0][0]) for _, k in same[1:]} | {(93, None)}
    assert rules.duplicate_ids(frame(spark, []), "record_key").count() == 0


def test_components_salted(spark, salted):
    rows = [record(i, metadata__exam_family="big" if i % 2 else f"e{i}", metadata__question_family=None, task__task_id=None) for i in range(60)]
    got = {r.record_key: r.component for r in links.record_components(frame(spark, rows), "record_key").collect()}
    assert got == {i: "exam_family=big" if i % 2 else f"exam_family=e{i}" for i in range(60)}


CASES = [
    ("filename_id_mismatch", dict(file_path="dataset/records/written/other.json")),
    ("modality_folder_mismatch", dict(file_path="dataset/records/speaking/{id}.json")),
    ("rubric_task_max_mismatch", dict(task__max_score=9.0, gold_evaluation__max_score=9.0)),
    ("task_gold_max_mismatch", dict(gold_evaluation__max_score=11.0)),
    ("unexpected_review_reason", dict(gold_evaluation__review_reason="neden")),
    ("possible_pii", dict(student_response__text="Bana a.b@ornek.com yaz.")),
    ("adversarial_required", dict(metadata__adversarial=None)),
    ("insufficient_review_count", dict(metadata__review_count=0)),
    ("adjudicated_required", dict(metadata__adjudicated=None)),
    ("prompt_injection_must_be_adversarial", dict(metadata__hard_case_types=["prompt_injection"])),
]


def test_rules_that_the_tables_never_break(spark):
    rows = [record(0)]
    for k, (_, over) in enumerate(CASES, 1):
        r = record(k, **over)
        r["file_path"] = r["file_path"].format(id=r["id"])
        rows.append(r)
    df = frame(spark, rows)
    found = rules.apply_rules(df, "record_key", rules.record_rules()).unionByName(rules.apply_rules(df, "record_key", rules.policy_rules()))
    got = {}
    for r in found.collect():
        got.setdefault(r.record_key, set()).add(r.code)
    assert 0 not in got
    for k, (code, _) in enumerate(CASES, 1):
        assert code in got[k], code


def test_texts_of_findings(spark):
    other = [{"criterion_id": "nope", "score": 3.0, "evidence": [], "justification": "j"}]
    high = record(2)
    high["gold_evaluation"]["criterion_results"][0]["score"] = 99.5
    first = high["gold_evaluation"]["criterion_results"][0]["criterion_id"]
    ids = ",".join(sorted(c["criterion_id"] for c in high["rubric"]["criteria"]))
    df = frame(spark, [record(1, gold_evaluation__criterion_results=other), high])
    got = {(r.record_key, r.code): r.detail for r in rules.apply_rules(df, "record_key", rules.record_rules()).collect()}
    assert got[1, "criterion_result_mismatch"] == f"missing={ids} extra=nope"
    assert got[2, "criterion_score_overflow"] == f"{first}: 99.5"


def test_grounding(spark):
    res = lambda *e: [{"criterion_id": "c1", "score": 1.0, "evidence": list(e), "justification": "j"}]
    obs = [{"label": "l", "value": "sesi titredi", "source": "s"}]
    rows = [
        record(1, gold_evaluation__criterion_results=res("Birinci cümle.")),
        record(2, gold_evaluation__criterion_results=res("yok böyle")),
        record(3, gold_evaluation__criterion_results=res("Birinci…")),
        record(4, gold_evaluation__criterion_results=res("sesi titredi"), student_response__observations=obs),
        record(5, student_response__text=None, gold_evaluation__criterion_results=res("x", None)),
        record(6, student_response__text="OCR'da bu satır silik.", student_response__input_uncertainties=[{"span": "satır", "candidates": ["a", "b"]}, {"span": "başka", "candidates": ["a", "b"]}, {"span": "silik", "candidates": ["a"]}]),
    ]
    df = frame(spark, rows)
    assert [r.record_key for r in rules.ungrounded_evidence(df, "record_key").where("record_key < 6").orderBy("record_key").collect()] == [2, 5]
    assert sorted(r.span for r in rules.ungrounded_uncertainties(df, "record_key").collect()) == ["başka", "silik"]
    assert [r.record_key for r in rules.diagnostic_prose(df, "record_key").collect()] == [6]


def test_strict_evaluation(spark, tmp_path, capsys):
    rows = [record(i, metadata__split="test") for i in range(13)]
    gold = metrics.latest_gold(frame(spark, rows), ("test",))
    s = {c["criterion_id"]: 1.0 for c in rows[0]["rubric"]["criteria"]}
    ids = [r["id"] for r in rows]
    preds = [(0, "a", ids[0], s, False, None), (1, "a", ids[0], s, False, None), (2, "a", "who", s, False, None), (3, "a", None, s, False, None), (4, "a", ids[1], None, False, None)]
    preds += [(10 + k, "b", i, s, False, None) for k, i in enumerate(ids)]
    got = {(r.run_id, r.problem): (r.n, r.first_ids) for r in metrics.first_offenders(metrics.strict_problems(spark.createDataFrame(preds, PRED), gold)).collect()}
    assert got == {("a", "malformed"): (2, ",".join(sorted(["#3", ids[1]]))), ("a", "duplicate"): (1, ids[0]), ("a", "unknown"): (1, "who"), ("a", "missing"): (11, ",".join(ids[2:12]))}
    n = {r.run_id: r.n_missing for r in metrics.missing_counts(spark.createDataFrame(preds, PRED), gold).collect()}
    assert n == {"a": 11, "b": 0}
    path = str(tmp_path / "records.parquet")
    frame(spark, rows).write.parquet(path)
    good = tmp_path / "good.jsonl"
    good.write_text("\n".join(json.dumps({"id": i, "criterion_scores": s, "needs_review": False}) for i in ids))
    assert cli.main(["evaluate", path, "--predictions", str(good)]) == 0
    bad = tmp_path / "bad.jsonl"
    bad.write_text(good.read_text() + "\n\n[1]\n{\n")
    assert [(r.line, r.value) for r in bad_lines(spark, str(bad)).orderBy("line").collect()] == [(15, "[1]"), (16, "{")]
    capsys.readouterr()
    assert cli.main(["evaluate", path, "--predictions", str(bad)]) == 2
    assert "bad.jsonl:15" in capsys.readouterr().err
    assert cli.main(["evaluate", path]) == 2


def test_line_numbers_across_blocks(spark, tmp_path):
    f = tmp_path / "many.jsonl"
    lines = [json.dumps({"id": f"i{k}", "criterion_scores": {"a": 1.0}, "needs_review": False}) for k in range(3000)]
    for k in (0, 999, 2999):
        lines[k] = "nothing"
    f.write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert sorted(r.line for r in bad_lines(spark, str(f)).collect()) == [1, 1000, 3000]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_split_guards(spark, tmp_path, capsys):
    def run(rows):
        path = str(tmp_path / f"r{len(list(tmp_path.iterdir()))}.parquet")
        frame(spark, rows).write.parquet(path)
        out = tmp_path / "out"
        return cli.main(["split", path, "--out", str(out)]), out.exists(), capsys.readouterr().err

    plain = [record(i) for i in range(6)]
    code, wrote, err = run([*plain, record(10, metadata__split="benchmark", metadata__exam_family="x"), record(11, metadata__exam_family="x")])
    assert (code, wrote) == (1, False) and record(11)["id"] in err
    code, wrote, err = run([*plain, record(10, metadata__split="train", metadata__exam_family="x"), record(11, metadata__split="test", metadata__exam_family="x")])
    assert (code, wrote) == (1, False) and "exam_family=x" in err
    code, wrote, _ = run(plain)
    assert (code, wrote) == (0, True)


def test_builds(spark, tmp_path):
    rows = [record(i, metadata__question_family=f"f{i // 3}", task__task_id=f"t{i % 2}", metadata__hard_case_types=["short_correct"] if i == 0 else []) for i in range(7)]
    df = frame(spark, rows)
    materialize.check_family_sizes(df.where("record_key < 6"), 3)
    with pytest.raises(ValueError, match="f2: 1"):
        materialize.check_family_sizes(df, 3)
    assert {(r.level, r.key, r.n) for r in quota.density(df, 3, 3).collect()} == {("question_family", "f2", 1), ("task", "t0", 4)}
    p = tmp_path / "manifest.json"
    p.write_text(json.dumps({"batch": "b", "pending_records": 7}))
    got = materialize.update_manifest(str(p), df, "2026-01-02")
    assert got == json.loads(p.read_text()) and got["batch"] == "b" and got["canonical_records"] == 7 and got["pending_records"] == 0
    d = got["canonical_distribution"]
    assert d["modality"] == {"written": 7} and d["hard_case_records"] == 1 and d["adversarial_records"] == 0
    assert len(list(tmp_path.iterdir())) == 1
    assert len(today()) == 10 and utc_now().startswith(today()[:4])


def test_override_rate(spark):
    full = {c["criterion_id"]: c["max_score"] for c in record(0)["rubric"]["criteria"]}
    none = dict.fromkeys(full, 0.0)
    rows = [record(i, metadata__hard_case_types=["prompt_injection"]) for i in range(4)]
    preds = [(i, "a", r["id"], full if i == 0 else none, False, None) for i, r in enumerate(rows)]
    scored = metrics.score_rows(metrics.joined(metrics.latest_predictions(spark.createDataFrame(preds, PRED)), metrics.latest_gold(frame(spark, rows))))
    r = metrics.targeted_rates(scored, F.col("overridden")).first()
    assert (r.hard_case_type, r.records, r.override_rate, r.over_rate, r.under_rate) == ("prompt_injection", 4, 0.25, 0.25, 0.75)
