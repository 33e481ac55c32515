import json

from gradeloom.operators import export, lock
from gradeloom.sources import records as S

from .factory import frame, record


def test_tolerant_scan(spark, tmp_path):
    d = tmp_path / "written"
    d.mkdir()
    row = {k: v for k, v in record(1).items() if k not in ("record_key", "file_path", "ingested_at")}
    (d / "a.json").write_text(json.dumps(row, indent=2), encoding="utf-8")
    (d / "b.json").write_text('{"id": "broken', encoding="utf-8")
    got = S.read_records(spark, str(d)).collect()
    assert len(got) == 2
    assert sorted((r.id is not None and r.corrupt is None) for r in got) == [False, True]


def test_jsonl(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    p.write_text('{"id":"a","criterion_scores":{"x":3},"needs_review":false}\n\n   \n[1]\n{"id":\n', encoding="utf-8")
    got = S.read_jsonl(spark, str(p)).collect()
    assert len(got) == 3 and sum(r.corrupt is None for r in got) == 1
    assert [r.criterion_scores for r in got if r.id == "a"] == [{"x": 3.0}]


def test_flatten_strings(spark):
    df = spark.createDataFrame([(1, '{"a":"x","b":[{"c":"y \\"q\\""}],"n":1}'), (2, None), (3, "bad")], "k int, p string")
    assert sorted(r.text for r in S.flatten_strings(df, "k", "p").collect()) == ["x", 'y "q"']


def test_versions_and_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "e")], "a int, error string")
    v1, v2 = S.write_version(df, str(tmp_path)), S.write_version(df, str(tmp_path))
    assert v1 != v2 and spark.read.parquet(v1).count() == 2
    assert S.write_with_errors(df, str(tmp_path / "good"), str(tmp_path / "bad")) is True
    assert S.write_with_errors(df.where("a = 1"), str(tmp_path / "g2"), str(tmp_path / "b2")) is False


def test_sft(spark, tmp_path):
    rows = [record(1, metadata__split="train"), record(2, metadata__split="train", gold_evaluation__needs_review=True), record(3), record(4, metadata__split="test", metadata__pii_reviewed=None)]
    sft = export.sft_rows(frame(spark, rows))
    got = {r.id: r for r in sft.collect()}
    assert len(got) == 2 and export.sft_rows(frame(spark, rows), keep_review=False).count() == 1
    user = json.loads(got[rows[0]["id"]].messages[1].content)
    assert list(user) == ["task", "rubric", "student_response"] and "task_id" not in user["task"] and user["task"]["context"] is None
    assert got[rows[0]["id"]].metadata.task_id == "task-1"
    export.write_sft(sft, str(tmp_path / "sft"))
    assert (tmp_path / "sft" / "split=train").exists()
    assert [r.ok for r in export.chat_only(sft).collect()] == [True, True]
    export.prepare_training(sft, str(tmp_path / "train"), {"train": 2})
    assert (tmp_path / "train" / "split=train").exists()
    for wrong in ({"train": 3}, {"train": 2, "test": 0}):
        try:
            export.prepare_training(sft, str(tmp_path / "other"), wrong)
        except ValueError:
            continue
        raise AssertionError(wrong)
    S.write_report(str(tmp_path / "deep" / "r.json"), {"ölçüt": 1})
    assert json.loads((tmp_path / "deep" / "r.json").read_text(encoding="utf-8")) == {"ölçüt": 1}


def test_lock(spark, tmp_path):
    files = {n: tmp_path / n for n in "abcdef"}
    for n, p in files.items():
        p.write_text(n)
    lk = tmp_path / "lock.json"
    lock.write_lock(files, lk)
    assert lock.changed_inputs(files, lk) == []
    files["c"].write_text("changed")
    assert lock.changed_inputs(files, lk) == ["c"]
    try:
        lock.open_sealed_test(files, lk, tmp_path / "m")
    except RuntimeError as e:
        assert "c" in str(e)
    files["c"].write_text("c")
    lock.open_sealed_test(files, lk, tmp_path / "m")
    assert not lock.may_train(tmp_path / "m")
    hashed = {r.path.rsplit("/", 1)[1]: r.sha256 for r in lock.file_hashes(spark, str(tmp_path), "?").collect()}
    assert hashed["c"] == lock.sha256_of(files["c"])
