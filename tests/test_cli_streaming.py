from pyspark.sql import functions as F

from gradeloom import cli
from gradeloom.streaming import quota as S

from .conftest import SF


def test_commands(spark, capsys, tmp_path):
    rec = f"{SF}/records.parquet"
    assert cli.main(["stats", rec]) == 0 and '"axis": "total"' in capsys.readouterr().out
    assert cli.main(["check", rec]) == 1
    assert cli.main(["next-batch", rec, "--count", "17"]) == 0
    args = ["evaluate", rec, "--predictions", f"{SF}/predictions.parquet", "--split", "test"]
    assert cli.main([*args, "--lenient"]) in (0, 1)
    # runs that answer part of the split, know other ids or repeat theirs are not scored
    assert cli.main(args) == 2 and '"problem": "missing"' in capsys.readouterr().out
    assert cli.main(["quota", rec]) == 0 and '"section": "coverage"' in capsys.readouterr().out
    assert cli.main(["export-sft", rec, "--split", "train", "--out", str(tmp_path / "sft")]) == 0
    assert cli.main(["split", rec, "--train", "2"]) == 2
    assert cli.main(["nonsense", rec]) == 2


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    src = tmp_path / "in"
    events.repartition(3).write.parquet(str(src))
    events.write.mode("append").parquet(str(src))  # delivered again
    stream = S.read_table_stream(spark, str(src), events)
    once = S.first_deliveries(stream, "event_id", "ts", "3650 days")
    S.run_once(once, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == events.select("event_id").distinct().count()
    counts = S.window_counts(S.read_table_stream(spark, str(src), events), "ts", F.col("event_type"), "1 day", "1 day")
    assert counts.isStreaming and counts.columns == ["start", "end", "key", "n"]
