"""Command line: ``python -m gradeloom.cli COMMAND RECORDS ...``.

Exit codes: 0 passed, 1 findings, 2 usage or input errors.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import export, links, metrics, quota, rules, split
from .session import build_session
from .sources.records import bad_lines, read_jsonl, read_records, write_version


def load(spark: SparkSession, path: str) -> DataFrame:
    """Parquet tables or folders of JSON documents."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    df = read_records(spark, path)
    return df.withColumn("record_key", F.monotonically_increasing_id()).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))


def findings(df: DataFrame, which: str) -> DataFrame:
    out = rules.apply_rules(df, "record_key", rules.record_rules()).unionByName(rules.duplicate_ids(df, "record_key"))
    out = out.unionByName(rules.apply_rules(df, "record_key", rules.rubric_schema_rules()))
    if which == "check":
        out = out.unionByName(rules.apply_rules(rules.verified_status(df), "record_key", rules.policy_rules()))
        out = out.unionByName(rules.leakage_findings(links.leakage(df)))
    return out


def _show(df: DataFrame, limit: int) -> None:
    rows = df.limit(limit + 1).collect()
    for r in rows[:limit]:
        print(json.dumps(r.asDict(True), ensure_ascii=False, default=str))
    if len(rows) > limit:
        print(f"only the first {limit} rows are shown; --limit shows more", file=sys.stderr)


def _strategy(path: str | None, phase: str | None) -> quota.Strategy:
    if not path:
        return quota.Strategy()
    with open(path, encoding="utf-8") as f:
        return quota.Strategy.from_json(json.load(f), phase)


def _names(df: DataFrame, col: str) -> str:
    """The first ten values."""
    return ", ".join(str(r[0]) for r in df.select(col).orderBy(col).limit(10).collect())


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gradeloom")
    p.add_argument("command", choices=["validate", "check", "leakage", "stats", "quota", "next-batch", "split", "export-sft", "evaluate"])
    p.add_argument("records")
    p.add_argument("--predictions")
    p.add_argument("--split", default="test")
    p.add_argument("--out")
    p.add_argument("--count", type=int, default=100)
    p.add_argument("--train", type=float, default=0.8)
    p.add_argument("--validation", type=float, default=0.1)
    p.add_argument("--seed", default="gradeloom-1")
    p.add_argument("--limit", type=int, default=1000, help="rows printed")
    p.add_argument("--config", help="strategy file")
    p.add_argument("--phase")
    p.add_argument("--lenient", action="store_true", help="score runs with missing, unknown, repeated or malformed predictions")
    try:
        a = p.parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    spark = build_session("gradeloom")
    try:
        df = load(spark, a.records)
        if a.command in ("validate", "check", "leakage"):
            found = rules.leakage_findings(links.leakage(df)) if a.command == "leakage" else findings(df, a.command)
            _show(rules.render(found), a.limit)
            return int(not found.where("level = 'error'").isEmpty())
        if a.command == "stats":
            _show(quota.dataset_stats(df).orderBy("axis", "category"), a.limit)
        elif a.command == "quota":
            _show(quota.production_report(quota.verified(df), _strategy(a.config, a.phase)).orderBy("section", "name", "category"), a.limit)
        elif a.command == "next-batch":
            _show(quota.next_batch(quota.verified(df), _strategy(a.config, a.phase), a.count), a.limit)
        elif a.command == "split":
            split.check_ratios(a.train, a.validation)
            hit = links.benchmark_collisions(quota.verified(df), "record_key")
            if not hit.isEmpty():
                print("records share link values with the benchmark: " + _names(df.join(hit, "record_key", "left_semi"), "id"), file=sys.stderr)
                return 1
            m = quota.verified(df).where(F.coalesce(F.col("metadata.split") != "benchmark", F.lit(True)))
            m = m.join(links.record_components(m, "record_key"), "record_key")
            s = split.balanced_split(m, a.train, a.validation, a.seed)
            mixed = s.where("conflict")
            if not mixed.isEmpty():
                print("components with more than one split: " + _names(mixed, "component"), file=sys.stderr)
                return 1
            out = m.select("id", "component").join(s, "component").select("id", "component", "split", "conflict")
            print(write_version(out, a.out)) if a.out else _show(out, a.limit)
        elif a.command == "export-sft":
            rows = export.sft_rows(df, a.split)
            export.write_sft(rows, a.out) if a.out else _show(export.chat_only(rows), a.limit)
        else:
            if not a.predictions:
                print("evaluate needs --predictions", file=sys.stderr)
                return 2
            if not a.predictions.endswith(".parquet"):
                broken = bad_lines(spark, a.predictions)
                if not a.lenient and not broken.isEmpty():
                    print("malformed lines: " + _names(broken.select(F.concat_ws(":", "file_path", "line").alias("at")), "at"), file=sys.stderr)
                    return 2
            preds = read_jsonl(spark, a.predictions) if not a.predictions.endswith(".parquet") else spark.read.parquet(a.predictions)
            if "run_id" not in preds.columns:
                preds = preds.where("corrupt is null").select(F.monotonically_increasing_id().alias("prediction_key"), F.lit("run").alias("run_id"), "id", "criterion_scores", "needs_review", F.lit(None).cast("timestamp_ntz").alias("produced_at"))
            gold = metrics.latest_gold(df, (a.split,))
            if not a.lenient:
                problems = metrics.first_offenders(metrics.strict_problems(preds, gold)).orderBy("run_id", "problem")
                if not problems.isEmpty():
                    _show(problems, a.limit)
                    return 2
            j = metrics.joined(metrics.latest_predictions(preds).where("criterion_scores is not null"), gold)
            _show(metrics.slice_metrics(metrics.score_rows(j)).orderBy("run_id", "dim", "value"), a.limit)
            return int(not metrics.contract_errors(j).isEmpty())
        return 0
    except (ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
