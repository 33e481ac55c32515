"""Readers and writers: JSON documents, JSON lines, versioned Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import ustrip
from ..schemas import PREDICTION_DDL, RECORD_DDL


def read_records(spark: SparkSession, paths: str | Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One JSON document per file, typed; unreadable ones have ``corrupt`` set and the scan goes on.

    ``extra`` adds further paths, such as examples.  ``file_path`` names each row's file.
    """
    all_paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(f"{RECORD_DDL}, corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt")
    return reader.json([*all_paths, *extra]).withColumn("file_path", F.col("_metadata.file_path"))


def read_jsonl(spark: SparkSession, path: str, ddl: str = PREDICTION_DDL) -> DataFrame:
    """JSON lines; blank ones are skipped, lines that are no object of the schema have ``corrupt`` set.

    ``file_path`` and ``line_start`` (a running number within each file's partition) help to find a bad line.
    """
    raw = spark.read.text(path).withColumn("file_path", F.col("_metadata.file_path")).withColumn("line_start", F.monotonically_increasing_id())
    full = raw.where(ustrip(F.col("value")) != "")
    parsed = F.from_json("value", f"{ddl}, corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    is_object = ustrip(F.col("value")).startswith("{")
    out = full.select("file_path", "line_start", "value", parsed.alias("r")).select("file_path", "line_start", "value", "r.*")
    return out.withColumn("corrupt", F.when(~is_object, F.col("value")).otherwise(F.col("corrupt"))).drop("value")


def bad_lines(spark: SparkSession, path: str, ddl: str = PREDICTION_DDL) -> DataFrame:
    """``(file_path, line, value)`` of JSON lines that are no object of the schema, with their line number from 1.

    A file is read in blocks; the lines of the blocks before are counted in a pass of their
    own, one row for each block.  Blank lines count, but are no bad lines.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = raw.groupBy("file_path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file_path").orderBy("block")) - F.col("n")
    blocks = blocks.withColumn("before", before).drop("n")
    parsed = F.from_json("value", f"{ddl}, corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    bad = raw.where(ustrip(F.col("value")) != "").withColumn("r", parsed)
    bad = bad.where(F.col("r.corrupt").isNotNull() | ~ustrip(F.col("value")).startswith("{"))
    return bad.join(blocks, ["file_path", "block"]).select("file_path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def read_json_document(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One whole file as one row, null where it does not parse."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", ddl).alias("r")).select("r.*")


def flatten_strings(df: DataFrame, key: str, payload: str) -> DataFrame:
    """``(key, text)``: every string value anywhere in a JSON text; unreadable ones give none.

    No schema is needed: the compact form of the document is cut into quoted strings, those
    before a colon are keys, and escapes are undone.
    """
    compact = F.to_json(F.try_parse_json(F.col(payload)))
    pattern = F.lit(r'"((?:[^"\\]|\\.)*)"(:?)')
    both = F.arrays_zip(F.regexp_extract_all(compact, pattern, F.lit(1)).alias("s"), F.regexp_extract_all(compact, pattern, F.lit(2)).alias("c"))
    values = F.filter(both, lambda x: x["c"] == "")
    decoded = F.transform(values, lambda x: F.get_json_object(F.concat(F.lit('{"s":"'), x["s"], F.lit('"}')), "$.s"))
    return df.select(key, F.explode(decoded).alias("text"))


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version below ``root`` and return its path; readers of older ones are not disturbed."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.mode("error").partitionBy(*partition_by).parquet(path) if partition_by else df.write.mode("error").parquet(path)
    return path


def write_with_errors(df: DataFrame, good: str, bad: str, error: str = "error") -> bool:
    """Write rows without an error to ``good`` and the others to ``bad``; returns whether any went to ``bad``."""
    df.where(F.col(error).isNull()).drop(error).write.mode("error").json(good)
    wrong = df.where(F.col(error).isNotNull())
    if wrong.isEmpty():
        return False
    wrong.write.mode("error").json(bad)
    return True


def repo_root(start: str, marker: str) -> str:
    """The nearest folder at or above ``start`` that holds ``marker``."""
    from pathlib import Path

    here = Path(start).resolve()
    for d in (here, *here.parents):
        if (d / marker).exists():
            return str(d)
    raise FileNotFoundError(f"no {marker} at or above {start}")


def write_report(path: str, report: dict) -> None:
    """A small report as indented UTF-8 JSON with a final newline; folders are made as needed."""
    import json
    from pathlib import Path

    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(report, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
