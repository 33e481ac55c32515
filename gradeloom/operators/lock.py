"""Locked experiment inputs and the sealed test gate; small files on the driver."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, length, sha256)`` of files, hashed where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def sha256_of(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_lock(inputs: dict[str, Path], lock: Path) -> dict[str, str]:
    payload = {name: sha256_of(Path(p)) for name, p in sorted(inputs.items())}
    lock.write_text(json.dumps(payload, indent=2) + "\n", encoding="utf-8")
    return payload


def changed_inputs(inputs: dict[str, Path], lock: Path) -> list[str]:
    """Names whose file is missing or differs from the lock, and names only one side knows."""
    want = json.loads(lock.read_text(encoding="utf-8"))
    now = {n: sha256_of(Path(p)) if Path(p).exists() else None for n, p in inputs.items()}
    return sorted(n for n in want.keys() | now.keys() if want.get(n) != now.get(n) or now.get(n) is None)


def open_sealed_test(inputs: dict[str, Path], lock: Path, marker: Path) -> None:
    """Allow one test run: the lock must hold, and the marker is written before the run starts."""
    if bad := changed_inputs(inputs, lock):
        raise RuntimeError(f"locked inputs changed: {', '.join(bad)}")
    if marker.exists():
        raise RuntimeError("the sealed test has been opened already")
    marker.write_text("opened\n", encoding="utf-8")


def may_train(marker: Path) -> bool:
    return not marker.exists()
