"""Tables that cut lineage: written once to the folder all executors share.

Iterative operators write their small intermediate tables as Parquet below the
folder named by ``spark.checkpoint.dir``.  A lost executor costs only a re-read.
Where the setting is missing a temporary folder is used, but only for a
single-JVM master; on a cluster that is an error, because a machine-local folder
would not be visible to other executors.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []
_LIVE: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, as a URI or path without a final slash."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    in_context = spark.sparkContext._jsc.sc().getCheckpointDir()
    if in_context.isDefined():
        return str(in_context.get()).rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="gradeloom-"))
    return _LOCAL_DIR[0]


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once below the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gradeloom/{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _LIVE[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._gradeloom_path = path  # noqa: SLF001 - remembered for release()
    return out


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that no later step reads."""
    for t in tables:
        path = getattr(t, "_gradeloom_path", None)
        if path and path in _LIVE:
            _delete(_LIVE.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone; the folder is temporary anyway
        pass


@atexit.register
def _clean() -> None:
    import shutil

    for path, spark in list(_LIVE.items()):
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)
    for d in _LOCAL_DIR:
        shutil.rmtree(d, ignore_errors=True)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition for each core ahead of a step whose cost is all CPU.

    Only a scan with fewer partitions than the cluster has cores, so a small table, is
    redistributed; a large one already has more and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()  # callers pass scans, so nothing runs for it
    return df if have >= cores else df.repartition(cores)
