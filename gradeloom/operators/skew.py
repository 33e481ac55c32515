"""Joins against a table with one row per key, with the hot keys spread out.

A key is hot when it holds more than ``1/HOT_SHARE`` of the rows, so there can be
at most ``HOT_SHARE`` of them whatever the data: that list is the only thing
brought to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 64
SALTS = 32
#: Below this many rows a single task carries even the hottest key with ease.  The session
#: setting ``gradeloom.skew.leastRows`` overrides it; the result is the same at any value.
LEAST_ROWS = 2_000_000


def least_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("gradeloom.skew.leastRows", str(LEAST_ROWS)))


def hot_keys(counts: DataFrame, key: str, count: str, total: int) -> list:
    """Keys with more than ``total / HOT_SHARE`` rows; at most ``HOT_SHARE`` values."""
    if total < least_rows(counts.sparkSession):
        return []
    return [r[0] for r in counts.where(F.col(count) > F.lit(total / HOT_SHARE)).select(key).collect()]


def _salt(key: Column, hot: list, spread: Column) -> Column:
    return F.when(key.isin(hot), F.pmod(spread, F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))


def join_unique(rows: DataFrame, table: DataFrame, key: str, hot: list, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row per ``key``), hot keys split by ``spread``."""
    if not hot:
        return rows.join(table, key, how)
    left = rows.withColumn("__salt", _salt(F.col(key), hot, spread))
    zero = F.lit(0).cast("bigint")
    copies = F.when(F.col(key).isin(hot), F.sequence(zero, F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(zero))
    right = table.withColumn("__salt", F.explode(copies))
    return left.join(right, [key, "__salt"], how).drop("__salt")
