"""Link keys of records: projection, components, leakage, benchmark isolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .components import connected_components
from .skew import hot_keys, join_unique

#: The four fields that tie records together.
LINK_FIELDS = {
    "task_id": "task.task_id",
    "subject_group_id": "metadata.subject_group_id",
    "exam_family": "metadata.exam_family",
    "question_family": "metadata.question_family",
}


def link_array(fields: dict[str, Column]) -> Column:
    """``array<struct<field,value>>`` of the link values that are neither null nor empty."""
    entries = [F.struct(F.lit(f).alias("field"), c.alias("value")) for f, c in fields.items()]
    return F.filter(F.array(*entries), lambda x: x["value"].isNotNull() & (x["value"] != ""))


def explode_links(records: DataFrame, key: str, fields: dict[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each link value of a record: ``(key, *keep, field, value)``."""
    cols = {f: F.col(p) for f, p in (fields or LINK_FIELDS).items()}
    return records.select(key, *keep, F.explode(link_array(cols)).alias("l")).select(key, *keep, "l.field", "l.value")


def record_components(records: DataFrame, key: str, fields: dict[str, str] | None = None) -> DataFrame:
    """``(key, component)``: records that share any link value, directly or through others.

    ``component`` is the smallest ``field=value`` of the group, or ``id=<key>`` for
    a record without link values.  Distinct key sets are reduced first, so a value
    on a third of all records contributes one edge for each distinct key set.
    """
    cols = {f: F.col(p) for f, p in (fields or LINK_FIELDS).items()}
    tagged = F.transform(link_array(cols), lambda x: F.concat(x["field"], F.lit("="), x["value"]))
    keyed = records.select(F.col(key).alias("rid"), F.array_sort(tagged).alias("ks"))
    node = F.try_element_at("ks", F.lit(1))
    sets = materialize(keyed.where(F.size("ks") > 0).groupBy("ks").agg(F.count("*").alias("n")).withColumn("node", node), "key-sets")
    hot = hot_keys(sets.groupBy("node").agg(F.sum("n").alias("n")), "node", "n", sets.agg(F.sum("n")).first()[0] or 0)
    edges = sets.select(F.col("ks")[0].alias("a"), F.explode("ks").alias("b"))
    comp = connected_components(edges)
    labelled = join_unique(keyed.withColumn("node", node), comp, "node", hot, F.xxhash64("rid"), "left")
    label = F.coalesce("root", F.concat(F.lit("id="), F.col("rid").cast("string")))
    return labelled.select(F.col("rid").alias(key), label.alias("component"))


def leakage(records: DataFrame, fields: dict[str, str] | None = None, split: str = "metadata.split") -> DataFrame:
    """Link values found in more than one split: ``(field, value, splits, n_splits)``.

    Every record with a split takes part, verified or not.  ``splits`` is sorted and
    comma-separated.  The set of splits is tiny, so ``collect_set`` is bounded.
    """
    links = explode_links(records.where(F.col(split).isNotNull()).withColumn("__split", F.col(split)), "__split", fields)
    found = links.groupBy("field", "value").agg(F.array_sort(F.collect_set("__split")).alias("s"))
    return found.where(F.size("s") > 1).select("field", "value", F.array_join("s", ",").alias("splits"), F.size("s").cast("bigint").alias("n_splits"))


def benchmark_collisions(records: DataFrame, key: str, fields: dict[str, str] | None = None, split: str = "metadata.split") -> DataFrame:
    """Non-benchmark records that share any link value with a benchmark record (an OR of equi-joins)."""
    links = explode_links(records.withColumn("__bench", F.coalesce(F.col(split) == "benchmark", F.lit(False))), key, fields, ["__bench"])
    bench = links.where("__bench").select("field", "value").distinct()
    return links.where("not __bench").join(bench, ["field", "value"], "left_semi").select(key).distinct()
