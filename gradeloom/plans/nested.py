"""Queries of problem 4: nested records as related flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.nested import flatten_payloads, flatten_typed
from .tables import table


def p4_found(spark, d):
    rows = flatten_payloads(table(spark, d, "raw_records"), "raw_id", "payload", bodies=False)
    return rows.select("raw_id", "child", "parent_pos", "pos")


def p4_elements(spark, d):
    """Every element with its id and its own JSON."""
    return flatten_payloads(table(spark, d, "raw_records"), "raw_id", "payload")


def p4_typed(spark, d):
    return flatten_typed(table(spark, d, "records"), "record_key").select("record_key", "child", "parent_pos", F.col("pos").cast("int").alias("pos"), "element_id")


QUERIES = {"p4_found": p4_found, "p4_elements": p4_elements, "p4_typed": p4_typed}

SQL = {
    "p4_typed": """
WITH c AS (SELECT record_key, unnest(rubric.criteria) AS c, unnest(range(len(rubric.criteria))) AS pos FROM records),
r AS (SELECT record_key, list_transform(rubric.criteria, lambda x: x.criterion_id) AS ids,
      unnest(gold_evaluation.criterion_results) AS r, unnest(range(len(gold_evaluation.criterion_results))) AS pos FROM records),
a AS (SELECT record_key, pos AS parent_pos, unnest(c.scoring_anchors) AS a, unnest(range(len(c.scoring_anchors))) AS pos FROM c WHERE c IS NOT NULL)
SELECT record_key, 'criteria' AS child, CAST(-1 AS INTEGER) AS parent_pos, CAST(pos AS INTEGER) AS pos, c.criterion_id AS element_id FROM c WHERE c IS NOT NULL
UNION ALL SELECT record_key, 'scoring_anchors', CAST(parent_pos AS INTEGER), CAST(pos AS INTEGER), NULL FROM a WHERE a IS NOT NULL
UNION ALL SELECT record_key, 'criterion_results',
  CAST(CASE WHEN r.criterion_id IS NULL THEN -1 ELSE coalesce(list_position(ids, r.criterion_id), 0) - 1 END AS INTEGER), CAST(pos AS INTEGER), r.criterion_id FROM r WHERE r IS NOT NULL
""",
}
