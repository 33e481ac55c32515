"""Samples that match target shares of categories.

One pass over the eligible records keeps, for each plan and category, a reservoir: the
records with the smallest hash priorities, at most as many as the plan's sample, and the
count of all that were seen.  Reservoirs of different workers merge by keeping the smallest
priorities again, so every draw is uniform and repeatable.

After the final counts the quotas of a plan are made feasible: they add up to the sample
size, no category falls under its minimum (or what it has), none gets more than it has, and
room that an exhausted category or another's minimum leaves or takes is shared in proportion
to the targets.  Each reservoir is then trimmed to its quota; categories with fewer records
than their target are reported as exhausted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import is_true, ustrip
from ..storage import materialize

#: Statuses that make a record eligible.
VERIFIED = ("ai_verified", "teacher_verified")
MAX_TARGETS = 10_000
SEED = "gradeloom-sample-1"
#: Buckets of priorities below the expected cut of a category, and the last of all.
CUT_BUCKETS, LAST_BUCKET = 2048, 1 << 15


def norm_category(c: Column) -> Column:
    """Trimmed, lower-cased, ``-`` and inner white space read as ``_``."""
    return F.regexp_replace(F.lower(ustrip(c)), r"(?U)[\s-]", "_")


def latest(records: DataFrame) -> DataFrame:
    """The row of each id with the greatest ``ingested_at``, then ``record_key`` (null ids form one group).

    ``max_by`` combines before the shuffle, so an id with a third of all rows costs nothing.
    A null ``ingested_at`` is earlier than any other.
    """
    fields = F.struct(
        F.col("metadata.status").alias("status"),
        F.col("metadata.pii_reviewed").alias("pii"),
        "modality",
        F.col("grade").cast("string").alias("grade"),
        F.col("metadata.response_quality").alias("response_quality"),
        F.col("metadata.hard_case_types").alias("hard_case_types"),
        "record_key",
    )
    order = F.struct(F.col("ingested_at").isNotNull().alias("a"), F.col("ingested_at").alias("t"), F.col("record_key").alias("k"))
    return records.groupBy("id").agg(F.max_by(fields, order).alias("r")).select("id", "r.*")


def eligible(records: DataFrame) -> DataFrame:
    return latest(records).where(norm_category(F.col("status")).isin(*VERIFIED) & is_true(F.col("pii")))


def _values(field: str) -> Column:
    """Distinct category values of a record for a target field; ``a+b`` pairs two fields."""
    if field == "hard_case_types":
        v = F.filter(F.transform("hard_case_types", norm_category), lambda x: x.isNotNull() & (x != ""))
        return F.array_distinct(F.coalesce(v, F.array().cast("array<string>")))
    parts = [norm_category(F.col(p)) for p in field.split("+")]
    whole = F.concat(*[x for p in parts for x in (F.lit("+"), p)][1:])
    return F.array_compact(F.array(whole))


def _tagged(field: str) -> Column:
    return F.transform(_values(field), lambda v: F.concat(F.lit(f"{field}\x1f"), v))


class Plans:
    """The target table, checked to be small, with the quota of each category."""

    def __init__(self, targets: DataFrame):
        rows = targets.select("plan_id", "field", "category", "target_share", "min_count", "sample_size").limit(MAX_TARGETS + 1).collect()
        if len(rows) > MAX_TARGETS:
            raise ValueError(f"more than {MAX_TARGETS} target rows")
        self.rows = [r for r in rows if r["plan_id"] is not None and r["field"] and r["category"] is not None]

    def frame(self, spark) -> DataFrame:
        need = F.greatest(F.coalesce("min_count", F.lit(0)), F.ceil((F.col("target_share").cast("decimal(20,9)") * F.col("sample_size").cast("decimal(12,0)")).cast("decimal(30,9)"))).cast("bigint")
        df = spark.createDataFrame([tuple(r) for r in self.rows], "plan_id int, field string, category string, target_share double, min_count int, sample_size int")
        return df.withColumn("need", F.coalesce(need, F.lit(0).cast("bigint"))).withColumn("norm", F.array_join(F.transform(F.split("category", r"\+"), norm_category), "+"))

    @property
    def fields(self) -> list[str]:
        return sorted({r["field"] for r in self.rows})


def reservoirs(records: DataFrame, plans: Plans) -> DataFrame:
    """Partial reservoirs of each worker: ``(plan_id, field, norm, seen, record_key, priority)``.

    ``seen`` is the worker's count of the category, written on its first row only.
    """
    spark = records.sparkSession
    t = plans.frame(spark)
    # a category can be asked for what others lack: the whole sample at most
    rows = t.select("plan_id", "field", "norm", F.greatest("need", F.coalesce("sample_size", F.lit(0))).alias("need")).collect()
    where: dict[tuple[str, str], list[int]] = {}
    for i, r in enumerate(rows):
        where.setdefault((r["field"], r["norm"]), []).append(i)
    need = np.array([r["need"] for r in rows], np.int64)
    base = eligible(records)
    tagged = F.flatten(F.array(*[_tagged(f) for f in plans.fields])) if plans.fields else F.array().cast("array<string>")
    members = base.select("record_key", F.xxhash64(F.lit(SEED), "id", "record_key").alias("priority"), tagged.alias("tags"))
    index = {f"{f}\x1f{v}": ids for (f, v), ids in where.items()}
    schema = pa.schema([("slot", pa.int32()), ("seen", pa.int64()), ("record_key", pa.int64()), ("priority", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(rows), np.int64)
        held: dict[int, list] = {}  # keys and priorities in parts, their number, the priority no record may exceed

        def compact(h: list, n: int) -> None:
            k, p = np.concatenate(h[0]), np.concatenate(h[1])
            if len(k) > n:
                o = np.lexsort((k, p))[:n]
                k, p = k[o], p[o]
                h[3] = p[-1] if n else None
            h[0], h[1], h[2] = [k], [p], len(k)

        for b in batches:
            tags = b.column(2)
            flat, rep = pc.list_flatten(tags), np.asarray(pc.list_parent_indices(tags))
            enc = flat.dictionary_encode()
            names, codes = enc.dictionary.to_pylist(), np.asarray(enc.indices)
            keys, pri = np.asarray(b.column(0)), np.asarray(b.column(1))
            for c, name in enumerate(names):
                for slot in index.get(name, ()):
                    at = rep[codes == c]
                    seen[slot] += len(at)
                    k, p = keys[at], pri[at]
                    h = held.setdefault(slot, [[], [], 0, None])
                    if h[3] is not None:
                        k, p = k[p <= h[3]], p[p <= h[3]]
                    h[0].append(k)
                    h[1].append(p)
                    h[2] += len(k)
                    if h[2] > 2 * need[slot]:
                        compact(h, int(need[slot]))
        for slot in np.flatnonzero(seen).tolist():
            compact(held[slot], int(need[slot]))
            k, p = held[slot][0][0], held[slot][1][0]
            # a row without a record carries the count
            yield pa.RecordBatch.from_arrays([pa.array([slot] * (len(k) + 1), pa.int32()), pa.array([int(seen[slot])] + [0] * len(k)), pa.array([None, *k.tolist()], pa.int64()), pa.array([None, *p.tolist()], pa.int64())], schema=schema)

    part = members.where(F.size("tags") > 0).mapInArrow(run, "slot int, seen bigint, record_key bigint, priority bigint")
    slots = spark.createDataFrame([(i, r["plan_id"], r["field"], r["norm"]) for i, r in enumerate(rows)], "slot int, plan_id int, field string, norm string")
    # one row per target: MAX_TARGETS at most
    return materialize(part.join(F.broadcast(slots), "slot").select("plan_id", "field", "norm", "seen", "record_key", "priority"), "reservoirs")


def category_report(res: DataFrame, plans: Plans) -> DataFrame:
    """``(plan_id, field, category, need, available, short)`` for each target row."""
    counts = res.groupBy("plan_id", "field", "norm").agg(F.sum("seen").alias("seen"))
    t = plans.frame(res.sparkSession)
    out = t.join(counts, ["plan_id", "field", "norm"], "left").withColumn("available", F.coalesce("seen", F.lit(0).cast("bigint")))
    return out.select("plan_id", "field", "category", "target_share", "sample_size", "need", "available", (F.col("available") < F.col("need")).alias("short"))


def feasible(size: int, shares: list[float], mins: list[int], have: list[int]) -> list[int]:
    """Quotas of one plan: near ``shares`` of ``size``, within ``have``, at least ``mins`` where there are so many.

    They add up to ``size``, to all there is if that is less, and to the minimums if those are more.
    """
    low = [min(max(m, 0), h) for m, h in zip(mins, have)]
    total = max(sum(low), min(size, sum(h for h, s in zip(have, shares) if s > 0) + sum(x for x, s in zip(low, shares) if s <= 0)))
    at = lambda f: [min(max(f * s, x), h) for s, x, h in zip(shares, low, have)]
    lo, hi = 0.0, 1.0
    while sum(at(hi)) < total and hi < 1e18:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(at(mid)) < total else (lo, mid)
    exact = at(hi)
    # what floating point leaves below a whole number is that number
    out = [int(x + 1e-6) for x in exact]
    rest = total - sum(out)
    for i in sorted(range(len(out)), key=lambda i: (out[i] - exact[i], i)):
        if rest > 0 and out[i] < have[i] and shares[i] > 0:
            out[i], rest = out[i] + 1, rest - 1
    return out


def quotas(res: DataFrame, plans: Plans) -> DataFrame:
    """``(plan_id, field, category, norm, target_share, sample_size, min_count, available, quota, achieved_share)``.

    Worked out on the driver over the target rows, of which there are at most ``MAX_TARGETS``.
    """
    spark = res.sparkSession
    seen = {(r["plan_id"], r["field"], r["norm"]): r["n"] for r in res.groupBy("plan_id", "field", "norm").agg(F.sum("seen").alias("n")).collect()}
    by_plan: dict[int, list] = {}
    for r in plans.frame(spark).orderBy("plan_id", "field", "category").collect():
        by_plan.setdefault(r["plan_id"], []).append(r)
    out = []
    for plan, rows in by_plan.items():
        have = [seen.get((plan, r["field"], r["norm"]), 0) for r in rows]
        size = max(r["sample_size"] or 0 for r in rows)
        got = feasible(size, [max(r["target_share"] or 0.0, 0.0) for r in rows], [r["min_count"] or 0 for r in rows], have)
        whole = sum(got)
        out += [(plan, r["field"], r["category"], r["norm"], r["target_share"], r["sample_size"], r["min_count"], h, q, q / whole if whole else None) for r, h, q in zip(rows, have, got)]
    return spark.createDataFrame(out, "plan_id int, field string, category string, norm string, target_share double, sample_size int, min_count int, available bigint, quota bigint, achieved_share double")


def draw(res: DataFrame, plans: Plans) -> DataFrame:
    """``(plan_id, field, category, record_key)``: each reservoir trimmed to its feasible quota.

    A record that falls into several hard-case types can be drawn for each of them.  The cut
    is found on counts of priority buckets, so no task holds a category: only the records of
    the one bucket in which the quota ends are ranked.
    """
    slot = ["plan_id", "field", "norm"]
    t = quotas(res, plans).where("quota > 0").select(*slot, "category", "quota", (F.col("available") / F.col("quota") * CUT_BUCKETS).alias("scale"))
    # t and the cuts have one row for each target: MAX_TARGETS at most
    unit = (F.col("priority").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    rows = res.where("record_key is not null").join(F.broadcast(t), slot).withColumn("b", F.least(F.floor(unit * F.col("scale")), F.lit(LAST_BUCKET)).cast("int"))
    key = ["plan_id", "field", "category"]
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("b"))  # LAST_BUCKET + 1 rows for a target at most
    cuts = rows.groupBy(*key, "b", "quota").agg(F.count("*").alias("n")).withColumn("upto", upto)
    cuts = cuts.where("upto > quota and upto - n <= quota").select(*key, F.col("b").alias("cut"), (F.col("quota") - F.col("upto") + F.col("n")).alias("left"))
    cuts = cuts.groupBy(*key).agg(F.min(F.struct("cut", "left")).alias("c")).select(*key, "c.*")
    rows = rows.select(*key, "record_key", "priority", "b").join(F.broadcast(cuts), key, "left")
    whole = rows.where("cut is null or b < cut")
    last = rows.where("b = cut").withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("priority", "record_key"))).where("rank <= left")
    return whole.select(*key, "record_key").unionByName(last.select(*key, "record_key"))
