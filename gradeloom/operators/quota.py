"""Quotas: distributions against targets, ranges, coverage, next-batch apportionment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import half_even, is_true
from ..schemas import QUALITY_LEVELS, VERIFIED_STATUSES


@dataclass(frozen=True)
class Strategy:
    """Targets of a production phase; small, driver-side."""

    target_records: int = 6000
    distribution: dict[str, dict[str, float]] = field(
        default_factory=lambda: {
            "modality": {"written": 0.50, "speaking": 0.25, "listening": 0.25},
            "grade": {"9": 0.25, "10": 0.25, "11": 0.25, "12": 0.25},
            "response_quality": dict(zip(QUALITY_LEVELS, (0.20, 0.20, 0.20, 0.15, 0.10, 0.05, 0.10))),
        }
    )
    ranges: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {"needs_review": (0.08, 0.12), "hard_case": (0.15, 0.20), "adversarial": (0.03, 0.05), "dual_review_overall": (0.20, 1.00)}
    )
    per_task: tuple[int, int] = (8, 20)
    per_family: tuple[int, int] = (20, 40)

    @classmethod
    def from_json(cls, conf: dict, phase: str | None = None) -> Strategy:
        """From a strategy file's content; ``phase`` falls back to its ``default_phase``."""
        cov = conf["question_coverage"]
        return cls(
            conf["phases"][phase or conf["default_phase"]]["target_records"],
            {a: {str(k): float(v) for k, v in t.items()} for a, t in conf["target_distribution"].items()},
            {k: (float(a), float(b)) for k, (a, b) in conf["target_ranges"].items()},
            tuple(cov["answers_per_exact_task"]),
            tuple(cov["answers_per_question_family"]),
        )


#: Where each axis of a distribution lives in a record.
AXES = {"modality": "modality", "grade": "grade", "response_quality": "metadata.response_quality"}


def verified(records: DataFrame) -> DataFrame:
    """Verified status and reviewed for personal data; a null flag is not true."""
    return records.where(F.col("metadata.status").isin(*VERIFIED_STATUSES) & is_true(F.col("metadata.pii_reviewed")))


def dataset_stats(records: DataFrame) -> DataFrame:
    """``(axis, category, n)``: totals by modality, status and split, verified and review counts, in one pass."""
    ok = F.col("metadata.status").isin(*VERIFIED_STATUSES) & is_true(F.col("metadata.pii_reviewed"))
    cell = lambda axis, c: F.struct(F.lit(axis).alias("axis"), c.alias("category"))
    cells = F.array(
        cell("total", F.lit("all")),
        cell("modality", F.coalesce("modality", F.lit("<missing>"))),
        cell("status", F.coalesce(F.col("metadata.status"), F.lit("<missing>"))),
        cell("split", F.coalesce(F.col("metadata.split"), F.lit("unassigned"))),
        F.when(ok, cell("verified", F.lit("yes"))),
        F.when(is_true(F.col("gold_evaluation.needs_review")), cell("needs_review", F.lit("yes"))),
    )
    return records.select(F.explode(F.array_compact(cells)).alias("c")).groupBy("c.axis", "c.category").agg(F.count("*").alias("n"))


def axis_counts(records: DataFrame, axes: dict[str, str] | None = None) -> DataFrame:
    """``(axis, category, actual)`` with null categories as ``<missing>``; one aggregation for all axes."""
    cells = F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(p).cast("string"), F.lit("<missing>")).alias("category")) for a, p in (axes or AXES).items()])
    return records.select(F.explode(cells).alias("c")).groupBy("c.axis", "c.category").agg(F.count("*").alias("actual"))


def _targets(spark, strategy: Strategy) -> DataFrame:
    rows = [(a, c, float(r), k) for a, t in strategy.distribution.items() for k, (c, r) in enumerate(t.items())]
    return spark.createDataFrame(rows, "axis string, category string, ratio double, pos int")


def distribution(records: DataFrame, strategy: Strategy) -> DataFrame:
    """``(axis, category, ratio, pos, actual, target, gap, share)`` for the configured categories.

    Targets round half to even; ``share`` divides by all observed rows of the axis, also
    those of categories without a target; it is 0.0 for an empty table.
    """
    counts = axis_counts(records)
    whole = counts.groupBy("axis").agg(F.sum("actual").alias("observed"))
    t = _targets(records.sparkSession, strategy).join(counts, ["axis", "category"], "left").join(whole, "axis", "left")
    actual = F.coalesce("actual", F.lit(0)).cast("bigint")
    target = half_even(F.lit(float(strategy.target_records)) * F.col("ratio"))
    share = F.coalesce(F.try_divide(actual.cast("double"), F.col("observed").cast("double")), F.lit(0.0))
    return t.select("axis", "category", "ratio", "pos", actual.alias("actual"), target.alias("target"), F.greatest(F.lit(0).cast("bigint"), target - actual).alias("gap"), share.alias("share"))


def range_status(records: DataFrame, strategy: Strategy) -> DataFrame:
    """``(name, n, total, rate, low, high, status, min_count, max_count)`` of the special rates, from one pass."""
    m = F.col("metadata")
    flags = {
        "needs_review": is_true(F.col("gold_evaluation.needs_review")),
        "hard_case": F.coalesce(F.size(m["hard_case_types"]) > 0, F.lit(False)),
        "adversarial": is_true(m["adversarial"]),
        "dual_review_overall": F.coalesce(m["review_count"], F.lit(0)) >= 2,
    }
    one = records.agg(F.count("*").alias("total"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("n"), F.lit(lo).alias("low"), F.lit(hi).alias("high")) for k, (lo, hi) in strategy.ranges.items() if k in flags]))
    rate = F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    out = one.select("total", rows.alias("r")).select("r.*", "total").withColumn("rate", rate)
    status = F.when(F.col("rate") < F.col("low"), "under").when(F.col("rate") > F.col("high"), "over").otherwise("in_range")
    at = lambda c: half_even(F.lit(float(strategy.target_records)) * F.col(c))
    return out.select("name", "n", "total", "rate", "low", "high", status.alias("status"), at("low").alias("min_count"), at("high").alias("max_count"))


def coverage(records: DataFrame, key: Column, low: int, high: int) -> DataFrame:
    """One row ``(keys, mean, below_min, in_range, above_max)`` over the counts of a key; null and empty keys are skipped."""
    per = records.select(key.alias("k")).where("k is not null and k <> ''").groupBy("k").agg(F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean"),
        F.count_if(F.col("n") < low).alias("below_min"),
        F.count_if(F.col("n").between(low, high)).alias("in_range"),
        F.count_if(F.col("n") > high).alias("above_max"),
    )


def rubric_diversity(records: DataFrame) -> DataFrame:
    """``(criterion_count, n, rubrics)``: histogram of rubric sizes with distinct rubric ids."""
    size = F.coalesce(F.size("rubric.criteria"), F.lit(0))
    return records.groupBy(F.greatest(size, F.lit(0)).alias("criterion_count")).agg(F.count("*").alias("n"), F.count_distinct("rubric.rubric_id").alias("rubrics"))


def two_way(records: DataFrame, a: Column, b: Column) -> DataFrame:
    """Cube of two axes; ``<all>`` marks a margin, ``<missing>`` a null category."""
    base = records.select(F.coalesce(a.cast("string"), F.lit("<missing>")).alias("a"), F.coalesce(b.cast("string"), F.lit("<missing>")).alias("b"))
    return base.cube("a", "b").agg(F.count("*").alias("n")).select(F.coalesce("a", F.lit("<all>")).alias("a"), F.coalesce("b", F.lit("<all>")).alias("b"), "n")


def apportion(weights: DataFrame, count: int, group: list[str], weight: str, ratio: str, pos: str) -> DataFrame:
    """Largest-remainder allocation of ``count`` within each group: adds ``allocated``.

    Weights are the positive deficits, or the ratios where a group has none.  The rest goes
    to the largest fractions, then the largest weights, then by position.  A count of zero or
    less allocates nothing.  Groups are axes of a strategy, a handful of rows each.
    """
    w = Window.partitionBy(*group)
    deficit = F.greatest(F.lit(0.0), F.coalesce(F.col(weight).cast("double"), F.lit(0.0)))
    df = weights.withColumn("__d", deficit)
    df = df.withColumn("__w", F.when(F.sum("__d").over(w) == 0, F.col(ratio).cast("double")).otherwise(F.col("__d")))
    raw = F.coalesce(F.try_divide(F.lit(float(max(count, 0))) * F.col("__w"), F.sum("__w").over(w)), F.lit(0.0))
    df = df.withColumn("__raw", raw).withColumn("__base", F.floor("__raw").cast("bigint"))
    df = df.withColumn("__left", F.lit(max(count, 0)).cast("bigint") - F.sum("__base").over(w))
    order = Window.partitionBy(*group).orderBy(F.desc(F.col("__raw") - F.col("__base")), F.desc("__w"), F.col(pos))
    extra = F.when(F.row_number().over(order) <= F.col("__left"), 1).otherwise(0)
    return df.withColumn("allocated", (F.col("__base") + extra).cast("bigint")).drop("__d", "__w", "__raw", "__base", "__left")


def next_batch(records: DataFrame, strategy: Strategy, count: int) -> DataFrame:
    """``(axis, category, allocated)``: each axis apportioned by its gaps, plus the minimum of special cases."""
    plan = apportion(distribution(records, strategy), count, ["axis"], "gap", "ratio", "pos").select("axis", "category", "allocated")
    special = [("special_minimum", k, lo) for k, (lo, _) in strategy.ranges.items()]
    extra = records.sparkSession.createDataFrame(special, "axis string, category string, low double")
    return plan.unionByName(extra.select("axis", "category", half_even(F.lit(float(max(count, 0))) * F.col("low")).alias("allocated")))


def assert_distribution(counts: DataFrame, expected: dict[str, dict[str, int]]) -> None:
    """Raise unless the counts of each axis are exactly as expected (manifest invariant)."""
    limit = sum(len(v) for v in expected.values()) + 100
    got: dict[str, dict[str, int]] = {a: {} for a in expected}
    for r in counts.where(F.col("axis").isin(*expected)).limit(limit + 1).collect():
        got[r["axis"]][r["category"]] = r["actual"]
    wrong = {a: (expected[a], got[a]) for a in expected if expected[a] != got[a]}
    if wrong:
        raise ValueError(f"distribution differs from the manifest: {wrong}")


def production_report(records: DataFrame, strategy: Strategy) -> DataFrame:
    """``(section, name, category, value, target, status)``: the whole quota report of verified records.

    Sections: ``total``, ``verification_source``, ``distribution``, ``range``, ``coverage`` and ``rubric``.
    """
    num = lambda c: c.cast("double")
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    row = lambda section, name, category, value, target=none, status=text: (F.lit(section).alias("section"), name.alias("name"), category.alias("category"), num(value).alias("value"), num(target).alias("target"), status.alias("status"))
    goal = F.lit(float(strategy.target_records))
    parts = [records.agg(F.count("*").alias("n")).select(*row("total", F.lit("verified_records"), F.lit("all"), F.col("n"), goal, F.when(F.col("n") >= goal, "reached").otherwise("open")))]
    source = F.coalesce(F.nullif("metadata.verification_source", F.lit("")), F.lit("<missing>"))
    parts.append(records.groupBy(source.alias("s")).agg(F.count("*").alias("n")).select(*row("verification_source", F.lit("verification_source"), F.col("s"), F.col("n"))))
    d = distribution(records, strategy)
    parts.append(d.select(*row("distribution", F.col("axis"), F.col("category"), F.col("actual"), F.col("target"), F.when(F.col("gap") > 0, "under").otherwise("reached"))))
    r = range_status(records, strategy)
    parts.append(r.select(*row("range", F.col("name"), F.lit("rate"), F.col("rate"), F.col("low"), F.col("status"))))
    for name, key, (lo, hi) in (("exact_tasks", F.col("task.task_id"), strategy.per_task), ("question_families", F.col("metadata.question_family"), strategy.per_family)):
        c = coverage(records, key, lo, hi)
        cells = F.explode(F.array(*[F.struct(F.lit(x).alias("k"), num(F.col(x)).alias("v")) for x in ("keys", "mean", "below_min", "in_range", "above_max")]))
        parts.append(c.select(cells.alias("x")).select(*row("coverage", F.lit(name), F.col("x.k"), F.col("x.v"))))
    parts.append(rubric_diversity(records).select(*row("rubric", F.lit("criterion_count"), F.col("criterion_count").cast("string"), F.col("n"), F.col("rubrics"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def density(records: DataFrame, per_family: int, per_task: int) -> DataFrame:
    """``(level, key, n, wanted)`` of families and tasks whose number of answers is not the wanted one; blank keys are skipped."""
    cells = F.array(F.struct(F.lit("question_family").alias("level"), F.col("metadata.question_family").alias("key"), F.lit(per_family).alias("wanted")), F.struct(F.lit("task").alias("level"), F.col("task.task_id").alias("key"), F.lit(per_task).alias("wanted")))
    g = records.select(F.explode(cells).alias("c")).where("c.key is not null and c.key <> ''").groupBy("c.level", "c.key", "c.wanted").agg(F.count("*").alias("n"))
    return g.where("n <> wanted").select("level", "key", "n", "wanted")


def canonical_summary(records: DataFrame) -> DataFrame:
    """``(axis, category, n)`` after a build: modality, grade, quality and the special cases."""
    m = F.col("metadata")
    cell = lambda a, c: F.struct(F.lit(a).alias("axis"), c.alias("category"))
    flag = lambda a, c: F.when(F.coalesce(c, F.lit(False)), cell(a, F.lit("yes")))
    miss = lambda c: F.coalesce(c.cast("string"), F.lit("<missing>"))
    cells = F.array(
        cell("modality", miss(F.col("modality"))),
        cell("grade", miss(F.col("grade"))),
        cell("response_quality", miss(m["response_quality"])),
        flag("hard_case_records", F.size(m["hard_case_types"]) > 0),
        flag("adversarial_records", m["adversarial"]),
        flag("needs_review_records", F.col("gold_evaluation.needs_review")),
        flag("second_pass_records", m["review_count"] >= 2),
    )
    return records.select(F.explode(F.array_compact(cells)).alias("c")).groupBy("c.axis", "c.category").agg(F.count("*").alias("n"))
