import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gradeloom.operators import quota
from pyspark.sql import functions as F

from .factory import frame, record


def naive(weights, ratios, count):
    if count <= 0:
        return [0] * len(weights)
    w = [max(0, x) for x in weights]
    if sum(w) == 0:
        w = ratios
    raw = [count * x / sum(w) for x in w]
    base = [int(x) for x in raw]
    order = sorted(range(len(w)), key=lambda i: (raw[i] - base[i], w[i]), reverse=True)
    for i in order[: count - sum(base)]:
        base[i] += 1
    return base


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 60), min_size=1, max_size=7), st.integers(-2, 80))
def test_apportion(spark, gaps, count):
    ratios = [1.0 / len(gaps)] * len(gaps)
    df = spark.createDataFrame([("g", i, g, r) for i, (g, r) in enumerate(zip(gaps, ratios))], "a string, pos int, gap int, ratio double")
    got = [r.allocated for r in quota.apportion(df, count, ["a"], "gap", "ratio", "pos").orderBy("pos").collect()]
    assert sum(got) == max(count, 0)
    assert got == naive(gaps, ratios, count)


def test_half_even_targets_and_shares(spark):
    s = quota.Strategy(target_records=5, distribution={"modality": {"written": 0.5, "speaking": 0.1}})
    rows = [record(1), record(2, modality="other")]
    got = {r.category: r for r in quota.distribution(frame(spark, rows), s).collect()}
    assert got["written"].target == 2 and got["written"].gap == 1 and got["written"].share == 0.5
    assert got["speaking"].target == 0 and got["speaking"].actual == 0
    empty = {r.category: r.share for r in quota.distribution(frame(spark, []), s).collect()}
    assert empty == {"written": 0.0, "speaking": 0.0}


def test_ranges_coverage_on_empty(spark):
    df = frame(spark, [])
    assert {r.rate for r in quota.range_status(df, quota.Strategy()).collect()} == {0.0}
    assert quota.coverage(df, F.col("task.task_id"), 1, 2).first().mean == 0.0


def test_next_batch_sums(spark):
    got = quota.next_batch(frame(spark, [record(i) for i in range(3)]), quota.Strategy(), 17).collect()
    for axis in ("modality", "grade", "response_quality"):
        assert sum(r.allocated for r in got if r.axis == axis) == 17
    assert math.isclose(len(got), 14 + 4)


def test_manifest_invariant(spark):
    counts = quota.axis_counts(frame(spark, [record(1), record(2)]))
    quota.assert_distribution(counts, {"modality": {"written": 2}})
    try:
        quota.assert_distribution(counts, {"modality": {"written": 3}})
    except ValueError:
        return
    raise AssertionError
