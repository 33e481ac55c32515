import pytest

from gradeloom.operators import links, split

from .factory import frame, record


def families(n=12, size=10):
    mods, grades = ("written", "speaking", "listening"), (9, 10, 11, 12)
    levels = ("full_correct", "high_partial", "mid_partial", "low_partial", "incorrect", "blank_irrelevant", "borderline")
    return [record(f * size + i, metadata__response_quality=levels[i % 7], metadata__question_family=f"q{f}", metadata__exam_family=f"e{f}", task__task_id=f"t{f}-{i % 3}", modality=mods[f % 3], grade=grades[f % 4]) for f in range(n) for i in range(size)]


def assigned(spark, rows, **kw):
    df = frame(spark, rows)
    m = df.join(links.record_components(df, "record_key"), "record_key")
    s = split.balanced_split(m, 0.8, 0.1, "seed", **kw)
    return {r.record_key: (r.component, r.split) for r in m.join(s.withColumnRenamed("split", "s"), "component").selectExpr("record_key", "component", "s as split").collect()}


def test_balanced_families_stay_whole(spark):
    got = assigned(spark, families())
    by = {}
    for c, s in got.values():
        by.setdefault(c, set()).add(s)
    assert all(len(x) == 1 for x in by.values())
    n = {s: sum(x == s for _, x in got.values()) for s in ("train", "validation", "test")}
    assert abs(n["train"] - 96) <= 10 and abs(n["validation"] - 12) <= 10 and abs(n["test"] - 12) <= 10
    assert assigned(spark, families()) == got


def test_existing_split_is_kept_and_mixed_is_a_conflict(spark):
    rows = families(4, 3)
    rows[0]["metadata"]["split"] = "test"
    got = assigned(spark, rows)
    assert {s for _, s in list(got.values())[:1]} == {"test"}
    rows[1]["metadata"]["split"] = "train"
    assert {s for c, s in assigned(spark, rows).values() if c == got[0][0]} == {None}
    assert None not in {s for _, s in assigned(spark, rows, rebalance=True).values()}


def test_hash_cut_and_ratios(spark):
    c = spark.createDataFrame([(f"c{i}", None) for i in range(200)] + [("x", "test"), ("x", "train"), ("y", "test")], "component string, split string")
    got = {r.component: r for r in split.hash_cut(c, 0.8, 0.1, "s").collect()}
    assert got["y"].split == "test" and got["x"].split is None and got["x"].conflict
    assert 130 < sum(r.split == "train" for r in got.values()) < 190
    for a, b in ((0, 0.1), (0.9, 0.1), (1.2, 0)):
        with pytest.raises(ValueError):
            split.check_ratios(a, b)
