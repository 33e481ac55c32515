import random

from gradeloom.llm import packing


def run(spark, texts, caps=(100, 1000), parts=3):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, size string").repartition(parts)
    plans = spark.createDataFrame([(k + 1, c) for k, c in enumerate(caps)], "plan_id int, capacity int")
    return packing.pack(docs, plans)


def test_whole_and_within_capacity(spark):
    rng = random.Random(1)
    texts = ["ş" * rng.choice([0, 1, 3, 10, 25, 40, 49, 51, 130, 700]) for _ in range(600)] + [None, ""]
    out = run(spark, texts).collect()
    for plan, cap in ((1, 100), (2, 1000)):
        rows = [r for r in out if r.plan_id == plan]
        boxes, docs = {}, {}
        for r in rows:
            boxes[r.container] = boxes.get(r.container, 0) + r.size
            docs.setdefault(r.doc_id, []).append(r)
        assert max(boxes.values()) <= cap
        assert set(docs) == set(range(len(texts)))
        for i, ps in docs.items():
            n = len((texts[i] or "").encode())
            assert sum(p.size for p in ps) == n and [p.piece for p in sorted(ps, key=lambda p: p.piece)] == list(range(len(ps)))
            assert (len(ps) > 1) == (n > cap)
        assert sum(boxes.values()) / (len(boxes) * cap) > 0.8


def test_harmonic_classes(spark):
    # three documents of class 3 to a container
    rows = run(spark, ["a" * 30] * 9, (100,), 1).collect()
    assert len({r.container for r in rows}) == 3


def test_oversized_and_edges(spark):
    got = sorted(tuple(r) for r in packing.oversized(run(spark, ["a" * 100, "a" * 101, None, "ğ" * 51])).collect())
    assert got == [(1, 1), (1, 3)]
    assert run(spark, []).count() == 0
    assert run(spark, ["a"], ()).count() == 0
    f = packing.fill_report(run(spark, ["a" * 100] * 4, (100,))).first()
    assert f.fill == 1.0 and f.containers == 4
