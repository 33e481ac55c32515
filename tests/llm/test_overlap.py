import random

from pyspark.sql import functions as F

from gradeloom.llm.overlap import near_pairs
from gradeloom.llm.words import edit_distance, words

from ..factory import frame, record

VOCAB = [f"kelime{i}" for i in range(400)]


def brute(rows):
    out = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            sides = {r["metadata"]["split"] == "train" for r in (a, b) if r["metadata"]["split"] in ("train", "validation", "test", "benchmark")}
            if len(sides) != 2:
                continue
            for f, get in (("student_response.text", lambda r: r["student_response"]["text"]), ("task.prompt", lambda r: r["task"]["prompt"]), ("task.context", lambda r: r["task"]["context"])):
                if get(a) is None or get(b) is None:
                    continue
                x, y = words(get(a)), words(get(b))
                k = max(len(x), len(y)) // 4
                if min(len(x), len(y)) >= 8 and edit_distance(x, y, k) <= k:
                    out.add((*sorted((a["record_key"], b["record_key"])), f))
    return out


def change(rng, w, n):
    w = list(w)
    for _ in range(n):
        i = rng.randrange(len(w))
        kind = rng.random()
        if kind < 0.6:
            w[i] = rng.choice(VOCAB)
        elif kind < 0.8:
            del w[i]
        else:
            w.insert(i, rng.choice(VOCAB))
    return w


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        base = [rng.choice(VOCAB) for _ in range(rng.choice([8, 9, 12, 20, 40, 80]))]
        rows.append(record(2 * k, student_response__text=" ".join(base), metadata__split="train", task__context="aynı bağlam metni burada sekiz kelimeden uzun durur hep" if k % 9 == 0 else None))
        near = change(rng, base, rng.randint(0, max(1, int(0.15 * len(base)))))
        rows.append(record(2 * k + 1, student_response__text=" ".join(near).upper(), metadata__split=rng.choice(["validation", "test", "benchmark", None, "train"]), task__context="AYNI bağlam, metni burada sekiz kelimeden uzun DURUR hep!" if k % 9 == 0 else ""))
    want = brute(rows)
    got = near_pairs(frame(spark, rows)).collect()
    assert len(want) > 40
    assert len(got) == len({tuple(r) for r in got})
    found = {tuple(r) for r in got}
    assert found <= want and len(found) >= 0.99 * len(want)


def test_edges(spark):
    eight = "bir iki üç dört beş altı yedi sekiz"
    rows = [
        record(1, student_response__text=eight, metadata__split="train"),
        record(2, student_response__text="BİR, İKİ: ÜÇ-DÖRT (BEŞ) ALTI yedi SEKİZ", metadata__split="test"),
        record(3, student_response__text="bir iki üç dört beş altı yedi", metadata__split="test"),
        record(4, student_response__text=None, metadata__split="test"),
        record(5, student_response__text="", metadata__split="train"),
        record(6, student_response__text=eight, metadata__split=None),
        record(7, student_response__text=eight, metadata__split="validation"),
        record(7, student_response__text="uzun " * 30_000, metadata__split="validation"),
        record(8, student_response__text="uzun " * 30_000, metadata__split="train"),
    ]
    df = frame(spark, rows).withColumn("n", F.col("grade")).withColumn("field", F.col("id"))
    got = sorted((r.record_key_a, r.record_key_b, r.field) for r in near_pairs(df).collect())
    assert got == [(1, 2, "student_response.text"), (1, 7, "student_response.text"), (7, 8, "student_response.text")]
    assert near_pairs(df.limit(0)).count() == 0


def test_hot_text_expands_once_per_pair(spark):
    rows = [record(i, student_response__text="a b c d e f g h i", metadata__split="train" if i % 3 else "test") for i in range(60)]
    got = near_pairs(frame(spark, rows)).where("field = 'student_response.text'")
    assert got.count() == got.distinct().count() == 20 * 40


def test_edit_distance():
    assert edit_distance(list("kitten"), list("sitting"), 5) == 3
    assert edit_distance(list("abc"), list("xyz"), 1) == 2
    assert edit_distance([], [], 0) == 0
