import random

import numpy as np

from gradeloom.llm.leakage import WINDOW, ItemIndex, leaks
from gradeloom.llm.words import WordHash, words


def brute(docs, items):
    out = set()
    for d, t in docs:
        w = words(t or "")
        for i, x in items:
            v = words(x or "")
            if not v:
                continue
            if len(v) < WINDOW:
                hit = any(w[p : p + len(v)] == v for p in range(len(w) - len(v) + 1))
            else:
                hit = any(sum(a != b for a, b in zip(w[p : p + WINDOW], v[q : q + WINDOW])) <= 2 for p in range(len(w) - WINDOW + 1) for q in range(len(v) - WINDOW + 1))
            if hit:
                out.add((d, i))
    return out


def data():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([1, 2, 3, 5, 8, 12, 16, 19, 20, 21, 25, 40, 60, 90] * 2)]
    items += [(90, items[11][1] + " " + " ".join(text(10))), (91, None), (92, "..."), (93, "")]
    docs = []
    for d in range(160):
        body = text(rng.randint(0, 60))
        x = words(rng.choice(items[:-3])[1])
        if rng.random() < 0.8:
            a = rng.randrange(max(1, len(x) - 20))
            part = x[a : a + rng.choice([15, 19, 20, 22, 30, len(x)])] if len(x) >= WINDOW else list(x)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                part[rng.randrange(len(part))] = rng.choice(vocab)
            body[rng.randint(0, len(body)) : 0] = part
        docs.append((d, ", ".join(body).upper() if d % 3 else " ".join(body)))
    return [*docs, (500, None), (501, ""), (502, "!?")], items


def test_recall_against_brute_force(spark):
    docs, items = data()
    want = brute(docs, items)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in leaks(d, i).collect()]
    assert len(got) == len(set(got)) and len(want) > 60
    assert set(got) <= want and len(set(got)) >= 0.98 * len(want)


def test_recall_of_hardest_windows():
    rng = np.random.default_rng(2)
    vocab = [f"v{i}" for i in range(5000)]
    memo, n, hit = WordHash(), 400, 0
    items = [(k, " ".join(rng.choice(vocab, 20))) for k in range(n)]
    ix = ItemIndex(items)
    for k, t in items:
        w = t.split()
        for p in rng.choice(20, 2, replace=False):
            w[p] = vocab[rng.integers(5000)]
        h = np.array([memo[x] for x in ["q", *w, "z"]], np.uint64)
        hit += [0, k] in ix.find(h, np.array([0]), np.array([len(h)])).tolist()
    assert hit / n >= 0.97


def test_blocks_of_items(spark, monkeypatch):
    from gradeloom.llm import leakage

    docs, items = data()
    d, i = spark.createDataFrame(docs[:40], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = {tuple(r) for r in leaks(d, i).collect()}
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 1500)
    assert {tuple(r) for r in leaks(d, i).collect()} == whole


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert leaks(d, i).count() == 0
    assert leaks(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), i).count() == 0


def test_a_passage_of_many_items_is_verified_once():
    rng = np.random.default_rng(5)
    vocab = [f"v{i}" for i in range(3000)]
    shared = list(rng.choice(vocab, 30))
    items = [(k, " ".join([*rng.choice(vocab, 5), *shared, *rng.choice(vocab, 5)])) for k in range(800)]
    items += [(900 + k, "tek kısa öğe burada") for k in range(3)]
    ix, memo = ItemIndex(items), WordHash()
    docs = [[*rng.choice(vocab, 15), *shared[:25], *rng.choice(vocab, 15), *words("tek kısa öğe burada")] for _ in range(40)]
    h = np.array([memo[str(x)] for d in docs for x in d], np.uint64)
    lens = np.array([len(d) for d in docs])
    got = ix.find(h, np.cumsum(lens) - lens, lens)
    assert len(got) == 40 * 803 and len(np.unique(got, axis=0)) == len(got)
    # windows that the items share are one class
    assert len(ix.passes[0][2]) < 800 * 21
