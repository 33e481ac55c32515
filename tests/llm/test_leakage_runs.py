import numpy as np

from gradeloom.llm.leakage import ItemIndex
from gradeloom.llm.words import WordHash


def leaks_by_definition(w, v):
    """At least 20 consecutive words with at most one in ten replaced, by every run."""
    for d in range(-len(v), len(w)):
        same = [w[k + d] == v[k] for k in range(len(v)) if 0 <= k + d < len(w)]
        bad = np.concatenate([[0], np.cumsum(~np.array(same, bool))])
        for a in range(len(same)):
            for b in range(a + 20, len(same) + 1):
                if 10 * (bad[b] - bad[a]) <= b - a:
                    return True
    return False


def found(w, v):
    memo = WordHash()
    h = np.array([memo[x] for x in w], np.uint64)
    return [0, 7] in ItemIndex([(7, " ".join(v))]).find(h, np.array([0]), np.array([len(h)])).tolist()


def test_thirty_words_with_three_replaced_in_the_middle():
    v = [f"v{k}" for k in range(30)]
    w = [f"x{k}" if k in (10, 14, 19) else x for k, x in enumerate(v)]
    assert found(["q", *w, "z"], v)
    assert not found(["q", *w[:-1], "y"], v)


def test_against_the_full_definition():
    rng = np.random.default_rng(5)
    n = long_only = 0
    for _ in range(600):
        size = int(rng.integers(20, 45))
        v = [f"v{k}" for k in range(size)]
        w = list(v)
        lo = int(rng.integers(0, size - 12))
        for p in rng.choice(np.arange(lo, lo + 11), int(rng.integers(1, 5)), replace=False):
            w[p] = f"x{p}"
        want = leaks_by_definition(w, v)
        short = any(sum(a != b for a, b in zip(w[p : p + 20], v[p : p + 20])) <= 2 for p in range(size - 19))
        if want and not short:
            long_only += 1
            assert found(w, v)
        n += want == found(w, v)
        assert want or not found(w, v)
    assert long_only >= 5 and n >= 594
