import numpy as np
import pytest

from gradeloom.llm.overlap import RADIUS, SEED, _draws, fingerprints
from gradeloom.llm.words import WordHash, edit_distance


def share_found(pairs, draws=_draws(SEED)):
    memo, texts = WordHash(), [t for p in pairs for t in p]
    lens = np.array([len(t) for t in texts])
    h = np.array([memo[x] for t in texts for x in t], np.uint64)
    bits, blocks = fingerprints(h, np.cumsum(lens) - lens, draws)
    agree = (blocks[0::2] == blocks[1::2]).any(axis=1)
    apart = np.array([sum(int(v).bit_count() for v in x) for x in (bits[0::2] ^ bits[1::2]).view(np.uint64)])
    return (agree & (apart <= RADIUS)).mean()


@pytest.mark.parametrize("phrase, times, share, least", [(10, 8, 0.25, 0.95), (6, 10, 0.25, 0.95), (3, 30, 0.10, 0.98), (1, 100, 0.05, 0.98)])
def test_texts_that_repeat_themselves(phrase, times, share, least):
    rng, pairs = np.random.default_rng(4), []
    for _ in range(300):
        a = [f"w{rng.integers(10**6)}" for _ in range(phrase)] * times
        b = list(a)
        for p in rng.choice(len(a), int(len(a) * share), replace=False):
            b[p] = f"x{rng.integers(10**6)}"
        pairs.append((a, b))
    assert share_found(pairs) >= least


@pytest.mark.parametrize("seed", [SEED, 1, 2, 3, 4])
def test_a_quarter_replaced_evenly_at_any_length(seed):
    rng = np.random.default_rng(seed)
    for n in (8, 12, 15, 16, 20, 40, 60):
        texts = [[f"w{rng.integers(10**6)}" for _ in range(n)] for _ in range(400)]
        assert share_found([(a, [f"x{i}{x}" if i % 4 == 1 else x for i, x in enumerate(a)]) for a in texts], _draws(seed)) >= 0.95


def test_words_removed_across_lengths():
    rng = np.random.default_rng(9)
    texts = [[f"w{rng.integers(10**6)}" for _ in range(16)] for _ in range(300)]
    assert share_found([(a, a[:15]) for a in texts]) >= 0.99


def test_order_of_texts_changes_nothing():
    h = np.array([WordHash()[x] for x in "a b a b a b a c c c c c c c c c".split()], np.uint64)
    both = fingerprints(h, np.array([0, 8]))
    for k, part in ((0, h[:8]), (1, h[8:])):
        alone = fingerprints(part, np.array([0]))
        assert (both[0][k] == alone[0][0]).all() and (both[1][k] == alone[1][0]).all()


def test_edit_distance_of_long_texts():
    rng = np.random.default_rng(2)
    a = [f"w{x}" for x in rng.integers(0, 500, 20_000)]
    b = list(a)
    for p in range(5, 20_000, 10):
        b[p] = "x"
    assert edit_distance(a, b, 5000) == 2000 and edit_distance(a, b, 1999) == 2000
    assert edit_distance(["x"] + ["a"] * 300 + ["y"], ["a"] * 299, 10) == 3
