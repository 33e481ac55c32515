"""Evaluation texts leaking into training text.

A document leaks an item when it holds at least 20 consecutive words of it with at most
one word in ten replaced, or an item of under 20 words whole and unaltered.  A run of 40
or more splits into 20 words and a rest of which one keeps the share, so two forms are
left: 20 words with at most two replaced, and 30 words with three.  A run of 30 that holds
no window of the first form has its three replaced words among the middle ten.

* A window of either form keeps six of its words in a row, so only windows with a run of six
  words that some item has as well go on; this loses none.
* Item-sized windows of both sides are embedded by the CGK random walk: 40 steps that
  emit the current word and move on when a random bit of (step, word) says so, which
  turns edits into few changed places.  Every other repeat walks backwards.
* Repeated bit-sampling: each of 10 repeats keys a window by 4 sampled places of its
  walk.  A window with two words replaced is found with probability 0.99, with one or
  none replaced with more than 0.999; a passage has many windows.
* Runs of 30 words are keyed by their first and last ten words, which loses none.
* Every candidate is verified word by word: the definition counts replaced words, not
  inserted or removed ones.  Equal windows of many items are one window with members, which
  are expanded only in the result.

The items are the query set.  They are read to the driver in blocks of bounded size and each
block runs against all documents in one narrow pass.  With more than one block the pairs of
each are written before the next is read, so the driver holds one block at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, spread
from .words import WordHash, mix, words

WINDOW = 20
MAX_REPLACED = 2
LONG_WINDOW, LONG_REPLACED, FLANK = 30, 3, 10
#: 18 kept words of 20 in three runs, or 27 of 30 in four: one run has six words at least.
GRAM = 6
GATE_BITS = 22
REPEATS = 10
STEPS = 40
SAMPLED = 4
#: Characters of item text in one block: some 100 MB of index at most.
BLOCK_CHARS = 16_000_000
CHUNK = 1 << 17

_rng = np.random.default_rng(77)
_SEED = _rng.integers(1, 2**63, REPEATS, dtype=np.uint64) | np.uint64(1)
_PLACES = [np.sort(_rng.choice(STEPS - 6, SAMPLED, replace=False)) for _ in range(REPEATS)]
_FACTOR = _rng.integers(1, 2**63, SAMPLED, dtype=np.uint64) | np.uint64(1)
_END = np.uint64(0x5BD1E995)
_FLANK_FACTOR = np.random.default_rng(78).integers(1, 2**63, 2 * FLANK, dtype=np.uint64) | np.uint64(1)


def cgk_keys(h: np.ndarray, starts: np.ndarray, size: int, repeat: int) -> np.ndarray:
    """Bit-sampled CGK keys of the windows ``h[s : s + size]``."""
    back = repeat % 2 == 1
    coins = mix(h * _SEED[repeat])
    places = _PLACES[repeat] if size >= WINDOW else np.unique(np.minimum(_PLACES[repeat], 2 * size - 1))
    key = np.zeros(len(starts), np.uint64)
    gone = np.zeros(len(starts), np.int32)
    origin = starts + (size - 1 if back else 0)
    sign = -1 if back else 1
    want, k = set(places.tolist()), 0
    for j in range(int(places[-1]) + 1):
        at = origin + sign * np.minimum(gone, size - 1)
        live = gone < size
        if j in want:
            key += np.where(live, h[at], _END) * _FACTOR[k]
            k += 1
        gone += (((coins[at] >> np.uint64(j)) & np.uint64(1)).astype(bool) & live).astype(np.int32)
    return mix(key + np.uint64(repeat))


def gram_keys(h: np.ndarray) -> np.ndarray:
    """Keys of all runs of ``GRAM`` words."""
    n = max(len(h) - GRAM + 1, 0)
    key = np.zeros(n, np.uint64)
    for k in range(GRAM):
        key += h[k : k + n] * _FLANK_FACTOR[k]
    return mix(key)


def flank_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys of the first and last ten words of the windows ``h[s : s + LONG_WINDOW]``."""
    key = np.zeros(len(starts), np.uint64)
    for k in range(FLANK):
        key += h[starts + k] * _FLANK_FACTOR[k] + h[starts + LONG_WINDOW - FLANK + k] * _FLANK_FACTOR[FLANK + k]
    return mix(key)


def window_keys(h: np.ndarray, starts: np.ndarray, size: int, repeat: int) -> np.ndarray:
    return flank_keys(h, starts) if size == LONG_WINDOW else cgk_keys(h, starts, size, repeat)


class ItemIndex:
    """Keys of all windows of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        memo = WordHash()
        self.ids: list[int] = []
        hashes, lens = [], []
        for i, t in items:
            w = words(t) if t else []
            if w:
                self.ids.append(i)
                lens.append(len(w))
                hashes += [memo[x] for x in w]
        self.item_of = np.array(self.ids, np.int64)
        self.h = np.array(hashes, np.uint64)
        self.len = np.array(lens, np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.len)[:-1]]) if lens else np.zeros(0, np.int64)
        self.passes = []  # (window, sorted keys per repeat, window starts per repeat, item per window)
        if not lens:
            return
        long = np.flatnonzero(self.len >= WINDOW)
        groups = [(WINDOW, long, REPEATS, MAX_REPLACED)] if len(long) else []
        longer = np.flatnonzero(self.len >= LONG_WINDOW)
        if len(longer):
            groups.append((LONG_WINDOW, longer, 1, LONG_REPLACED))
        for lo, hi in ((16, WINDOW), (8, 16), (4, 8), (2, 4), (1, 2)):
            short = np.flatnonzero((self.len >= lo) & (self.len < hi))
            if len(short):
                groups.append((int(self.len[short].min()), short, 1, 0))
        for size, who, repeats, slack in groups:
            n_win = self.len[who] - size + 1 if slack else np.ones(len(who), np.int64)
            owner = np.repeat(who, n_win)
            first = np.concatenate([[0], np.cumsum(n_win)[:-1]])
            at = np.arange(len(owner)) - np.repeat(first, n_win) + self.start[owner]
            text = np.zeros(len(at), np.uint64)
            for k in range(size):
                text = mix(text * np.uint64(31) + self.h[at + k])
            if not slack:  # whole items are compared below, so only equal items may share a class
                text = mix(text + mix(np.array([xxhash.xxh64_intdigest(self.h[self.start[i] : self.start[i] + self.len[i]].tobytes()) for i in owner.tolist()], np.uint64)))
            _, rep, cls = np.unique(text, return_index=True, return_inverse=True)
            # the items of each class, each once
            pair = np.unique(cls.astype(np.int64) * len(self.ids) + owner)
            members = pair % len(self.ids)
            bounds = np.searchsorted(pair // len(self.ids), np.arange(len(rep) + 1))
            at = at[rep]
            keys, order = [], []
            for r in range(repeats):
                k = window_keys(self.h, at, size, r)
                o = np.argsort(k, kind="stable")
                keys.append(k[o])
                order.append(o)
            if slack:
                grams = gram_keys(self.h)
                inside = np.zeros(len(grams) + 1, np.int64)
                np.add.at(inside, at, 1)
                np.add.at(inside, np.minimum(at + size - GRAM + 1, len(grams)), -1)
                known = np.unique(grams[np.cumsum(inside)[:-1] > 0])
            else:
                known = np.unique(np.concatenate([self.h[self.start[i] : self.start[i] + size] for i in who]))
            gate = np.zeros(1 << GATE_BITS, bool)
            gate[(known >> np.uint64(64 - GATE_BITS)).astype(np.int64)] = True
            self.passes.append((size, slack, at, members, bounds, keys, order, known, gate))

    def find(self, h: np.ndarray, doc_start: np.ndarray, doc_len: np.ndarray) -> np.ndarray:
        """Rows ``(document index, item id)`` for documents given as runs of word hashes, each once."""
        found: list[np.ndarray] = []
        doc_of = np.repeat(np.arange(len(doc_len)), doc_len)
        doc_end = np.repeat(doc_start + doc_len, doc_len)
        pos = np.arange(len(h))
        grams = None
        for size, slack, at, members, bounds, keys, order, known, gate in self.passes:
            if slack and grams is None:
                grams = gram_keys(h)
            own = grams if slack else h
            # a bitmap first, then the sorted keys
            maybe = np.flatnonzero(gate[(own >> np.uint64(64 - GATE_BITS)).astype(np.int64)])
            j = np.minimum(np.searchsorted(known, own[maybe]), len(known) - 1)
            hit = np.zeros(len(h) + 1, np.int64)
            hit[1 + maybe[known[j] == own[maybe]]] = 1
            count = np.cumsum(hit)
            ok = pos[pos + size <= doc_end]
            ok = ok[count[ok + size - GRAM + 1] > count[ok]] if slack else ok[count[ok + size] - count[ok] == size]
            for c in range(0, len(ok), CHUNK):
                starts = ok[c : c + CHUNK]
                cand = []
                for r in range(len(keys)):
                    k = window_keys(h, starts, size, r)
                    a, b = np.searchsorted(keys[r], k), np.searchsorted(keys[r], k, "right")
                    n = b - a
                    some = np.flatnonzero(n)
                    if len(some):
                        n = n[some]
                        off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a[some], n)
                        cand.append(np.repeat(starts[some], n) * len(at) + order[r][off])
                if not cand:
                    continue
                pairs = np.unique(np.concatenate(cand))
                for s in range(0, len(pairs), CHUNK):
                    p, q = pairs[s : s + CHUNK] // len(at), pairs[s : s + CHUNK] % len(at)
                    if slack:
                        bad = np.zeros(len(p), np.int16)
                        for w in range(size):
                            bad += h[p + w] != self.h[at[q] + w]
                        good = bad <= slack
                    else:
                        good = np.zeros(len(p), bool)
                        for x, (i, y) in enumerate(zip(p.tolist(), members[bounds[q]].tolist())):
                            n, f = int(self.len[y]), int(self.start[y])
                            good[x] = i + n <= doc_end[i] and np.array_equal(h[i : i + n], self.h[f : f + n])
                    found.append(self._expand(np.unique(doc_of[p[good]] * len(at) + q[good]), len(at), members, bounds))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def _expand(self, pairs: np.ndarray, n_classes: int, members: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """``(document, item)`` of ``(document, class)``."""
        d, q = pairs // n_classes, pairs % n_classes
        n = bounds[q + 1] - bounds[q]
        off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[q], n)
        return np.unique(np.stack([np.repeat(d, n), self.item_of[members[off]]], axis=1), axis=0)


def _n_blocks(items: DataFrame, text: str) -> int:
    chars, rows = items.agg(F.sum(F.length(text)), F.count("*")).first()
    return max(1, math.ceil((chars or 0) / BLOCK_CHARS), math.ceil(rows / 200_000))


def _blocks(items: DataFrame, key: str, text: str, n: int):
    src = items.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    for i in range(n):
        part = src if n == 1 else src.where(F.pmod(F.xxhash64("k"), F.lit(n)) == i)
        yield [(r["k"], r["t"]) for r in part.collect()]


def leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id)``, each once, of documents that hold a passage of an item.

    Null, empty and wordless texts on either side leak nothing.  Repeated documents leak
    under each key.  A passage shared by several items leaks each of them.  Whole texts are
    searched; the document side is never shuffled but for the final removal of repeats.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(doc_key).cast("bigint").alias("d"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    out = None
    n = _n_blocks(items, text)
    for block in _blocks(items, item_key, text, n):
        shared = spark.sparkContext.broadcast(ItemIndex(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index: ItemIndex = shared.value
            memo = WordHash()
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                step = 64
                for s in range(0, len(ids), step):
                    ws = [words(t) for t in texts[s : s + step]]
                    lens = np.array([len(w) for w in ws], np.int64)
                    h = np.fromiter((memo[x] for w in ws for x in w), np.uint64, int(lens.sum()))
                    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
                    hits = index.find(h, first, lens)
                    if len(hits):
                        yield pa.RecordBatch.from_arrays([pa.array([ids[s + d] for d in hits[:, 0].tolist()], pa.int64()), pa.array(hits[:, 1], pa.int64())], ["doc_id", "item_id"])

        part = spread(src).mapInArrow(run, "doc_id bigint, item_id bigint")
        if n > 1:
            part = materialize(part.distinct(), "leaks")
            shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out.distinct()
