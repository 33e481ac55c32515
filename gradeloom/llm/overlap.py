"""The same or nearly the same text on both sides of a split.

Each distinct text (by its folded words) gets a similarity-hash bit fingerprint of 256
bits: two bits of each of 128 minwise hashes over its words, every word with its number
among equal ones (b-bit minwise hashing).  If at most a quarter of the longer text's words
are inserted, removed or replaced, the two texts share at least 0.75 / 1.25 = 0.6 of all
their words, at any length and wherever the changed words stand.  The fingerprints of such
a pair differ in 51 bits on average, those of unrelated texts in about 110.

1. The hashes are cut into 32 blocks of four, and the texts of the two sides that agree on
   a block are candidates.  A pair at the limit agrees on one with probability
   ``1 - (1 - 0.6 ** 4) ** 32 = 0.988``.
2. Candidates within the Hamming radius of 78 bits (3.5 standard deviations above 51) go on.
3. The word edit distance decides, exactly.

Copies are one text with members, so a text on a third of all rows takes part once; only
the pairs of rows that are the result are expanded, with the members of a hot text salted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, spread
from .words import WordHash, edit_distance, mix, words

PER_BLOCK, BLOCKS = 4, 32
HASHES = PER_BLOCK * BLOCKS
RADIUS = 78
MIN_WORDS = 8
#: The text fields, and the splits of each side.
FIELDS = ("student_response.text", "task.prompt", "task.context")
TRAIN = ("train",)
EVAL = ("validation", "test", "benchmark")
MEMBERS_PER_SALT = 2000
SEED = 20240229
#: Words whose hashes are held at a time.
CHUNK_WORDS = 1 << 20


def _draws(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, HASHES, dtype=np.uint64)


_MUL, _ADD = _draws(SEED)

_ROWS = pa.schema([("record_key", pa.int64()), ("eval", pa.bool_()), ("field", pa.int8()), ("cls", pa.binary()), ("n", pa.int32()), ("words", pa.string())])
_PRINT = [("bits", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int32()))]


def numbered(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Word hashes in which a word that comes again in its text is another word."""
    ends = np.concatenate([starts[1:], [len(hashes)]])
    text = np.repeat(np.arange(len(starts)), ends - starts)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    again = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    g = mix(hashes)
    more = order[again > 0]
    g[more] = mix(g[more] + again[again > 0].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return g


def fingerprints(hashes: np.ndarray, starts: np.ndarray, draws: tuple[np.ndarray, np.ndarray] = (_MUL, _ADD)) -> tuple[np.ndarray, np.ndarray]:
    """``(texts, 4)`` int64 fingerprints and ``(texts, BLOCKS)`` int32 blocks of texts given as runs of word hashes."""
    g = numbered(hashes, starts)
    bits = np.zeros((len(starts), 2 * HASHES // 64), np.uint64)
    blocks = np.zeros((len(starts), BLOCKS), np.uint64)
    for j in range(HASHES):
        v = np.minimum.reduceat((g * draws[0][j] + draws[1][j]) >> np.uint64(32), starts)
        bits[:, j // 32] |= (v & np.uint64(3)) << np.uint64(2 * (j % 32))
        blocks[:, j // PER_BLOCK] = mix(blocks[:, j // PER_BLOCK] * np.uint64(31) + v)
    return bits.view(np.int64), (blocks >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class and length of each text; its words with the first of a batch only."""
    for b in batches:
        known: dict[str, tuple | None] = {}
        done: set = set()
        rows = []
        for k, s, f, t in zip(*(b.column(i).to_pylist() for i in range(4))):
            if t not in known:
                w = words(t)
                joined = " ".join(w)
                known[t] = (xxhash.xxh3_128_digest(joined), len(w), joined) if len(w) >= MIN_WORDS else None
            if c := known[t]:
                rows.append((k, s, f, c[0], c[1], None if (f, c[0]) in done else c[2]))
                done.add((f, c[0]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, x.type) for v, x in zip(zip(*rows), _ROWS)], schema=_ROWS)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds fingerprint and blocks to texts."""
    memo = WordHash()
    for b in batches:
        texts = [t.split(" ") for t in b.column("words").to_pylist()]
        at, bits, blocks = 0, [], []
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_WORDS):
                size += len(texts[end])
                end += 1
            lens = np.array([len(t) for t in texts[at:end]])
            flat = np.fromiter((memo[w] for t in texts[at:end] for w in t), np.uint64, size)
            x, y = fingerprints(flat, np.cumsum(lens) - lens)
            bits += x.tolist()
            blocks += y.tolist()
            at = end
        cols = [pa.array(v, t) for v, (_, t) in zip((bits, blocks), _PRINT)]
        yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *(n for n, _ in _PRINT)])


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        wa, wb = b.column("wa").to_pylist(), b.column("wb").to_pylist()
        keep = []
        for x, y in zip(wa, wb):
            x, y = x.split(" "), y.split(" ")
            k = max(len(x), len(y)) // 4
            keep.append(edit_distance(x, y, k) <= k)
        out = b.filter(pa.array(keep, pa.bool_()))
        yield out.select(["field", "ca", "cb", "n_train"])


def near_pairs(records: DataFrame, key: str = "record_key", split: str = "metadata.split", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(record_key_a, record_key_b, field)``: rows of opposite sides whose text in ``field`` nearly agrees.

    Each pair once, the smaller key first.  Null and short texts (under eight words) never
    count; a row without one of the named splits takes no part; repeated keys give the pairs
    of each row.  Two texts nearly agree when at most a quarter of the longer one's words
    must be inserted, removed or replaced.
    """
    side = F.when(F.col(split).isin(*TRAIN), False).when(F.col(split).isin(*EVAL), True)
    texts = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("f"), F.col(p).alias("t")) for i, p in enumerate(fields)])
    rows = records.select(F.col(key).cast("bigint").alias("record_key"), side.alias("eval"), F.explode(texts).alias("x"))
    rows = rows.where(F.col("eval").isNotNull() & (F.length("x.t") >= 2 * MIN_WORDS - 1)).select("record_key", "eval", "x.f", "x.t")
    s = materialize(spread(rows).mapInArrow(_rows, "record_key bigint, eval boolean, field tinyint, cls binary, n int, words string"), "overlap-rows")
    classes = s.groupBy("field", "cls").agg(
        F.max("n").alias("n"),
        F.sum(F.when(F.col("eval"), 0).otherwise(1)).alias("n_train"),
        F.sum(F.when(F.col("eval"), 1).otherwise(0)).alias("n_eval"),
        F.max("words").alias("words"),
    )
    known = "cid bigint, field tinyint, cls binary, n int, n_train bigint, n_eval bigint, words string"
    classes = classes.withColumn("cid", F.monotonically_increasing_id()).select("cid", "field", "cls", "n", "n_train", "n_eval", "words")
    c = materialize(classes.mapInArrow(_prints, known + ", bits array<bigint>, blocks array<int>"), "overlap-texts")
    # field, block and value in one number
    blocks = c.select("cid", "n", "n_train", "n_eval", (F.col("field").cast("bigint") * BLOCKS).alias("base"), F.posexplode("blocks").alias("b", "v"))
    code = F.shiftleft(F.col("base") + F.col("b"), 32).bitwiseOR(F.col("v").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    ev = blocks.where("n_eval > 0").select(code.alias("code"), F.col("cid").alias("x"), F.col("n").alias("nx"))
    tr = blocks.where("n_train > 0").select(code.alias("code"), F.col("cid").alias("y"), F.col("n").alias("ny"))
    fits = F.abs(F.col("nx") - F.col("ny")) * 4 <= F.greatest("nx", "ny")
    cand = ev.join(tr, "code").where((F.col("x") != F.col("y")) & fits).select("x", "y").distinct()
    # fingerprints only: texts are fetched for the few pairs within the radius
    a = c.where("n_eval > 0").select(F.col("cid").alias("x"), F.col("bits").alias("p"))
    z = c.where("n_train > 0").select(F.col("cid").alias("y"), F.col("bits").alias("q"))
    apart = F.aggregate(F.zip_with("p", "q", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    near = materialize(cand.join(a, "x").join(z, "y").where(apart <= RADIUS).select("x", "y"), "overlap-near")
    wa = c.select(F.col("cid").alias("x"), "field", F.col("cls").alias("ca"), F.col("words").alias("wa"))
    wb = c.select(F.col("cid").alias("y"), F.col("cls").alias("cb"), F.col("words").alias("wb"), "n_train")
    near = near.join(wa, "x").join(wb, "y").select("field", "ca", "cb", "n_train", "wa", "wb")
    pairs = near.mapInArrow(_exact, "field tinyint, ca binary, cb binary, n_train bigint")
    same = c.where("n_train > 0 and n_eval > 0").select("field", F.col("cls").alias("ca"), F.col("cls").alias("cb"), "n_train")
    pairs = materialize(pairs.unionByName(same), "overlap-pairs")  # read twice below
    # expansion to rows: the members of a text with many train rows are spread over salts
    salts = F.ceil(F.col("n_train") / MEMBERS_PER_SALT).cast("int")
    left = pairs.join(s.where("eval").select("field", F.col("cls").alias("ca"), F.col("record_key").alias("e")), ["field", "ca"])
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    sizes = pairs.select("field", "cb", "n_train").distinct()
    members = s.where("not eval").select("field", F.col("cls").alias("cb"), F.col("record_key").alias("t"))
    members = members.join(sizes, ["field", "cb"]).withColumn("salt", F.pmod(F.xxhash64("t"), salts).cast("int"))
    rows = left.select("field", "cb", "salt", "e").join(members.select("field", "cb", "salt", "t"), ["field", "cb", "salt"])
    names = F.array(*[F.lit(f) for f in fields])
    return rows.select(F.least("e", "t").alias("record_key_a"), F.greatest("e", "t").alias("record_key_b"), names[F.col("field").cast("int")].alias("field"))
