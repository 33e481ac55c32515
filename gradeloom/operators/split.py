"""Leakage-free splits over components of linked records.

Two assigners share one hand-over rule: the driver never sees more than ``2 * BUCKETS``
units.  A component above ``1/BUCKETS`` of the rows is a unit of its own; smaller ones are
units too while there are at most ``BUCKETS`` of them, and are hashed into ``BUCKETS``
units otherwise, so a balanced assignment is exact on small corpora and as fine as
``1/BUCKETS`` of the rows on any.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_true, stable_unit
from ..storage import materialize

BUCKETS = 4096
#: Weight and floor of each part of the cost.
WEIGHTS = {"records": (12.0, 20.0), "modality": (4.0, 5.0), "grade": (2.5, 5.0), "response_quality": (0.75, 2.0), "flag": (0.5, 1.0)}
MISSING = {"modality": 0.8, "grade": 0.3}
GAIN = 1e-12


def check_ratios(train: float, validation: float) -> None:
    if not 0 < train < 1 or not 0 <= validation < 1 or not train + validation < 1:
        raise ValueError("need 0 < train < 1, 0 <= validation < 1 and train + validation < 1")


def existing_split(components: DataFrame) -> DataFrame:
    """``(component, n, n_splits, split)`` from rows ``(component, split)``; the split is null if there are several."""
    g = components.groupBy("component").agg(F.count("*").alias("n"), F.count_distinct("split").alias("n_splits"), F.max("split").alias("split"))
    return g.withColumn("split", F.when(F.col("n_splits") == 1, F.col("split")))


def hash_cut(components: DataFrame, train: float, validation: float, seed: str) -> DataFrame:
    """``(component, n, split, conflict)``: an existing split wins, others are cut by the seeded hash of the component.

    A component with several existing splits is a conflict and gets none.
    """
    check_ratios(train, validation)
    u = stable_unit(F.col("component"), seed)
    cut = F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")
    e = existing_split(components)
    return e.select("component", "n", F.when(F.col("n_splits") <= 1, F.coalesce("split", cut)).alias("split"), (F.col("n_splits") > 1).alias("conflict"))


def _features(members: DataFrame) -> list[tuple[str, str, Column]]:
    """``(part, category, flag)``: one column for each category; the categories are those of the data, checked to be few."""
    out: list[tuple[str, str, Column]] = []
    for part, path in (("modality", "modality"), ("grade", "grade"), ("response_quality", "metadata.response_quality")):
        c = F.coalesce(F.col(path).cast("string"), F.lit("None"))
        seen = [r[0] for r in members.select(c.alias("c")).distinct().limit(201).collect()]
        if len(seen) > 200:
            raise ValueError(f"more than 200 categories of {part}")
        out += [(part, v, c == v) for v in sorted(seen)]
    hard = F.coalesce(F.size("metadata.hard_case_types") > 0, F.lit(False))
    out += [("flag", "needs_review", is_true(F.col("gold_evaluation.needs_review"))), ("flag", "hard_case", hard), ("flag", "adversarial", is_true(F.col("metadata.adversarial")))]
    return out


class _Cost:
    def __init__(self, parts: list[str], target: np.ndarray):
        self.target = target  # splits x features, the first feature being the record count
        w = np.array([WEIGHTS[p][0] for p in parts])
        floor = np.array([WEIGHTS[p][1] for p in parts])
        self.scale = w / np.maximum(np.abs(target), floor) ** 2
        self.miss = np.array([[MISSING.get(p, 0.0) if s else 0.0 for p in parts] for s in range(3)])

    def of(self, split: int, vec: np.ndarray) -> np.ndarray:
        """Cost of one split holding each row of ``vec``."""
        d = vec - self.target[split]
        return (d * d * self.scale[split]).sum(-1) + ((vec <= 0) * self.miss[split]).sum(-1)


def _stable(text: str, seed: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{text}".encode()).digest()[:8], "big")


def balance(names: list[str], vectors: np.ndarray, locked: list[int | None], parts: list[str], ratios: tuple[float, float, float], seed: str, swap_limit: int = 1500) -> list[int]:
    """Greedy fill, then the best single move, else the best swap, while anything improves the cost.

    ``locked`` holds the split of units that must stay.  Swaps are searched among at most
    ``swap_limit`` units; beyond that a unit is so small a share that moves do.
    """
    n = len(names)
    cost = _Cost(parts, np.outer(ratios, vectors.sum(0)))
    where = np.array([-1 if x is None else x for x in locked])
    held = np.array([vectors[where == s].sum(0) if (where == s).any() else np.zeros(vectors.shape[1]) for s in range(3)])
    free = [i for i in range(n) if locked[i] is None]
    order = sorted(free, key=lambda i: (-vectors[i, 0], _stable(names[i], seed)))
    split_names = ("train", "validation", "test")
    for i in order:
        now = [float(cost.of(s, held[s])) for s in range(3)]
        best = min(range(3), key=lambda s: (sum(now) - now[s] + float(cost.of(s, held[s] + vectors[i])), _stable(f"{names[i]}:{split_names[s]}", seed), split_names[s]))
        where[i], held[best] = best, held[best] + vectors[i]
    free_at = np.array(free, int)
    for _ in range(20 * n + 20):
        now = np.array([float(cost.of(s, held[s])) for s in range(3)])
        best = (GAIN, -1, -1, -1)
        for src in range(3):
            who = free_at[where[free_at] == src] if n else free_at
            if not len(who):
                continue
            less = cost.of(src, held[src] - vectors[who])
            for dst in range(3):
                if dst == src:
                    continue
                gain = now[src] + now[dst] - less - cost.of(dst, held[dst] + vectors[who])
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), int(who[k]), -1, dst)
        if best[1] < 0 and len(free) <= swap_limit:
            for a in range(3):
                for b in range(a + 1, 3):
                    wa, wb = free_at[where[free_at] == a], free_at[where[free_at] == b]
                    for i in wa:
                        if not len(wb):
                            break
                        d = vectors[wb] - vectors[i]
                        gain = now[a] + now[b] - cost.of(a, held[a] + d) - cost.of(b, held[b] - d)
                        k = int(np.argmax(gain))
                        if gain[k] > best[0]:
                            best = (float(gain[k]), int(i), int(wb[k]), b)
        _, i, j, dst = best
        if i < 0:
            break
        src = where[i]
        held[src], held[dst] = held[src] - vectors[i], held[dst] + vectors[i]
        where[i] = dst
        if j >= 0:
            held[dst], held[src] = held[dst] - vectors[j], held[src] + vectors[j]
            where[j] = src
    return where.tolist()


def balanced_split(members: DataFrame, train: float, validation: float, seed: str, rebalance: bool = False) -> DataFrame:
    """``(component, split, conflict)`` for records with a ``component`` column, balanced over modality, grade, quality and flags.

    Components with a split keep it unless ``rebalance``; one with several is a conflict.
    """
    check_ratios(train, validation)
    names = ("train", "validation", "test")
    feats = _features(members)
    parts = ["records", *[p for p, _, _ in feats]]
    sums = [F.count("*").alias("f0"), *[F.count_if(c).alias(f"f{k + 1}") for k, (_, _, c) in enumerate(feats)]]
    split = F.when(F.col("metadata.split").isin(*names), F.col("metadata.split"))
    stats = members.groupBy("component").agg(F.count_distinct(split).alias("n_splits"), F.max(split).alias("split"), *sums)
    stats = materialize(stats.withColumn("conflict", (F.col("n_splits") > 1) & F.lit(not rebalance)), "split-stats")
    size = stats.agg(F.count("*").alias("n"), F.sum("f0").alias("rows")).first()
    keep = F.lit(None).cast("string") if rebalance else F.when(F.col("n_splits") == 1, F.col("split"))
    big = F.col("f0") * BUCKETS > F.lit(size["rows"] or 0)
    lone = F.lit(True) if size["n"] <= BUCKETS else big
    unit = F.when(lone, F.concat(F.lit("c:"), F.col("component"))).otherwise(F.concat(F.lit("b:"), F.coalesce(keep, F.lit("-")), F.lit(":"), F.pmod(F.xxhash64("component"), F.lit(BUCKETS)).cast("string")))
    tagged = stats.where("not conflict").withColumn("unit", unit).withColumn("keep", keep)
    units = tagged.groupBy("unit").agg(F.max("keep").alias("keep"), *[F.sum(f"f{k}").alias(f"f{k}") for k in range(len(parts))]).orderBy("unit").collect()
    vec = np.array([[r[f"f{k}"] for k in range(len(parts))] for r in units], float).reshape(len(units), len(parts))
    locked = [names.index(r["keep"]) if r["keep"] else None for r in units]
    where = balance([r["unit"] for r in units], vec, locked, parts, (train, validation, 1 - train - validation), seed)
    chosen = members.sparkSession.createDataFrame([(r["unit"], names[s]) for r, s in zip(units, where)], "unit string, chosen string")
    # at most 2 * BUCKETS units, times the three splits kept apart
    done = tagged.join(F.broadcast(chosen), "unit").select("component", F.col("chosen").alias("split"), F.lit(False).alias("conflict"))
    return done.unionByName(stats.where("conflict").select("component", F.lit(None).cast("string").alias("split"), "conflict"))


def split_manifest(assigned: DataFrame, id_col: str, seed: str, algorithm: str) -> DataFrame:
    """``(split, seed, algorithm, n, first_id, last_id, digest)``: one row per split.

    The ids themselves stay a table (they can be all rows); the digest is an order-free sum of
    their hashes, so two manifests can be compared.
    """
    g = assigned.where("split is not null").groupBy("split")
    out = g.agg(F.count("*").alias("n"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"), F.sum(F.pmod(F.xxhash64(id_col), F.lit(2**31))).alias("digest"))
    return out.select("split", F.lit(seed).alias("seed"), F.lit(algorithm).alias("algorithm"), "n", "first_id", "last_id", "digest")
