"""Connected components by hooking and pointer jumping on a shrinking graph.

Each round every vertex hooks to its smallest neighbour, pointers jump once, the
edges are rewritten to the new representatives and self-loops and repeats are
dropped.  A vertex that is no local minimum leaves the graph in each round, so
the graph at least halves and the number of rounds is logarithmic.  Only the
rounds' pointer tables are kept; composing them from the last back to the first
gives every vertex its root.  Nothing is collected but counts and, on large
graphs, the bounded list of hot vertices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, release
from .skew import hot_keys, join_unique, least_rows


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every vertex of an edge; ``root`` is the smallest vertex of its component.

    Self-loops make a vertex known but link nothing.  Null ends are ignored, an
    empty edge table gives an empty result, repeated edges are counted once.
    """
    clean = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = clean.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    e = materialize(
        clean.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "cc-edges",
    )
    pointers: list[tuple[DataFrame, list]] = []
    for _ in range(max_rounds):
        n = e.count()  # Parquet metadata only
        if n == 0:
            break
        # one entry for each end of each edge, pre-aggregated before the shuffle
        ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.*")
        hook = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("p"), F.count("*").alias("deg")).select("u", "p", "deg")
        if 2 * n >= least_rows(e.sparkSession):
            hook = materialize(hook, "cc-hook")
        hot = hot_keys(hook, "u", "deg", 2 * n)
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("g"))
        fans = hot_keys(hook.groupBy("p").agg(F.count("*").alias("fan")), "p", "fan", 2 * n) if hot else []
        jumped = join_unique(hook.select("u", "p"), up, "p", fans, F.xxhash64("u")).select("u", F.col("g").alias("p"))
        m = materialize(jumped, "cc-jump")
        release(hook)
        ea = join_unique(e, m.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a", hot, F.xxhash64("b"))
        eb = join_unique(ea, m.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b", hot, F.xxhash64("a"))
        nxt = materialize(
            eb.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "cc-edges",
        )
        release(e)
        e = nxt
        pointers.append((m, hot))
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    release(e)
    if not pointers:
        return nodes.select("node", F.col("node").alias("root"))
    roots = pointers[-1][0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for m, hot in reversed(pointers[:-1]):
        later = roots.select(F.col("node").alias("p"), "root")
        here = join_unique(m, later, "p", hot, F.xxhash64("u"), "left")
        roots = here.select(F.col("u").alias("node"), F.coalesce("root", "p").alias("root"))
    # a vertex that only has a self-loop is in no pointer table
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
