"""Splits that keep related records together.

A persisted *component table* holds one row per link value with the component it belongs
to, that component's split and the rows it was delivered with.  A record without link
values has the value ``id=<key>``, so it is kept like any other.  A delivery is folded in:

1. its distinct key sets become edges between link values;
2. values already in the table stand for their component, so only components the
   delivery touches take part in the merge (hooking and pointer jumping, see
   ``operators.components``);
3. a merged component takes the smallest link value as its name.  If its old parts
   had one split it keeps it; if they had several it is *quarantined*: its rows get no
   split, each value keeps the name and split of its old part, and ``resolve`` settles it;
   a component without a split is filled by deficit.

Deficits come from the row counts of the table, so a delivery needs no history beside it.
``save_state`` appends only the rows that changed; the newest row of a value holds.

Filling: components above 1/4096 of the rows (so at most 4096 of them) are given one
by one, largest first, to the split that lacks most; all others fall into 4096 hash
buckets, which are given out the same way.  The driver sees at most 8192 sizes.  Buckets
instead of single components cost the balance at most one bucket of small components.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ustrip
from ..operators.components import connected_components
from ..operators.links import LINK_FIELDS
from ..operators.skew import hot_keys, join_unique
from ..storage import materialize, release

#: Spellings of "no value".
NO_VALUE = ("", "-", "n/a", "yok")

BUCKETS = 4096
STATE_SCHEMA = "value string, component string, part string, split string, status string, n_rows bigint"
STATE_COLUMNS = [c.split()[0] for c in STATE_SCHEMA.split(", ")]


def link_keys(fields: dict[str, str] | None = None) -> Column:
    """Sorted array of the ``field=value`` link values of a record, normalised."""
    entries = []
    for name, path in (fields or LINK_FIELDS).items():
        v = F.lower(ustrip(F.col(path)))
        entries.append(F.when(~v.isin(*NO_VALUE), F.concat(F.lit(f"{name}="), v)))
    return F.array_sort(F.array_compact(F.array(*entries)))


def all_keys(key: str, fields: dict[str, str] | None = None) -> Column:
    """Link values, or ``id=<key>`` where there are none."""
    own = F.concat(F.lit("id="), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.when(F.size(link_keys(fields)) > 0, link_keys(fields)).otherwise(F.array(own))


@dataclass
class SplitState:
    """The component table and what a delivery changed in it."""

    table: DataFrame  # STATE_COLUMNS and changed; status is 'assigned', 'new' or 'quarantined'
    sets: DataFrame  # ks, node, n_rows: distinct key sets of the delivery
    hot: list
    chosen: tuple[DataFrame, DataFrame] | None = None  # what assign gave to large components and to buckets


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def fold(records: DataFrame, key: str, state: DataFrame | None = None, fields: dict[str, str] | None = None) -> SplitState:
    """Fold a delivery into the component table (steps 1 to 3)."""
    sets = records.select(all_keys(key, fields).alias("ks")).groupBy("ks").agg(F.count("*").alias("n_rows"))
    sets = materialize(sets.withColumn("node", F.col("ks")[0]), "link-sets")
    came = sets.groupBy("node").agg(F.sum("n_rows").alias("came"))
    n_rows = sets.agg(F.sum("n_rows")).first()[0] or 0
    hot = hot_keys(came, "node", "came", n_rows)
    edges = sets.select(F.col("node").alias("a"), F.explode("ks").alias("b"))
    fresh = [F.lit(None).cast("string").alias("split"), F.lit("new").alias("status"), F.coalesce("came", F.lit(0).cast("bigint")).alias("n_rows"), F.lit(True).alias("changed")]
    came = came.withColumnRenamed("node", "value")
    if state is None:
        comp = connected_components(edges).select(F.col("node").alias("value"), F.col("root").alias("component"))
        table = comp.join(came, "value", "left").select("value", "component", F.col("component").alias("part"), *fresh)
        return SplitState(materialize(table, "components"), sets, hot)
    # known values stand for their component
    names = edges.select("b").distinct().join(state.select(F.col("value").alias("b"), "component"), "b", "left")
    names = materialize(names.select("b", F.coalesce("component", "b").alias("c"), F.col("component").isNotNull().alias("known")), "link-names")
    hot_b = hot_keys(edges.groupBy("b").agg(F.count("*").alias("n")), "b", "n", n_rows)
    e = join_unique(edges, names.select("b", "c"), "b", hot_b, F.xxhash64("a")).withColumnRenamed("c", "cb")
    e = join_unique(e, names.select(F.col("b").alias("a"), F.col("c").alias("ca")), "a", hot, F.xxhash64("b"))
    merged = connected_components(e.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    merged = materialize(merged.select(F.col("node").alias("component"), "root"), "merges")
    # the old components: how many values, and the splits of their parts
    old = state.groupBy("component").agg(F.count("*").alias("n"), F.min("split").alias("lo"), F.max("split").alias("hi"), F.max(F.col("status") == "quarantined").alias("held"))
    old = materialize(old, "old-components")
    n_values = old.agg(F.sum("n")).first()[0] or 0
    fate = old.join(merged, "component").groupBy("root").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("held").alias("held"))
    held = F.col("held") | (F.col("lo") < F.col("hi"))
    fate = fate.select("root", F.when(~held, F.col("hi")).alias("one"), F.when(held, "quarantined").when(F.col("hi").isNotNull(), "assigned").otherwise("new").alias("fate"))
    change = merged.join(fate, "root", "left").select("component", "root", "one", F.coalesce("fate", F.lit("new")).alias("fate"))
    hot_c = hot_keys(old, "component", "n", n_values)
    first = names.where("not known").select(F.col("b").alias("value"), F.col("b").alias("component"), F.col("b").alias("part"), F.lit(None).cast("string").alias("split"), F.lit("new").alias("status"), F.lit(0).cast("bigint").alias("n_rows"), F.lit(True).alias("changed"))
    rows = state.select(*STATE_COLUMNS, F.lit(False).alias("changed")).unionByName(first)
    both = join_unique(rows, change, "component", hot_c, F.xxhash64("value"), "left").join(came, "value", "left")
    touched = F.col("root").isNotNull()
    root = F.coalesce("root", "component")
    # under quarantine a value keeps the split and the name of the part it came from
    apart = F.coalesce(F.col("fate") == "quarantined", F.lit(False)) | (~touched & (F.col("status") == "quarantined"))
    split = F.when(touched & ~apart, F.col("one")).otherwise(F.col("split"))
    status = F.when(touched, F.col("fate")).otherwise(F.col("status"))
    table = both.select(
        "value",
        root.alias("component"),
        F.when(apart, F.col("part")).otherwise(root).alias("part"),
        split.alias("split"),
        status.alias("status"),
        (F.col("n_rows") + F.coalesce("came", F.lit(0))).alias("n_rows"),
        (F.col("changed") | F.col("came").isNotNull() | (root != F.col("component")) | (status != F.col("status")) | ~split.eqNullSafe(F.col("split"))).alias("changed"),
    )
    table = materialize(table, "components")
    release(names, merged, old)
    return SplitState(table, sets, hot)


def _placed(records: DataFrame, key: str, st: SplitState, ks: Column) -> DataFrame:
    keyed = records.select(F.col(key), F.try_element_at(ks, F.lit(1)).alias("value")).where("value is not null")
    split = F.when(F.col("status") != "quarantined", F.col("split"))
    table = st.table.select("value", "component", split.alias("split"), "status")
    return join_unique(keyed, table, "value", st.hot, F.xxhash64(key)).select(key, "component", "split", "status")


def components_of(records: DataFrame, key: str, st: SplitState, fields: dict[str, str] | None = None) -> DataFrame:
    """``(key, component, split, status)`` of each record with a link value."""
    return _placed(records, key, st, link_keys(fields))


def _fill(sizes: list[tuple[str, int]], lack: dict[str, float]) -> dict[str, str]:
    """Largest first to the split that lacks most; ties by name."""
    out = {}
    for name, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        to = max(sorted(lack), key=lambda s: lack[s])
        lack[to] -= n
        out[name] = to
    return out


def assign(records: DataFrame, key: str, targets: DataFrame, st: SplitState, fields: dict[str, str] | None = None) -> DataFrame:
    """``(key, component, split, status)`` for every record, new components filled by deficit.

    ``targets(split, target_share)`` is a small table (one row per split, at most 64 are
    accepted).  A record without link values is its own component, named ``id=<key>``.
    Quarantined records have a null split.  Shares that do not add up to 1 are scaled; they
    are shares of all rows ever folded in, a row delivered twice counting twice.
    """
    shares = {r["split"]: float(r["target_share"]) for r in targets.where("split is not null and target_share > 0").limit(65).collect()}
    if not shares or len(shares) > 64:
        raise ValueError("split targets must name 1 to 64 splits with a positive share")
    total_share = sum(shares.values())
    held = F.col("status") == "quarantined"
    sizes = st.table.groupBy("component", F.when(~held, F.col("split")).alias("split"), "status").agg(F.sum("n_rows").alias("n"))
    sizes = materialize(sizes, "sizes")
    total, given = 0, dict.fromkeys(shares, 0)
    for r in sizes.groupBy("split", "status").agg(F.sum("n").alias("n")).collect():
        total += r["n"]
        if r["status"] == "assigned" and r["split"] in given:
            given[r["split"]] += r["n"]
    lack = {s: total * x / total_share - given[s] for s, x in shares.items()}
    new = sizes.where("status = 'new'")
    is_big = F.col("n") > F.lit(total / BUCKETS)
    big = [(r["component"], r["n"]) for r in new.where(is_big).select("component", "n").collect()]
    bucket = F.pmod(F.xxhash64("component"), F.lit(BUCKETS)).cast("int")
    small = [(r["b"], r["n"]) for r in new.where(~is_big).groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect()]
    release(sizes)
    chosen = _fill(big, lack)
    by_bucket = {int(b): s for b, s in _fill([(f"{b:05d}", n) for b, n in small], lack).items()}
    spark = records.sparkSession
    big_df = spark.createDataFrame(list(chosen.items()), "component string, big_split string")
    bucket_df = spark.createDataFrame(list(by_bucket.items()), "bucket int, bucket_split string")
    st.chosen = (big_df, bucket_df)
    return _settled(_placed(records, key, st, all_keys(key, fields)), st).select(key, "component", "split", "status")


def _settled(rows: DataFrame, st: SplitState) -> DataFrame:
    """New components with the split that ``assign`` chose for them."""
    big, buckets = st.chosen
    bucket = F.pmod(F.xxhash64("component"), F.lit(BUCKETS)).cast("int")
    # both tables have at most BUCKETS rows
    out = rows.withColumn("bucket", bucket).join(F.broadcast(big), "component", "left").join(F.broadcast(buckets), "bucket", "left")
    is_new = F.col("status") == "new"
    return out.withColumn("split", F.when(is_new, F.coalesce("big_split", "bucket_split")).otherwise(F.col("split"))).withColumn("status", F.when(is_new, "assigned").otherwise(F.col("status"))).drop("bucket", "big_split", "bucket_split")


def save_state(st: SplitState, path: str) -> DataFrame:
    """Append the rows that the delivery and ``assign`` changed to the table at ``path``, the whole table to a new path."""
    if st.chosen is None:
        raise ValueError("assign the delivery before its state is saved")
    spark = st.table.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    versions = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(root) if f.getPath().getName().startswith("version=")] if fs.exists(root) else []
    rows = _settled(st.table.where("changed") if versions else st.table, st).select(*STATE_COLUMNS)
    rows.write.mode("error").parquet(f"{path}/version={max(versions, default=-1) + 1}")
    return load_state(spark, path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``: of each value the row of the newest version."""
    rows = spark.read.schema(STATE_SCHEMA + ", version int").parquet(path)
    rest = F.struct(*STATE_COLUMNS[1:])
    return rows.groupBy("value").agg(F.max_by(rest, "version").alias("r")).select("value", "r.*")


def compact_state(spark: SparkSession, path: str, to: str) -> DataFrame:
    """The table at ``path`` written as one version to the new path ``to``."""
    load_state(spark, path).write.mode("error").parquet(f"{to}/version=0")
    return load_state(spark, to)


def conflicts(state: DataFrame) -> DataFrame:
    """``(component, part, split, n_values, n_rows)``: the parts of each quarantined component."""
    return state.where("status = 'quarantined'").groupBy("component", "part", "split").agg(F.count("*").alias("n_values"), F.sum("n_rows").alias("n_rows"))


def resolve(state: DataFrame, decisions: DataFrame, path: str) -> DataFrame:
    """Settle quarantined components: ``decisions(component, split)``, one row for each, are appended at ``path``.

    Decisions on components that are not quarantined, or without a split, change nothing.
    """
    d = decisions.where("component is not null and split is not null").groupBy("component").agg(F.min("split").alias("s"))
    rows = state.where("status = 'quarantined'").join(d, "component")
    table = rows.select("value", "component", F.col("component").alias("part"), F.col("s").alias("split"), F.lit("assigned").alias("status"), "n_rows", F.lit(True).alias("changed"))
    none = state.sparkSession.createDataFrame([], "component string, big_split string")
    st = SplitState(table, table, [])
    st.chosen = (none, state.sparkSession.createDataFrame([], "bucket int, bucket_split string"))
    return save_state(st, path)
