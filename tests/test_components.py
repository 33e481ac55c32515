from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gradeloom.operators import components, skew
from gradeloom.operators.links import benchmark_collisions, leakage, record_components

from .factory import frame, record


def naive(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None:
            continue
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    return {r.node: r.root for r in components.connected_components(df).collect()}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdefghijklmnop"), st.sampled_from("abcdefghijklmnop")), max_size=25))
def test_equals_union_find(spark, edges):
    assert run(spark, edges) == naive(edges)


def test_chain_star_nulls_and_empty(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    star = [("s", f"t{i}") for i in range(30)] + [("s", "t1")] * 5
    edges = [*chain, *star, (None, "x"), ("lone", "lone")]
    assert run(spark, edges) == naive(edges)
    assert run(spark, []) == {}


def test_hot_vertices_are_salted(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_ROWS", 1)
    edges = [("hub", f"v{i}") for i in range(200)] + [(f"v{i}", f"w{i}") for i in range(0, 200, 7)]
    assert run(spark, edges) == naive(edges)


def test_records_link_through_any_key(spark):
    rows = [
        record(1, metadata__subject_group_id="s", metadata__exam_family="a"),
        record(2, metadata__subject_group_id="s", metadata__exam_family="b"),
        record(3, metadata__exam_family="b"),
        record(4, metadata__exam_family=None, metadata__question_family=None, task__task_id=""),
    ]
    got = {r.record_key: r.component for r in record_components(frame(spark, rows), "record_key").collect()}
    assert got[1] == got[2] == got[3] and got[4] == "id=4"


def test_leakage_and_benchmark(spark):
    rows = [record(1, task__task_id="task-1", metadata__split="train"), record(2, task__task_id="task-1", metadata__split="test"), record(3, metadata__split="benchmark", metadata__exam_family="x"), record(4, metadata__exam_family="x")]
    df = frame(spark, rows)
    assert [(r.field, r.value, r.splits) for r in leakage(df).collect()] == [("task_id", "task-1", "test,train")]
    assert [r.record_key for r in benchmark_collisions(df, "record_key").collect()] == [4]
