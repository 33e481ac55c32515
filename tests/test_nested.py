import json
import random

import pytest

from gradeloom.operators.nested import Index, flatten_payloads, flatten_typed, nested_rows

from .factory import frame, record


def rows(payload):
    c = nested_rows([1], [payload.encode()], False)
    return sorted(zip(c["child"], c["parent_pos"], c["pos"]))


DOC = {"rubric": {"criteria": [{"criterion_id": "a", "scoring_anchors": [{"score": 0}, None, {"score": 1}]}, None, {"criterionId": "b", "scoringAnchors": {"score": 1, "description": "x"}}]}, "gold_evaluation": {"criterion_results": [{"criterion_id": "b"}, {"criterion_id": "zz"}, None]}}
WANT = sorted([("criteria", -1, 0), ("criteria", -1, 2), ("scoring_anchors", 0, 0), ("scoring_anchors", 0, 2), ("scoring_anchors", 2, 0), ("criterion_results", 2, 0), ("criterion_results", -1, 1)])


@pytest.mark.parametrize("wrap", [lambda d: json.dumps(d), lambda d: json.dumps(d, indent=3), lambda d: json.dumps(json.dumps(d)), lambda d: json.dumps({"batch": 1, "record": d}), lambda d: "  " + json.dumps(d) + "\n", lambda d: json.dumps({**d, "rubric": json.dumps(d["rubric"])}), lambda d: json.dumps({**d, "rubric": {"criteria": json.dumps(d["rubric"]["criteria"])}})])
def test_layouts(wrap):
    assert rows(wrap(DOC)) == WANT


def test_keyed_objects():
    d = {"rubric": {"criteria": {"a": {"max": 1}, "b": {"scoring_anchors": [{"score": 1}]}}}, "gold_evaluation": {"criterion_results": {"b": {"score": 1}}}}
    assert rows(json.dumps(d)) == sorted([("criteria", -1, 0), ("criteria", -1, 1), ("scoring_anchors", 1, 0), ("criterion_results", 1, 0)])


@pytest.mark.parametrize("bad", ["", " ", "null", "x", "{", '{"a":1', '{"a":1}}', '{"a":1} {"b":2}', '{"a":}', '{"a" 1}', "[1,]", "[1 2]", '{"a":1,}', '{,"a":1}', '{"a":"\\x"}', '{"a":01}', '{"a":tru}', '["a":1]', '{"a","b"}', '{"a":"line\nbreak"}', '{"rubric":{"criteria":[{"criterion_id":"a"}]}', '{"a":[1}]', '{1:2}'])
def test_not_one_complete_text(bad):
    assert rows(bad) == []
    ix = Index([bad.encode()])
    try:
        json.loads(bad)
        ok = True
    except ValueError:
        ok = False
    assert bool(ix.bad[0]) == (not ok)


def test_grammar_against_parser_by_mutation():
    rng = random.Random(5)
    base = json.dumps({"a": [1, -2.5e3, {"b": "x\\\"y", "c": []}, None, True], "d": {"e": {}}, "f": "ü\\u00e9"})
    texts = [base]
    for _ in range(1500):
        s = list(base)
        for _ in range(rng.randint(1, 2)):
            i = rng.randrange(len(s))
            s[i : i + rng.randint(0, 1)] = rng.choice(list('{}[],:"\\ 1ae') + [""])
        texts.append("".join(s))

    def valid(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    ix = Index([t.encode() for t in texts])
    wrong = [t for t, b in zip(texts, ix.bad) if valid(t) == bool(b)]
    assert wrong == []


def test_dataframe_edges(spark):
    df = spark.createDataFrame([(1, json.dumps(DOC), "clash"), (2, None, None), (3, "", ""), (1, json.dumps(DOC), "x"), (None, json.dumps(DOC), "x")], "raw_id bigint, payload string, child string")
    got = flatten_payloads(df, "raw_id", "payload").collect()
    assert len(got) == 3 * len(WANT)
    assert {r.element_id for r in got if r.child == "criteria"} == {"a", "b"}
    assert flatten_payloads(df.limit(0), "raw_id", "payload").count() == 0
    long = json.dumps({**DOC, "x": "y" * 500_000})
    assert len(rows(long)) == len(WANT)


def test_typed(spark):
    r = record(1, rubric__criteria=[None, record(1)["rubric"]["criteria"][0]])
    got = {(x.child, x.parent_pos, x.pos) for x in flatten_typed(frame(spark, [r]), "record_key").collect()}
    assert got == {("criteria", -1, 1), ("scoring_anchors", 1, 0), ("scoring_anchors", 1, 1), ("criterion_results", 1, 0), ("criterion_results", -1, 1)}
