"""Problems 3 and 5: nested records to flat tables, references without a target."""

from __future__ import annotations

import json

import pytest
from conftest import rows

from claimweave.operators import nested, orphans
from claimweave.operators.graph import connected_components
from claimweave.operators.orphans import ForeignKey
from claimweave.operators.skew import lookup_join

DAMAGE = {"damage_id": "C1", "supporting_images": ["a", "b", None, ""]}
EVAL = {"id_evaluacion": "E1", "damages": [DAMAGE], "estimacion": {"parts_lookup_missing": ["hood"]}, "audit": {"input_hashes": ["h1"]}}


def children(spark, *payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "rec bigint, payload string")
    return rows(nested.evaluation_children(df, "payload"))


WHOLE = {("E1", "damages", "E1", "C1"), ("E1", "supporting_images", "C1", "a"), ("E1", "supporting_images", "C1", "b"), ("E1", "parts_lookup_missing", "E1", "hood"), ("E1", "input_hashes", "E1", "h1")}


@pytest.mark.parametrize(
    "shape",
    [
        EVAL,
        [EVAL],
        {"result": EVAL},
        {"payload": {"output": EVAL}},
        json.dumps(EVAL),
        {**EVAL, "damages": json.dumps([DAMAGE])},
        {**EVAL, "damages": DAMAGE},
        {**EVAL, "damages": {"C1": {"supporting_images": ["a", "b"]}}},
        {**EVAL, "audit": json.dumps(EVAL["audit"])},
        {**{k: v for k, v in EVAL.items() if k != "audit"}, "meta": {"audit": EVAL["audit"]}},
        {**EVAL, "estimacion": [EVAL["estimacion"]]},
        {**EVAL, "estimacion": {"parts_lookup_missing": "hood"}, "audit": {"input_hashes": "h1"}},
    ],
)
def test_every_shape_gives_the_same_children(spark, shape):
    assert children(spark, json.dumps(shape)) == WHOLE


def test_broken_payloads_and_repeats(spark):
    text = json.dumps(EVAL)
    assert children(spark, text, text, "﻿" + text, None, "", "  ", text[:-5], "<error>", "12") == WHOLE


def test_statuses_and_identities(spark):
    df = spark.createDataFrame([(1, '{"a": {"x": 1}, "b": {"x": 1}}'), (2, '{"b": {"x": 1}, "a": {"x": 1}}'), (3, "{"), (4, None), (5, " ")], "rec int, payload string")
    s = nested.shred(df, "rec", "payload")
    status = {k: (st, h is not None) for k, st, h in rows(s.occurrences)}
    assert status == {"1": ("ok", True), "2": ("ok", True), "3": ("broken", False), "4": ("null", False), "5": ("empty", False)}
    assert s.objects.count() == 2  # the order of keys does not matter, equal parts are stored once
    assert s.occurrences.where("root_hash is not null").select("root_hash").distinct().count() == 1
    assert rows(s.bridge.where("child_hash is not null").select("field", "ordinal")) == {("a", 0), ("b", 1)}


def test_deep_nesting_and_long_text(spark):
    deep = "[" * 400 + '{"id_evaluacion": "D", "damages": [{"damage_id": "C9"}]}' + "]" * 400
    assert children(spark, deep) == {("D", "damages", "D", "C9")}
    # beyond what the library's parser reaches
    deeper = '{"a": ' * 60_000 + '{"id_evaluacion": "E", "damages": [{"damage_id": "C7"}]}' + "}" * 60_000
    assert nested.open_json(deeper)[0] == "ok" and nested.open_json(deeper[:-1])[0] == "broken"
    s = nested.shred(spark.createDataFrame([(1, deeper)], "rec int, payload string"), "rec", "payload")
    assert s.occurrences.first()["status"] == "ok" and s.objects.count() == 60_003
    long = json.dumps({"id_evaluacion": "L" * 100_000, "damages": [{"damage_id": "C1"}]})
    assert {r[3] for r in children(spark, long)} == {"C1"}


def test_deep_parser_agrees_with_the_library():
    texts = ['{"a": [1, -2.5e3, "x\\"y", null, true], "b": {}, "c": [], "d": {"e": [[], [{}]]}}', "[]", " [1 , 2 ] ", '{"a": 1, "a": 2}', "[1,]", "[1 2]", '{"a" 1}', '{"a":}', "[", '{"a": 1', "[1]]", "1", '"x"', "", "{,}", "[,1]", '{"a": 1,}', "nul", "[NaN]"]
    for text in texts:
        try:
            want = json.loads(text)
        except ValueError:
            with pytest.raises(ValueError):
                nested._loads_deep(text)
        else:
            assert repr(nested._loads_deep(text)) == repr(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "rec bigint, payload string, doc_key string")
    s = nested.shred(df, "rec", "payload")
    assert s.occurrences.count() == s.objects.count() == s.bridge.count() == 0
    assert nested.evaluation_children(df, "payload").count() == 0


def test_nested_evaluations_keep_their_own_children(spark):
    outer = {"id_evaluacion": "O", "inner": {"id_evaluacion": "I", "damages": [{"damage_id": "C1"}]}, "damages": [{"damage_id": "C2"}]}
    assert children(spark, json.dumps(outer)) == {("O", "damages", "O", "C2"), ("I", "damages", "I", "C1")}


# --- orphans

FK = ForeignKey("child", "id", "ref", "parent", "id", at="at", start="since", end="until")


def tables(spark, child, parent):
    c = spark.createDataFrame(child, "id bigint, ref bigint, at string").selectExpr("id", "ref", "cast(at as timestamp) as at", "'x' as held_from")
    p = spark.createDataFrame(parent, "id bigint, since string, until string").selectExpr("id", "cast(since as timestamp) as since", "cast(until as timestamp) as until")
    return {"child": c, "parent": p}


def test_interval_of_a_target(spark):
    t = tables(spark, [(1, 7, "2024-01-01"), (2, 7, "2024-01-02"), (3, 7, "2024-02-01"), (4, 7, "2024-01-31"), (5, 8, "2024-01-05"), (6, None, "2024-01-05"), (7, 0, None), (8, 7, None), (2, 7, "2024-01-02")], [(7, "2024-01-02", "2024-02-01"), (7, "2024-01-20", "2024-02-01")])
    found = orphans.orphan_cascade(t, [FK])
    assert rows(found.select("row_id")) == {(1,), (3,), (5,), (7,)}


def test_no_targets_and_no_rows(spark):
    t = tables(spark, [(1, 1, "2024-01-01")], [])
    assert orphans.orphan_cascade(t, [FK]).count() == 1
    t = tables(spark, [], [(1, "2024-01-01", None)])
    assert orphans.orphan_cascade(t, [FK]).count() == 0


def test_cascade_and_cycles(spark):
    a = spark.createDataFrame([(1, 99), (2, 1), (3, 2), (4, None), (5, 4)], "id bigint, up bigint")
    fk = ForeignKey("a", "id", "up", "a", "id")
    found = {(r["row_id"], r["kind"], r["depth"]) for r in orphans.orphan_cascade({"a": a}, [fk]).collect()}
    assert found == {(1, "direct", 0), (2, "inherited", 1), (3, "inherited", 2)}
    loop = spark.createDataFrame([(1, 2), (2, 1)], "id bigint, up bigint")
    assert orphans.orphan_cascade({"a": loop}, [fk]).count() == 0


def test_lookup_join_keeps_hot_and_null_keys(spark):
    left = spark.createDataFrame([(i, 0 if i % 3 else None if i % 2 else i) for i in range(3000)], "n int, k int")
    right = spark.createDataFrame([(0, "hot"), (6, "six")], "k int, v string")
    got = lookup_join(left, right, "k")
    want = left.join(right, "k", "left").select("k", "n", "v")
    assert sorted(map(tuple, got.select("k", "n", "v").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 5), (None, 1), (9, 8), (8, 7), (7, 6), (6, 10)], "src bigint, dst bigint")
    assert rows(connected_components(edges)) == {(1, 1), (2, 1), (3, 1), (6, 6), (7, 6), (8, 6), (9, 6), (10, 6)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "src bigint, dst bigint")
    assert connected_components(chain).select("component").distinct().collect()[0][0] == 0
    assert connected_components(edges.limit(0)).count() == 0
