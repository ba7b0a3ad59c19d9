import json
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwright.operators import nested
from leafwright.plans import nested_queries

SCHEMA = "tree_key bigint, doc_id bigint, payload string, loaded_at timestamp, object_id string, node_no int"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
ROOT = {"type": "root", "title": "", "block_ids": [], "children": [{"type": "text", "title": "A", "block_ids": [[1], ["2", 3]], "subnode": [{"type": "sub_text", "block_ids": 4}], "children": {"type": "text", "block_ids": None}}, {"type": "text", "title": "B", "block_ids": [5, 5]}]}
LINKS = [(0, -1, -1), (1, 0, 1), (1, 0, 2), (1, 0, 3), (2, 1, 4), (3, 1, -1), (4, 0, 5)]


def links(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 99) for r in rows], SCHEMA)
    return sorted(map(tuple, nested.block_links(df).select("tree_key", "node_no", "parent_no", "block_id").collect()))


@pytest.mark.parametrize("wrap", [json.dumps, lambda r: json.dumps([r], indent=3), lambda r: json.dumps({"model": "m", "doc_id": "1", "tree": r}), lambda r: json.dumps(json.dumps(r)), lambda r: json.dumps({"tree": json.dumps(r)})])
def test_shapes_of_a_payload(spark, wrap):
    assert links(spark, [(7, 1, wrap(ROOT), T0)]) == [(7, *x) for x in LINKS]


def test_broken_null_empty_and_repeated(spark):
    good = json.dumps(ROOT)
    rows = [(1, 1, None, T0), (2, 1, "", T0), (3, 1, good[:-5], T0), (4, 1, good, T0), (4, 1, good, T1), (4, 1, good, T1), (5, 1, "[]", T0), (6, 1, "3", T0), (None, 1, good, None)]
    assert links(spark, rows[:8]) == [(4, *x) for x in LINKS]
    assert links(spark, []) == []


def test_latest_delivery_wins(spark):
    rows = [(4, 1, json.dumps(ROOT), T0), (4, 1, '{"type": "root", "block_ids": [9]}', T1)]
    assert links(spark, rows) == [(4, 0, -1, 9)]


def test_equal_subtrees_are_stored_once(spark):
    leaf = {"type": "text", "title": "x", "block_ids": [1]}
    root = {"type": "root", "children": [leaf, dict(reversed(leaf.items())), {"type": "text", "children": [leaf]}]}
    df = spark.createDataFrame([(k, 1, json.dumps(root), T0, "", 0) for k in (1, 2)], SCHEMA)
    assert nested.occurrences(df).count() == 10
    assert nested.objects(df).count() == 3
    assert nested.object_bridge(df).count() == 4
    assert nested.places(df).count() == 0


def test_registered_objects_have_all_fields(spark, tmp_path):
    leaf = {"type": "text", "title": "x", "metadata": "m", "content": "c", "level": 2, "block_ids": [1, 2], "location": [{"bbox": [1, 2, 3, 4], "page": 5}], "unknown": {"a": 1}}
    root = {"type": "root", "children": [leaf, leaf]}
    spark.createDataFrame([(1, 1, json.dumps(root), T0, "", 0)], SCHEMA).write.parquet(f"{tmp_path}/trees.parquet")
    got = {r.type: r for r in nested_queries.p3_objects(spark, str(tmp_path)).collect()}
    x = got["text"]
    assert (x.title, x.metadata, x.content, x.level, x.block_ids, json.loads(x.extra)) == ("x", "m", "c", 2, [1, 2], {"unknown": {"a": 1}})
    assert [(p.bbox, p.page) for p in x.places] == [([1.0, 2.0, 3.0, 4.0], 5)]
    assert len(got) == 2 and got["root"].content is None


def test_places(spark):
    root = {"type": "root", "location": [{"bbox": [1, 2, 3, 4], "page": "2"}, {"bbox": [1], "page": None}, {"bbox": None}]}
    df = spark.createDataFrame([(1, 1, json.dumps(root), T0, "", 0)], SCHEMA)
    got = sorted(map(tuple, nested.places(df).collect()), key=lambda r: r[2])
    assert got == [(1, 0, 0, 2, 1.0, 2.0, 3.0, 4.0), (1, 0, 1, None, 1.0, None, None, None), (1, 0, 2, None, None, None, None, None)]


node = st.recursive(
    st.fixed_dictionaries({"type": st.sampled_from(["text", "table"]), "title": st.text(max_size=3), "block_ids": st.lists(st.integers(0, 9), unique=True, max_size=2)}),
    lambda x: st.fixed_dictionaries({"type": st.just("text"), "title": st.text(max_size=2), "children": st.lists(x, max_size=3), "subnode": st.lists(x, max_size=2)}),
    max_leaves=12,
)


@settings(max_examples=60, deadline=None)
@given(node)
def test_round_trip(root):
    rows = nested.flatten_payload(json.dumps(root))
    again = nested.flatten_payload(json.dumps(nested.rebuild(rows)))
    assert [(r["node_no"], r["parent_no"], r["object_id"]) for r in rows] == [(r["node_no"], r["parent_no"], r["object_id"]) for r in again]
