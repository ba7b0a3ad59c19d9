"""Queries of problem 3: nested records to related flat tables."""

from __future__ import annotations

from leafwright.operators import nested
from leafwright.runtime import table


def p3_found(spark, folder):
    return nested.block_links(table(spark, folder, "trees"))


def p3_occurrences(spark, folder):
    return nested.occurrences(table(spark, folder, "trees"))


def p3_places(spark, folder):
    return nested.places(table(spark, folder, "trees"))


def p3_objects(spark, folder):
    return nested.objects(table(spark, folder, "trees"))


def p3_bridge(spark, folder):
    return nested.object_bridge(table(spark, folder, "trees"))


def queries():
    return {f.__name__: f for f in (p3_found, p3_occurrences, p3_places, p3_objects, p3_bridge)}


def _unwrapped(source: str) -> str:
    inside = "CASE WHEN json_valid(j->>'$') THEN (j->>'$')::JSON END"
    return f"SELECT tree_key, CASE json_type(j) WHEN 'VARCHAR' THEN {inside} WHEN 'ARRAY' THEN j->0 WHEN 'OBJECT' THEN CASE WHEN json_exists(j, '$.tree') THEN j->'tree' ELSE j END END AS j FROM {source}"


def _list(e: str) -> str:
    return f"CASE json_type({e}) WHEN 'ARRAY' THEN json_extract({e}, '$[*]') WHEN 'OBJECT' THEN [{e}] ELSE []::JSON[] END"


#: Nodes in reading order, from the latest payload of each tree; envelopes and encodings are taken off layer by layer.
NODES = f"""t AS (SELECT * FROM (SELECT tree_key, payload, row_number() OVER (PARTITION BY tree_key ORDER BY loaded_at DESC) AS rn FROM trees) WHERE rn = 1 AND payload IS NOT NULL),
    j0 AS (SELECT tree_key, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM t), j1 AS ({_unwrapped("j0")}), j2 AS ({_unwrapped("j1")}), j3 AS ({_unwrapped("j2")}), j4 AS ({_unwrapped("j3")}),
    n(tree_key, path, node) AS (SELECT tree_key, [0]::BIGINT[], j FROM j4 WHERE j IS NOT NULL
        UNION ALL SELECT tree_key, list_append(path, k), child FROM (SELECT tree_key, path, unnest(kids) AS child, generate_subscripts(kids, 1) AS k FROM (
            SELECT tree_key, path, list_concat({_list("node->'subnode'")}, {_list("node->'children'")}) AS kids FROM n))),
    m AS (SELECT tree_key, path, node, (row_number() OVER (PARTITION BY tree_key ORDER BY path) - 1)::INT AS node_no FROM n)"""


def oracle_sql():
    ids = "list_distinct(list_transform(regexp_extract_all((node->'block_ids')::VARCHAR, '-?[0-9]+'), lambda x: x::INT))"
    box = ", ".join(f"(p->'bbox'->>{i})::DOUBLE AS {n}" for i, n in enumerate(("x1", "y1", "x2", "y2")))
    return {
        "p3_found": f"""WITH RECURSIVE {NODES}, x AS (SELECT m.tree_key, m.node_no, coalesce(up.node_no, -1) AS parent_no, {ids.replace("node->", "m.node->")} AS ids FROM m LEFT JOIN m up ON up.tree_key = m.tree_key AND up.path = m.path[:-2])
            SELECT tree_key, node_no, parent_no, unnest(CASE WHEN len(ids) > 0 THEN ids ELSE [-1] END) AS block_id FROM x""",
        "p3_places": f"""WITH RECURSIVE {NODES}, x AS (SELECT tree_key, node_no, {_list("node->'location'")} AS ps FROM m), y AS (SELECT tree_key, node_no, unnest(ps) AS p, (generate_subscripts(ps, 1) - 1)::INT AS place_no FROM x)
            SELECT tree_key, node_no, place_no, (p->>'page')::INT AS page, {box} FROM y""",
    }
