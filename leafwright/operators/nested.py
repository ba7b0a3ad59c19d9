"""Nested tree records to flat tables, with Merkle identities of subtrees.

Every node gets an object_id: a hash over its canonical own fields and, bottom-up, its children's
object_ids with relation and ordinal. Identical subtrees share one object row; every place where they
occur stays as an occurrence row with node and parent numbers, and the object-to-object bridge keeps
relation and ordinal.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of a node that have columns of their own; all others go to `extra`.
OWN_FIELDS = ("type", "title", "metadata", "content", "level", "location", "block_ids", "children", "subnode")
_PLACE = T.StructType([T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("page", T.IntegerType())])
_EDGE = T.StructType([T.StructField("relation", T.StringType()), T.StructField("ordinal", T.IntegerType()), T.StructField("child_id", T.StringType())])
NODE_COLUMNS: dict[str, T.DataType] = {
    "node_no": T.IntegerType(), "parent_no": T.IntegerType(), "relation": T.StringType(), "ordinal": T.IntegerType(), "depth": T.IntegerType(),
    "object_id": T.StringType(), "type": T.StringType(), "title": T.StringType(), "metadata": T.StringType(), "content": T.StringType(), "level": T.IntegerType(),
    "block_ids": T.ArrayType(T.IntegerType()), "places": T.ArrayType(_PLACE), "extra": T.StringType(), "edges": T.ArrayType(_EDGE),
}


def _loads(text: object) -> object:
    try:
        return json.loads(text)
    except (ValueError, TypeError, RecursionError):
        return None


def _is_node(v: object) -> bool:
    return isinstance(v, dict) and ("type" in v or "children" in v or "block_ids" in v or "title" in v)


def tree_roots(payload: object) -> list[dict]:
    """The root nodes of a payload: a node, a list of nodes, either as a JSON string once more or inside envelopes, however many.

    An envelope with several nodes has as many roots; every layer is smaller than the one around it, so this ends.
    """
    value = payload
    while value is not None:
        if isinstance(value, (str, bytes)):
            value = _loads(value)
        elif isinstance(value, list):
            if len(value) == 1:
                value = value[0]
            else:
                return [v for v in value if _is_node(v)]
        elif isinstance(value, dict):
            if _is_node(value):
                return [value]
            inside = [v for v in value.values() if isinstance(v, (dict, list)) or (isinstance(v, str) and v[:1] in "{[\"" and v[:1])]
            nodes = [v for v in inside if _is_node(v)]
            if nodes:
                return nodes
            value = inside[0] if inside else None
        else:
            return []
    return []


def _entries(v: object) -> list[dict]:
    if isinstance(v, str):
        v = _loads(v)
    if isinstance(v, dict):
        return [v] if _is_node(v) or not v else [x for x in v.values() if isinstance(x, dict)]
    return [x for x in v if isinstance(x, dict)] if isinstance(v, list) else []


def _text(v: object) -> str | None:
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v, ensure_ascii=False, sort_keys=True)


def _whole(v: object) -> int | None:
    if isinstance(v, bool):
        return None
    try:
        n = int(float(v)) if isinstance(v, str) and not v.strip().lstrip("+-").isdigit() else int(v)
    except (TypeError, ValueError, OverflowError):
        return None
    return n if -(2**31) <= n < 2**31 else None


def _number(v: object) -> float | None:
    if isinstance(v, bool):
        return None
    try:
        return float(v)
    except (TypeError, ValueError, OverflowError):
        return None


def _ids(v: object) -> list[int]:
    """Block ids in stored order, each once; single values, digit strings and nested lists count as well."""
    out: list[int] = []
    todo = [v]
    while todo:
        x = todo.pop()
        if isinstance(x, (list, tuple)):
            todo.extend(reversed(x))
        elif isinstance(x, str) and x[:1] == "[":
            todo.append(_loads(x))
        elif isinstance(x, str) and "," in x:
            todo.extend(reversed(x.split(",")))
        elif (n := _whole(x)) is not None and n not in out:
            out.append(n)
    return out


def _places(v: object) -> list[dict]:
    if isinstance(v, str):
        v = _loads(v)
    out = []
    for x in [v] if isinstance(v, dict) else v if isinstance(v, list) else []:
        if isinstance(x, dict):
            box = x.get("bbox")
            box = [_number(b) for b in box] if isinstance(box, list) else None  # every entry keeps its place
            out.append({"bbox": box, "page": _whole(x.get("page"))})
    return out


def flatten_payload(payload: object, hashes: bool = True) -> list[dict]:
    """The nodes of one payload in reading order: a node, its subnode entries, its children, each followed by its own."""
    nodes: list[dict] = []
    stack: list[tuple] = [(r, -1, "root", i, 0) for i, r in reversed(list(enumerate(tree_roots(payload))))]
    while stack:
        raw, parent, relation, ordinal, depth = stack.pop()
        no = len(nodes)
        nodes.append({
            "node_no": no, "parent_no": parent, "relation": relation, "ordinal": ordinal, "depth": depth, "type": _text(raw.get("type")), "title": _text(raw.get("title")),
            "metadata": _text(raw.get("metadata")), "content": _text(raw.get("content")), "level": _whole(raw.get("level")), "block_ids": _ids(raw.get("block_ids")),
            "places": _places(raw.get("location")), "extra": json.dumps(x, ensure_ascii=False, sort_keys=True) if (x := {k: v for k, v in raw.items() if k not in OWN_FIELDS}) else None, "edges": [],
        })
        below = [(x, no, rel, i, depth + 1) for rel in ("subnode", "children") for i, x in enumerate(_entries(raw.get(rel)))]
        stack.extend(reversed(below))
    if hashes:
        for n in reversed(nodes):  # children come after their parent, so their identities are ready
            n["edges"].sort(key=lambda e: (e["relation"] != "subnode", e["ordinal"]))
            own = [n["type"], n["title"], n["metadata"], n["content"], n["level"], n["block_ids"], n["places"], n["extra"], n["edges"]]
            n["object_id"] = blake2b(json.dumps(own, ensure_ascii=False, sort_keys=True).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            if n["parent_no"] >= 0:
                nodes[n["parent_no"]]["edges"].append({"relation": n["relation"], "ordinal": n["ordinal"], "child_id": n["object_id"]})
    return nodes


def _clean(s: str | None) -> str | None:
    if s is None or s.isascii():
        return s
    return s.encode("utf-8", "replace").decode("utf-8")  # lone surrogates cannot be stored


def tree_nodes(trees: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None, payload: str = "payload", only_types: tuple[str, ...] | None = None, titled: bool = False) -> DataFrame:
    """One row per node occurrence of every payload; `keep` columns of trees are carried along.

    A null, empty or incomplete payload has no rows. Columns of trees with other names are ignored, so
    clashing names do no harm. only_types and titled keep only nodes of these types, or with a title.
    """
    columns = columns or list(NODE_COLUMNS)
    keep = keep if keep is not None else ["tree_key"]
    hashes = "object_id" in columns or "edges" in columns
    src = trees.select(*keep, F.col(payload).alias("__payload")).filter(F.col("__payload").isNotNull())
    schema = T.StructType([src.schema[k] for k in keep] + [T.StructField(c, NODE_COLUMNS[c]) for c in columns])
    strings = {c for c in columns if isinstance(NODE_COLUMNS[c], T.StringType)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        made = {f.name: f for f in to_arrow_schema(T.StructType(schema.fields[len(keep) :]))}
        for b in batches:
            out_schema = pa.schema([b.schema.field(k) for k in keep] + [made[c] for c in columns])
            payloads, at = b.column("__payload").to_pylist(), 0
            while at < len(payloads):  # bounded output batches
                take, cols = [], {c: [] for c in columns}
                while at < len(payloads) and len(take) < 20_000:
                    for n in flatten_payload(payloads[at], hashes):
                        if (only_types and n["type"] not in only_types) or (titled and not n["title"]):
                            continue
                        take.append(at)
                        for c in columns:
                            cols[c].append(_clean(n[c]) if c in strings else n[c])
                    at += 1
                idx = pa.array(take, pa.int32())
                arrays = [b.column(k).take(idx) for k in keep]
                arrays += [pa.array(cols[c], out_schema.field(c).type) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return src.mapInArrow(run, schema)


def _newest(trees: DataFrame, nodes: DataFrame, key: str, order: str) -> DataFrame:
    """Nodes of each tree's latest delivery; equal deliveries count once."""
    last = trees.groupBy(key).agg(F.max(order).alias("__last"))
    back = nodes.join(last, key).filter(F.col(order).eqNullSafe(F.col("__last"))).drop("__last", order)
    rest = [c for c in back.columns if c not in (key, "node_no")]
    return back.groupBy(key, "node_no").agg(F.min(F.struct(*rest)).alias("__r")).select(key, "node_no", "__r.*")


def occurrences(trees: DataFrame, key: str = "tree_key", order: str = "loaded_at") -> DataFrame:
    """Flat node table: key, node_no, parent_no (-1 at the root), relation, ordinal, depth, object_id."""
    cols = ["node_no", "parent_no", "relation", "ordinal", "depth", "object_id"]
    return _newest(trees, tree_nodes(trees, cols, [key, order]), key, order)


def objects(trees: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Object store: one row per distinct subtree, with the root node's own fields."""
    columns = columns or ["type", "title", "metadata", "content", "level", "block_ids", "places", "extra"]
    return tree_nodes(trees, ["object_id", *columns], []).groupBy("object_id").agg(*[F.first(c).alias(c) for c in columns])


def object_bridge(trees: DataFrame) -> DataFrame:
    """parent_id, relation, ordinal, child_id: each link between objects once."""
    e = tree_nodes(trees, ["object_id", "edges"], []).select(F.col("object_id").alias("parent_id"), F.explode("edges").alias("e"))
    return e.select("parent_id", "e.relation", "e.ordinal", "e.child_id").distinct()


def _expanded(trees: DataFrame, column: str, key: str, order: str) -> DataFrame:
    """Occurrences with one column of their objects.

    The store has one row per object. An object that occurs very often makes a large partition on the
    occurrence side only, which adaptive execution splits (spark.sql.adaptive.skewJoin).
    """
    occ = occurrences(trees, key, order).select(key, "node_no", "parent_no", "object_id")
    store = objects(trees, [column])
    return occ.join(store, "object_id")


def block_links(trees: DataFrame, key: str = "tree_key", order: str = "loaded_at") -> DataFrame:
    """key, node_no, parent_no, block_id: a row per node and block id; -1 where a node has none."""
    e = _expanded(trees, "block_ids", key, order)
    ids = F.when(F.size("block_ids") > 0, F.col("block_ids")).otherwise(F.array(F.lit(-1)))
    return e.select(key, "node_no", "parent_no", F.explode(ids).alias("block_id"))


def places(trees: DataFrame, key: str = "tree_key", order: str = "loaded_at") -> DataFrame:
    """key, node_no, place_no, page, x1, y1, x2, y2: a row per location of a node; missing or short boxes give nulls."""
    e = _expanded(trees, "places", key, order).select(key, "node_no", F.posexplode("places").alias("place_no", "p"))
    box = [F.get("p.bbox", i).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]
    return e.select(key, "node_no", "place_no", F.col("p.page").alias("page"), *box)


def rebuild(rows: list[dict]) -> dict | None:
    """The nested form of one tree's node rows; inverse of flatten_payload up to key order and value shapes."""
    by: dict[int, dict] = {}
    root = None
    for r in sorted(rows, key=lambda r: r["node_no"]):
        n = {k: r[k] for k in ("type", "title", "metadata", "content", "level", "block_ids")} | {"location": r["places"], "children": [], "subnode": []} | json.loads(r["extra"] or "{}")
        by[r["node_no"]] = n
        if r["parent_no"] < 0:
            root = root or n
        else:
            by[r["parent_no"]][r["relation"]].append(n)
    return root
