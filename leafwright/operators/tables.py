"""Tables of blocks: cells as rows, comparison of table pairs, merging of tables that go on over pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.functions import html_table as H
from leafwright.functions import text as X
from leafwright.runtime import fold_sorted

PLACE = "struct<bbox: array<double>, page: int>"
_CELL = "row int, cell int, col int, colspan int, rowspan int, is_head boolean, text string"


def table_cells(tables: DataFrame, keys: tuple[str, ...] = ("doc_id", "id"), html: str = "content") -> DataFrame:
    """keys, row, cell, col, colspan, rowspan, is_head, text: a row per cell, col being its first column in the grid.

    Contents that are null or hold no cell have no rows.
    """
    src = tables.select(*keys, F.col(html).alias("__html")).filter("__html <> ''")
    names = [x.split()[0] for x in _CELL.split(", ")]
    schema = T.StructType([*(src.schema[k] for k in keys), *T._parse_datatype_string(_CELL).fields])
    types = (pa.int32(),) * 5 + (pa.bool_(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, rows = [], []
            for i, h in enumerate(b.column("__html").to_pylist()):
                for r, row in enumerate(H.grid(H.read_table(h))):
                    for n, (col, c) in enumerate(row):
                        take.append(i)
                        rows.append((r, n, col, c.colspan, c.rowspan, c.head, c.text.strip()))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            idx = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(idx) for k in keys), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], [*keys, *names])

    return src.mapInArrow(run, schema)


def table_shapes(cells: DataFrame, keys: tuple[str, ...] = ("doc_id", "id")) -> DataFrame:
    """keys, n_rows, n_cells, n_cols of each table."""
    return cells.groupBy(*keys).agg((F.max("row") + 1).alias("n_rows"), F.count("*").alias("n_cells"), F.max(F.col("col") + F.col("colspan")).alias("n_cols"))


def row_shapes(cells: DataFrame, keys: tuple[str, ...] = ("doc_id", "id")) -> DataFrame:
    """keys, row, n_cells, colspans, effective: per row its cells, the sum of their spans, the last column taken."""
    own = cells.groupBy(*keys, "row").agg(F.count("*").alias("n_cells"), F.sum("colspan").alias("colspans"))
    spread = cells.withColumn("row", F.explode(F.sequence("row", F.col("row") + F.col("rowspan") - 1))).groupBy(*keys, "row").agg(F.max(F.col("col") + F.col("colspan")).alias("effective"))
    return own.join(spread, [*keys, "row"])


def header_rows(pairs: DataFrame, cells: DataFrame, most: int = 5) -> DataFrame:
    """doc_id, upper_id, lower_id, n_header: equal first rows of both tables, compared cell by cell without white space."""
    c = cells.filter(F.col("row") < most).select("doc_id", "id", "row", "cell", F.struct("colspan", "rowspan", F.regexp_replace("text", r"\s", "").alias("t")).alias("v"))
    up = pairs.join(c.select("doc_id", F.col("id").alias("upper_id"), "row", "cell", F.col("v").alias("a")), ["doc_id", "upper_id"])
    low = pairs.join(c.select("doc_id", F.col("id").alias("lower_id"), "row", "cell", F.col("v").alias("b")), ["doc_id", "lower_id"])
    both = up.join(low, ["doc_id", "upper_id", "lower_id", "row", "cell"], "full")
    unequal = F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("row"))).alias("stop")
    rows = F.max("row").alias("last")
    g = both.groupBy("doc_id", "upper_id", "lower_id").agg(unequal, rows)
    return g.select("doc_id", "upper_id", "lower_id", F.coalesce("stop", F.col("last") + 1).alias("n_header"))


def visual_header_rows(pairs: DataFrame, cells: DataFrame, most: int = 5) -> DataFrame:
    """doc_id, upper_id, lower_id, n_header: equal first rows of both tables, compared by their texts in order and by the last column
    that each row takes, spans from rows above included; where spans stand does not count. A pair whose first rows differ has 0."""
    texts = cells.groupBy("doc_id", "id", "row").agg(F.array_sort(F.collect_list(F.struct("cell", F.regexp_replace(X.nfkc(F.col("text")), r"\s", "").alias("t")))).alias("t"))
    shape = texts.join(row_shapes(cells).select("doc_id", "id", "row", "effective"), ["doc_id", "id", "row"]).filter(F.col("row") < most).select("doc_id", "id", "row", F.struct(F.transform("t", lambda x: x["t"]).alias("t"), "effective").alias("v"))
    up = pairs.join(shape.select("doc_id", F.col("id").alias("upper_id"), "row", F.col("v").alias("a")), ["doc_id", "upper_id"])
    low = pairs.join(shape.select("doc_id", F.col("id").alias("lower_id"), "row", F.col("v").alias("b")), ["doc_id", "lower_id"])
    both = up.join(low, ["doc_id", "upper_id", "lower_id", "row"], "full")
    g = both.groupBy("doc_id", "upper_id", "lower_id").agg(F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("row"))).alias("stop"), F.max("row").alias("last"))
    return g.select("doc_id", "upper_id", "lower_id", F.coalesce("stop", F.col("last") + 1).alias("n_header"))


def _udf(kind: T.DataType):
    def wrap(f):
        @F.pandas_udf(kind)
        def g(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([f(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

        return g

    return wrap


def columns_match(upper: str, lower: str):
    """Whether two tables' columns agree, for the last check of table pairs; it runs after the cheap ones."""
    return _udf(T.BooleanType())(lambda a, b: H.columns_match(H.read_table(a), H.read_table(b)))(upper, lower)


def merge_prompts(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, upper_idx, lower_idx, prompt: the rows at the break, with spans, of pairs that passed all checks."""
    html = blocks.filter("type = 'table'").select("doc_id", (F.col("id") - 1).alias("idx"), F.coalesce("content", F.lit("")).alias("html"))
    p = pairs.join(html.select("doc_id", F.col("idx").alias("upper_idx"), F.col("html").alias("a")), ["doc_id", "upper_idx"]).join(html.select("doc_id", F.col("idx").alias("lower_idx"), F.col("html").alias("b")), ["doc_id", "lower_idx"])
    p = p.filter(columns_match("a", "b"))

    def text(a: str, b: str) -> str | None:
        up, low = H.read_table(a), H.read_table(b)
        if not up.rows or not low.rows:
            return None
        lines = lambda rows: "\n".join(" | ".join(r) for r in rows)
        return f"Upper caption:\nLower caption:\nUpper rows:\n{lines(H.last_rows(up))}\nLower rows:\n{lines(H.first_rows(low, H.header_rows(up, low)))}"

    return p.select("doc_id", "upper_idx", "lower_idx", _udf(T.StringType())(text)("a", "b").alias("prompt")).filter("prompt is not null")


def merged_tables(blocks: DataFrame) -> DataFrame:
    """doc_id, head_id, content, member_ids, locations: chains of tables joined top to bottom into their first table, with the place of each.

    blocks carry table_merge (the partner's id) and cell_list on both sides of a pair. A chain is followed in reading
    order, so that tables over three pages and more keep all their rows.
    """
    from leafwright.operators.tree import place

    t = blocks.filter("type = 'table'").select("doc_id", "id", "content", "table_merge", "cell_list", place(blocks).alias("place"))
    down = t.filter("table_merge > id").select("doc_id", F.col("table_merge").alias("id"), F.col("id").alias("up_id"), F.col("cell_list").alias("flags"))
    chain = t.join(down, ["doc_id", "id"], "left").filter("up_id is not null or table_merge > id")

    def step(state, r):
        out = None
        if state and (r is None or r["up_id"] is None or r["up_id"] not in state["ids"]):
            out = [(state["doc"], state["ids"][0], state["html"], state["ids"], state["places"])] if len(state["ids"]) > 1 else None
            state.clear()
        if r is None:
            return out
        if not state:
            state.update(doc=r["doc_id"], ids=[r["id"]], html=r["content"] or "", places=[r["place"]])
        else:
            state["html"] = H.merge_tables(state["html"], r["content"], r["flags"])
            state["ids"].append(r["id"])
            state["places"].append(r["place"])
        return out

    return fold_sorted(chain, ["doc_id"], ["id"], dict, step, ["content", "up_id", "flags", "place"], f"doc_id long, head_id int, content string, member_ids array<int>, locations array<{PLACE}>")


def without_parts(blocks: DataFrame, merged: DataFrame) -> DataFrame:
    """blocks with merged tables: the first has the whole content, its parts are gone, links to parts lead to it.

    merged_ids and merged_locations hold the parts' ids and places; they are null for all other blocks.
    """
    parts = merged.select("doc_id", "head_id", F.explode(F.slice("member_ids", F.lit(2), F.size("member_ids"))).alias("part"))
    out = blocks.join(parts.select("doc_id", F.col("part").alias("id")), ["doc_id", "id"], "left_anti")
    out = out.join(merged.select("doc_id", F.col("head_id").alias("id"), F.col("content").alias("__whole"), F.col("member_ids").alias("merged_ids"), F.col("locations").alias("merged_locations")), ["doc_id", "id"], "left").withColumn("content", F.coalesce("__whole", "content")).drop("__whole")
    moved = parts.select("doc_id", F.col("part").alias("image"), F.col("head_id").alias("__to"))
    return out.join(moved, ["doc_id", "image"], "left").withColumn("image", F.coalesce("__to", "image")).drop("__to")
