"""Long documents into overlapping page ranges for the model."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def page_chunks(pages: list[int], counts: list[int], size: int = 50, overlap: int = 1, reach: int = 5, single: bool = True) -> list[tuple[int, int]]:
    """Ranges of pages. Each border is the page with most items within `reach` of the wanted size, the first of equals;
    without items there the next page with items, else the last. Ranges reach over the border by overlap.

    A border lies behind the one before it, whatever size and reach are. If the last range, taken from the last border less the overlap,
    has more than three pages, it comes once more by itself.

    single: whether items all on one page give one range; otherwise they give none.
    """
    have = dict(zip(pages, counts, strict=True))
    at = sorted(have)
    if not at:
        return []
    first, last = at[0], at[-1]
    if first == last:
        return [(first, last)] if single else []
    out: list[tuple[int, int]] = []
    border = first
    while border < last:
        near = [p for p in at if max(first, border + size - reach) <= p <= min(last, border + size + reach) and p > border]
        if near:
            to = max(near, key=lambda p: (have[p], -p))
        else:
            to = next((p for p in at if p > border + size), last)
        out.append((first if not out else border - overlap, min(last, to + overlap)))
        border = to
    if last - (border - overlap) > 2:
        out.append((border - overlap, last))
    return out


_RANGE = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def chunk_ranges(items: DataFrame, size: int = 50, overlap: int = 1, reach: int = 5, single: bool = True) -> DataFrame:
    """doc_id, chunk_no, start, end for items (doc_id, page). Only a count per page is gathered for a document."""

    @F.pandas_udf(_RANGE)
    def ranges(pages: pd.Series) -> pd.Series:
        return pages.map(lambda ps: [{"start": a, "end": b} for a, b in page_chunks([p["page"] for p in ps], [p["n"] for p in ps], size, overlap, reach, single)])

    per_page = items.filter("page is not null").groupBy("doc_id", "page").agg(F.count("*").cast("int").alias("n"))
    docs = per_page.groupBy("doc_id").agg(F.collect_list(F.struct("page", "n")).alias("pages"))
    return docs.select("doc_id", F.posexplode(ranges("pages")).alias("chunk_no", "r")).select("doc_id", "chunk_no", "r.start", "r.end")


def chunk_items(items: DataFrame, ranges: DataFrame) -> DataFrame:
    """items with chunk_no: each item once for every range its page is in."""
    pages = ranges.select("doc_id", "chunk_no", F.explode(F.sequence("start", "end")).alias("page"))
    return items.join(pages, ["doc_id", "page"]).select(*items.columns, "chunk_no")


def chunk_pages(chunked: DataFrame) -> DataFrame:
    """doc_id, chunk_no, pages: the distinct pages of each chunk's items, in order."""
    return chunked.groupBy("doc_id", "chunk_no").agg(F.array_sort(F.collect_set("page")).alias("pages"))
