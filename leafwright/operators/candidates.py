"""Candidates for the four subtasks: cut-off texts, titles, visual blocks, tables split across pages.

Blocks are rows (doc_id, id, page, type, content, bbox ..); id is the 1-based reading position, idx = id - 1.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions import bbox as B
from leafwright.functions import text as X
from leafwright.runtime import fill

TEXTUAL = ("text", "list_item")
TITLES = ("title", "TOC-title", "section-title")
#: Block types of the image-text association, and what some of them count as.
VISUAL = ("image_block", "image", "table", "chart", "table_footnote", "image_footnote", "table_caption", "image_caption", *TITLES, "figure", "fig-title", "fig-caption", "tab-title", "tab-caption")
FOLDED = {
    "image_block": "image", "chart": "image", "figure": "image", "TOC-title": "title", "section-title": "title", "fig-title": "image_caption", "fig-caption": "image_caption", "tab-title": "table_caption", "tab-caption": "table_caption",
}
#: Types that may lie inside an image block.
NESTED = ("image", "chart", "image_footnote", "image_caption", "figure", "fig-title", "fig-caption")


def is_barrier(kind: Column) -> Column:
    """Equations and titles of any sort end the search for the rest of a text."""
    return kind.contains("equation") | kind.contains("title")


def truncation_pairs(blocks: DataFrame) -> DataFrame:
    """doc_id, idx, next_idx: each text that may be cut off, and the first later text that may be its rest.

    A digit is not followed by a digit. Null contents count as empty and are in no pair.
    """
    content = F.coalesce("content", F.lit(""))
    textual = F.col("type").isin(*TEXTUAL)
    goes_on = textual & X.may_go_on(content)
    digit = X.starts_with_digit(content)
    b = blocks.select("doc_id", "id", "type", content.alias("content"))
    found = fill(b, "doc_id", "id", {
        "any": F.when(goes_on, F.col("id")), "other": F.when(goes_on & ~digit, F.col("id")), "barrier": F.when(is_barrier(F.col("type")), F.col("id")),
    }, forward=False)
    to = F.when(digit, F.col("other")).otherwise(F.col("any"))
    return found.filter(textual & X.may_be_cut_off(content)).withColumn("to", to).filter(F.col("to").isNotNull() & (F.col("barrier").isNull() | (F.col("to") < F.col("barrier")))).select("doc_id", (F.col("id") - 1).alias("idx"), (F.col("to") - 1).alias("next_idx"))


def truncation_rows(blocks: DataFrame) -> DataFrame:
    """doc_id, ord, idx, page, box, content: rows for the model, of both sides of all pairs, each once."""
    pairs = truncation_pairs(blocks)
    # in order of discovery: a pair's first side, then its second
    sides = pairs.select("doc_id", "idx", (2 * F.col("idx")).alias("ord")).unionByName(pairs.select("doc_id", F.col("next_idx").alias("idx"), (2 * F.col("idx") + 1).alias("ord")))
    once = sides.groupBy("doc_id", "idx").agg(F.min("ord").alias("ord"))
    b = blocks.select("doc_id", (F.col("id") - 1).alias("idx"), "page", B.thousandths(B.four(F.col("bbox"))).alias("box"), X.shortened(F.coalesce("content", F.lit(""))).alias("content"))
    return once.join(b, ["doc_id", "idx"]).select("doc_id", "ord", "idx", "page", "box", "content")


def title_rows(blocks: DataFrame, most: int = 50) -> DataFrame:
    """doc_id, ord, idx, page, box, content of all titles, texts cut to `most` characters."""
    return blocks.filter(F.col("type").isin(*TITLES)).select("doc_id", (F.col("id") - 1).alias("ord"), (F.col("id") - 1).alias("idx"), "page", B.thousandths(B.four(F.col("bbox"))).alias("box"), F.substring(F.coalesce("content", F.lit("")), 1, most).alias("content"))


def folded_type(kind: Column) -> Column:
    out = kind
    for a, b in FOLDED.items():
        out = F.when(kind == a, b).otherwise(out)
    return out


def containment_links(blocks: DataFrame, large: tuple[str, ...] = ("image_block",), nested: tuple[str, ...] = NESTED) -> DataFrame:
    """doc_id, idx, large_idx: blocks that lie inside a large block, the first such in reading order. Pages are not compared."""
    b = blocks.withColumns({"box": B.four(F.col("bbox")), "type": F.when(F.col("type") == "seal", "image").otherwise(F.col("type"))})
    inner = b.filter(F.col("type").isin(*nested)).select("doc_id", "id", "box")
    outer = b.filter(F.col("type").isin(*large)).select("doc_id", F.col("id").alias("large_id"), F.col("box").alias("large_box"))
    hit = inner.join(outer, "doc_id").filter((F.col("id") != F.col("large_id")) & B.inside(F.col("box"), F.col("large_box")))
    return hit.groupBy("doc_id", "id").agg(F.min("large_id").alias("large_id")).select("doc_id", (F.col("id") - 1).alias("idx"), (F.col("large_id") - 1).alias("large_idx"))


def visual_rows(blocks: DataFrame, most: int = 50) -> DataFrame:
    """doc_id, ord, idx, type, page, box, content of visual blocks and titles that lie in no image block."""
    kind = F.when(F.col("type") == "seal", "image").otherwise(F.col("type"))
    content = F.when(folded_type(kind).isin("image", "table"), F.lit("None")).otherwise(F.coalesce("content", F.lit("")))
    rows = blocks.filter(kind.isin(*VISUAL)).select("doc_id", (F.col("id") - 1).alias("ord"), (F.col("id") - 1).alias("idx"), folded_type(kind).alias("type"), "page", B.thousandths(B.four(F.col("bbox"))).alias("box"), F.substring(content, 1, most).alias("content"))
    return rows.join(containment_links(blocks), ["doc_id", "idx"], "left_anti")


def table_pairs(blocks: DataFrame) -> DataFrame:
    """doc_id, upper_idx, lower_idx: the last table of a page and the first of the next."""
    pages = blocks.filter("type = 'table'").groupBy("doc_id", "page").agg(F.max("id").alias("last"), F.min("id").alias("first"))
    below = pages.select("doc_id", (F.col("page") - 1).alias("page"), (F.col("first") - 1).alias("lower_idx"))
    return pages.join(below, ["doc_id", "page"]).select("doc_id", (F.col("last") - 1).alias("upper_idx"), "lower_idx")


def caption_of_table(pairs: DataFrame, blocks: DataFrame, idx: str, out: str) -> DataFrame:
    """pairs with the caption of the table at idx: the block before it, if that is a caption, a title or a short text like one."""
    like = r"(?i)^(table|表|exhibit|figure|图)\s*[0-9]+|^[0-9]+(\.[0-9]+)*\s+|^[一二三四五六七八九十]+、"
    text = X.strip(F.coalesce("content", F.lit("")))
    is_caption = F.col("type").isin("table_caption", "tab-title", "tab-caption", "title") | ((F.col("type") == "text") & (F.length(text) < 150) & text.rlike(like))
    before = blocks.select("doc_id", F.col("id").alias(idx), F.when(is_caption, text).alias(out))
    return pairs.join(before, ["doc_id", idx], "left")


#: Marks at the end of a continued table's caption, and one that may stand anywhere.
CONTINUED_AT_END = ("(续)", "(续表)", "(续上表)", "(continued)", "(cont.)", "(cont'd)", "(…continued)", "续表")
CONTINUED_ANYWHERE = "(continued)"
#: Patterns of caption numbers by kind, the first that matches counts.
CAPTION_NUMBERS = (
    ("Exhibit", r"[Ee]xhibit\s*([0-9]+)"), ("Exhibit", r"EXHIBIT\s*([0-9]+)"), ("Table", r"[Tt]able\s*([A-Za-z]?\s*-?\s*[0-9.]+)"), ("Table", r"[Tt]ab\.?\s*([A-Za-z]?\s*-?\s*[0-9.]+)"), ("Table", r"TABLE\s*([A-Za-z]?\s*-?\s*[0-9.]+)"),
    ("Table", r"表\s*([A-Za-z]?\s*-?\s*[0-9.]+)"), ("Figure", r"[Ff]igure\s*([0-9]+)"), ("Figure", r"图\s*([0-9]+)"), ("CN", r"^([一二三四五六七八九十]+)、"),
)
FOOTNOTE_LIKE = ("table_footnote", "table_caption", "tab-caption", "tab-title")


def caption_number(caption: Column) -> Column:
    """Kind and number of a caption, as "Table 3"; null without one."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(CAPTION_NUMBERS):
        number = F.upper(F.regexp_replace(F.regexp_extract(caption, pattern, 1), "[ -]", ""))
        out = F.when(caption.rlike(pattern), F.concat(F.lit(kind + " "), number)).otherwise(out)
    return out


def _clean_caption(caption: Column) -> Column:
    """Lower case without marks of continuation at the end, letters and digits only."""
    marks = "|".join(re.escape(m.lower()) for m in CONTINUED_AT_END)
    return F.regexp_replace(F.regexp_replace(F.lower(X.nfkc(caption)), f"(?:{marks})+$", ""), r"[^\p{L}\p{M}\p{N}_]", "")


def pair_checks(blocks: DataFrame) -> DataFrame:
    """What the screen looks at, a row per table pair: doc_id, upper_idx, lower_idx, text_after, text_before, cap1, cap2, number1,
    number2, differ, marked, notes (footnotes after the upper table), width1, width2."""
    pairs = table_pairs(blocks)
    page = blocks.filter(F.col("type").isin("text", "list_item", "list")).groupBy("doc_id", "page").agg(F.max("id").alias("last_text"), F.min("id").alias("first_text"))
    place = blocks.filter("type = 'table'").select("doc_id", (F.col("id") - 1).alias("idx"), "page", B.four(F.col("bbox")).alias("box"))
    width = lambda b: F.col(b)[2] - F.col(b)[0]
    p = pairs.join(place.select("doc_id", F.col("idx").alias("upper_idx"), F.col("page").alias("up"), F.col("box").alias("ub")), ["doc_id", "upper_idx"])
    p = p.join(place.select("doc_id", F.col("idx").alias("lower_idx"), F.col("page").alias("lp"), F.col("box").alias("lb")), ["doc_id", "lower_idx"])
    p = p.join(page.select("doc_id", F.col("page").alias("up"), F.col("last_text").alias("after")), ["doc_id", "up"], "left")
    p = p.join(page.select("doc_id", F.col("page").alias("lp"), F.col("first_text").alias("before")), ["doc_id", "lp"], "left")
    p = caption_of_table(caption_of_table(p, blocks, "upper_idx", "cap1"), blocks, "lower_idx", "cap2")
    # footnotes: the run of footnote-like blocks after the upper table, on its page
    other = blocks.filter(~F.col("type").isin(*FOOTNOTE_LIKE)).select("doc_id", "page", F.col("id").alias("other"))
    stop = p.select("doc_id", "upper_idx", F.col("up").alias("page")).join(other, ["doc_id", "page"], "left").filter(F.col("other").isNull() | (F.col("other") > F.col("upper_idx") + 1)).groupBy("doc_id", "upper_idx").agg(F.min("other").alias("stop"))
    last = blocks.groupBy("doc_id", "page").agg(F.max("id").alias("page_end"))
    p = p.join(stop, ["doc_id", "upper_idx"], "left").join(last.withColumnRenamed("page", "up"), ["doc_id", "up"])
    notes = F.coalesce(F.col("stop"), F.col("page_end") + 1) - F.col("upper_idx") - 2
    has1, has2 = F.coalesce(F.col("cap1") != "", F.lit(False)), F.coalesce(F.col("cap2") != "", F.lit(False))
    n1, n2 = caption_number(F.col("cap1")), caption_number(F.col("cap2"))
    differ = F.when(n1.isNotNull() & n2.isNotNull(), n1 != n2).otherwise(_clean_caption(F.col("cap1")) != _clean_caption(F.col("cap2")))
    low = F.lower(X.nfkc(F.col("cap2")))
    marked = F.contains(low, F.lit(CONTINUED_ANYWHERE))
    for mark in CONTINUED_AT_END:
        marked = marked | low.endswith(mark.lower())
    w1, w2 = width("ub"), width("lb")
    no = F.lit(False)
    return p.select(
        "doc_id", "upper_idx", "lower_idx", F.coalesce(F.col("after") > F.col("upper_idx") + 1, no).alias("text_after"), F.coalesce(F.col("before") < F.col("lower_idx") + 1, no).alias("text_before"), "cap1", "cap2",
        n1.alias("number1"), n2.alias("number2"), F.coalesce(has1 & has2 & differ, no).alias("differ"), F.coalesce(marked, no).alias("marked"), notes.alias("notes"), w1.alias("width1"), w2.alias("width2"),
    )


def screened_pairs(blocks: DataFrame) -> DataFrame:
    """doc_id, upper_idx, lower_idx, reason of all table pairs; reason is null where the tables may be one.

    Checks in order: text between, captions, mark of continuation, footnotes, widths, columns. Contents are read for the last
    one only, of the pairs that are left.
    """
    from leafwright.operators.tables import columns_match

    p = pair_checks(blocks)
    has1, has2 = F.coalesce(F.col("cap1") != "", F.lit(False)), F.coalesce(F.col("cap2") != "", F.lit(False))
    w1, w2, notes, differ, marked = (F.col(c) for c in ("width1", "width2", "notes", "differ", "marked"))
    reason = (
        F.when(F.col("text_after"), "text after upper table")
        .when(F.col("text_before"), "text before lower table")
        .when(has2 & ~has1, "caption of lower table only")
        .when(has1 & has2 & differ, "captions differ")
        .when(has2 & ~marked, "no mark of continuation")
        .when(notes > F.when(has2, 1).otherwise(0), "footnotes")
        .when((F.least(w1, w2) > 0) & (F.abs(w1 - w2) / F.least(w1, w2) >= 0.1), "widths differ")
    )
    p = p.select("doc_id", "upper_idx", "lower_idx", reason.alias("reason"))
    html = blocks.filter("type = 'table' and content <> ''").select("doc_id", (F.col("id") - 1).alias("idx"), "content")
    left = p.filter("reason is null").drop("reason")
    left = left.join(html.select("doc_id", F.col("idx").alias("upper_idx"), F.col("content").alias("a")), ["doc_id", "upper_idx"], "left")
    left = left.join(html.select("doc_id", F.col("idx").alias("lower_idx"), F.col("content").alias("b")), ["doc_id", "lower_idx"], "left")
    agree = F.col("a").contains("<tr") & F.col("b").contains("<tr") & columns_match(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")))
    return p.filter("reason is not null").unionByName(left.select("doc_id", "upper_idx", "lower_idx", F.when(~F.coalesce(agree, F.lit(False)), "columns differ").alias("reason")))
