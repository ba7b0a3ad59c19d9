"""Vendors' block labels to canonical types and sub-types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANONICAL = ("title", "text", "image", "table", "caption")
#: Supplements of a page and the sub-types they stand for.
SUPPLEMENTS = {
    "page_title": "page_title", "page_number": "page_number", "number": "page_number", "page_footnote": "page_footnote", "footnote": "page_footnote",
    "header": "header", "aside_text": "aside_text", "footer": "footer",
}
SUPPLEMENT_TYPES = ("page_title", "page_number", "page_footnote", "header", "aside_text", "footer")
#: Label to (canonical, sub-type) of each vendor; labels not listed are text.
_A = {
    "title": ("title", "title"), "image": ("image", "image"), "table": ("table", "table"), "image_caption": ("caption", "image_caption"), "table_caption": ("caption", "table_caption"), "image_footnote": ("caption", "image_footnote"), "table_footnote": ("caption", "table_footnote"),
    "equation": ("text", "equation"), "interline_equation": ("text", "equation"), "inline_equation": ("text", "equation"), "list": ("text", "list_item"),
}
_C = {
    "paragraph_title": ("title", "title"), "doc_title": ("title", "title"), "image": ("image", "image"), "chart": ("image", "image"), "footer_image": ("image", "image"), "header_image": ("image", "image"), "seal": ("image", "image"), "table": ("table", "table"),
    "figure_title": ("caption", "image_caption"), "vision_footnote": ("caption", "image_footnote"), "inline_formula": ("text", "equation"), "display_formula": ("text", "equation"),
}
_D = {
    "catalogue": ("title", "title"), "header": ("text", "header"), "foot": ("text", "footer"), "fnote": ("text", "page_footnote"), "fig": ("image", "image"), "tab": ("table", "table"), "cap": ("caption", "image_caption"), "list": ("text", "list_item"), "equ": ("text", "equation"),
}
_E = {
    "doc_title": ("title", "title"), "paragraph_title": ("title", "title"), "image": ("image", "image"), "chart": ("image", "image"), "seal": ("image", "image"), "table": ("table", "table"), "figure_title": ("caption", "image_caption"), "vision_footnote": ("caption", "image_footnote"),
    "display_formula": ("text", "equation"), "inline_formula": ("text", "equation"), "formula": ("text", "equation"),
}
#: Labels whose blocks are left out.
SKIPPED = ("discarded", "image_body", "table_body")
_WITH_SUPPLEMENTS = {k: ("text", v) for k, v in SUPPLEMENTS.items()}
LABELS = {
    "mineru": {**_WITH_SUPPLEMENTS, **_A},
    "monkeyocr": {**_WITH_SUPPLEMENTS, **_A},
    "PaddleOCR-VL-1.5": {**_WITH_SUPPLEMENTS, **_C},
    "dolphin": _D,
    "glm-ocr": _E,
}


def label_rows() -> list[tuple[str, str, str, str]]:
    return [(vendor, label, *to) for vendor, labels in LABELS.items() for label, to in labels.items()]


def section_level(label: Column) -> Column:
    """The level of the labels sec_1, sec_2 ..; 1 for a catalogue; else null."""
    return F.when(label.rlike(r"^sec_[1-9][0-9]*$"), F.substring(label, 5, 9).try_cast("int")).when(label == "catalogue", F.lit(1))


def map_labels(df: DataFrame, vendor: str, label: str) -> DataFrame:
    """df without skipped labels, plus canonical, sub_type and label_level. vendor and label are column names.

    A label that is null or not listed is text. The table of labels is fixed, below a hundred rows.
    """
    table = df.sparkSession.createDataFrame(label_rows(), f"`{vendor}` string, `{label}` string, canonical string, sub_type string")
    skipped = F.col(vendor).isin("mineru", "monkeyocr") & F.col(label).isin(*SKIPPED)
    joined = df.filter(~F.coalesce(skipped, F.lit(False))).join(F.broadcast(table), [vendor, label], "left")
    level = F.when(F.col(vendor) == "dolphin", section_level(F.col(label)))
    section = level.isNotNull()
    return joined.withColumns({
        "canonical": F.when(section, "title").otherwise(F.coalesce("canonical", F.lit("text"))),
        "sub_type": F.when(section, "title").otherwise(F.coalesce("sub_type", F.lit("text"))),
        "label_level": level,
    })
