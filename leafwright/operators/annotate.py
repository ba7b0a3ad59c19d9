"""All model stages in one: requests, answers, links, levels and table merges onto normalized blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.operators import candidates as C
from leafwright.operators import chunking as CH
from leafwright.operators import links as L
from leafwright.operators import prompts as P
from leafwright.operators import tables as TB
from leafwright.runtime import written


def answers(blocks: DataFrame, task: str, make_client, size: int = 50) -> DataFrame:
    """Requests of a task (contd, title, image) by chunks, with the model's answers; written, as a model may answer differently twice."""
    rows = {"contd": C.truncation_rows, "title": C.title_rows, "image": C.visual_rows}[task](blocks)
    return written(P.answered(P.prompts(CH.chunk_items(rows, CH.chunk_ranges(rows, size)), task), make_client), f"answers_{task}")


def table_answers(blocks: DataFrame, make_client) -> DataFrame:
    """doc_id, upper_idx, lower_idx, cells of table pairs that passed the screen; no list in an answer gives null."""
    asked = TB.merge_prompts(C.screened_pairs(blocks).filter("reason is null").drop("reason"), blocks)
    said = written(P.answered(asked, make_client), "answers_table")
    return said.select("doc_id", "upper_idx", "lower_idx", P.last_flags(F.col("response")).alias("cells"))


def annotated(blocks: DataFrame, make_client, size: int = 50) -> DataFrame:
    """blocks (doc_id, id, page, type, content, bbox, ..) with contd, level, image, table_merge and cell_list; -1 is no link."""
    contd = L.distinct_links(P.parsed_links(answers(blocks, "contd", make_client, size)))
    images = L.distinct_links(P.parsed_links(answers(blocks, "image", make_client, size)))
    levels = L.synced_levels(P.parsed_levels(answers(blocks, "title", make_client, size)))
    out = L.linked_blocks(blocks, contd, levels, images, C.containment_links(blocks))
    return L.merged_pairs(out, table_answers(blocks, make_client))
