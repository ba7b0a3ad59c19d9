"""Records of blocks and trees that the text operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.operators.nested import tree_nodes

#: Block types and node types whose content is a text record, and block types that are titles or captions.
TEXT_BLOCKS, TEXT_NODES = ("text", "list_item"), ("text", "sub_text")
TITLE_BLOCKS = ("title", "table_caption", "image_caption", "page_footnote")


def block_key() -> Column:
    return F.concat(F.lit("b:"), F.col("block_key"))


def node_key() -> Column:
    return F.concat(F.lit("t:"), F.col("tree_key"), F.lit(":"), F.col("node_no"))


def title_records(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """doc_id, rec_key, text: titles, captions and footnotes among the blocks, and titles of tree nodes."""
    b = blocks.filter(F.col("block_type").isin(*TITLE_BLOCKS)).select("doc_id", block_key().alias("rec_key"), F.col("content").alias("text"))
    t = tree_nodes(trees, ["node_no", "title"], ["tree_key", "doc_id"], titled=True).select("doc_id", node_key().alias("rec_key"), F.col("title").alias("text"))
    return b.unionByName(t)


def text_records(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """doc_id, rec_key, text of text blocks, list items and text nodes; records without a text or key are left out."""
    b = blocks.filter(F.col("block_type").isin(*TEXT_BLOCKS)).select("doc_id", block_key().alias("rec_key"), F.col("content").alias("text"))
    t = tree_nodes(trees, ["node_no", "content"], ["tree_key", "doc_id"], only_types=TEXT_NODES).select("doc_id", node_key().alias("rec_key"), F.col("content").alias("text"))
    return b.unionByName(t).filter("text <> '' and rec_key is not null")
