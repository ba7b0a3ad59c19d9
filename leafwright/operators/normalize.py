"""Normalized blocks: cleaning, order and numbering, validation, status of documents, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from leafwright.functions import bbox as B
from leafwright.functions import text as X

#: Sub-types that the later stages take.
ALLOWED = ("title", "text", "list_item", "equation", "image", "table", "image_caption", "table_caption", "image_footnote", "table_footnote", "header", "footer", "page_number", "page_footnote", "aside_text", "page_title")


def content_pick(*candidates: Column) -> Column:
    """The first that is neither null nor empty, normalized."""
    return X.normalize_text(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates]))


def normalized(blocks: DataFrame, canonical: str = "canonical", scale: float | None = 1000.0) -> DataFrame:
    """blocks with clean text and unit boxes; titles, texts and captions without text are dropped, images and tables stay."""
    out = blocks.withColumns({"content": X.normalize_text(F.col("content")), "bbox": B.to_unit(F.col("bbox"), scale)})
    return out.filter(~F.col(canonical).isin("title", "text", "caption") | (F.col("content") != ""))


def numbered(blocks: DataFrame, order: str = "block_order") -> DataFrame:
    """blocks with number: 1-based position by page, order (missing last), y, x, key.

    The number is the count of blocks on earlier pages plus the place on the page, so no task sorts a document.
    """
    box = B.four(F.col("bbox"))
    on_page = Window.partitionBy("doc_id", "page").orderBy(F.coalesce(F.col(order).try_cast("int"), F.lit(2147483647)), box[1], box[0], "block_key")
    pages = blocks.groupBy("doc_id", "page").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = pages.select("doc_id", "page", before.alias("before"))
    return blocks.withColumn("place", F.row_number().over(on_page)).join(start, ["doc_id", "page"]).withColumn("number", F.col("before") + F.col("place")).drop("before", "place")


def invalid_blocks(blocks: DataFrame) -> DataFrame:
    """block_key, reason of blocks that the later stages refuse: type, or what is wrong with the box."""
    reason = F.when(~F.coalesce(F.col("type").isin(*ALLOWED), F.lit(False)), "type").otherwise(B.violations(F.col("bbox")))
    return blocks.select("block_key", reason.alias("reason")).filter("reason is not null")


def checked(blocks: DataFrame) -> DataFrame:
    """blocks as they are; the job fails at the first invalid one."""
    reason = F.when(~F.coalesce(F.col("type").isin(*ALLOWED), F.lit(False)), "type").otherwise(B.violations(F.col("bbox")))
    return blocks.filter(F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("invalid block: "), reason)).cast("boolean")).otherwise(True))


def interchange(blocks: DataFrame) -> DataFrame:
    """doc_id, pages: JSON object of page number to blocks in order; the form that the stages exchange. A row per page is grouped first."""
    block = F.struct("number", F.col("type"), "content", "bbox", "title_level", "source_label", F.col("block_id").alias("source_id"))
    page = blocks.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(block)), lambda x: x.dropFields("number")).alias("blocks"))
    return page.groupBy("doc_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("page").cast("string"), "blocks"))))).alias("pages"))


def latest_status(status: DataFrame) -> DataFrame:
    """doc_id, model, status, message, n_blocks of the last check of each document and model."""
    cols = [c for c in ("status", "message", "n_blocks") if c in status.columns]
    last = F.max(F.struct("checked_at", *cols)).alias("s")
    return status.groupBy("doc_id", "model").agg(last).select("doc_id", "model", *[F.col(f"s.{c}").alias(c) for c in cols])


def not_done(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose keys have no result yet, for resuming."""
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def doc_ids(*sources: DataFrame, limit: int = 0) -> DataFrame:
    """Distinct document ids of all sources; the first `limit` of them in order if it is above 0."""
    out = sources[0].select(F.col(sources[0].columns[0]).alias("doc_id"))
    for s in sources[1:]:
        out = out.unionByName(s.select(F.col(s.columns[0]).alias("doc_id")))
    out = out.distinct()
    return out.orderBy("doc_id").limit(limit) if limit > 0 else out


def input_labels(docs: DataFrame, given: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """doc_id, label: a given label, else an existing file's name, else the id."""
    out = docs.join(given.select("doc_id", F.col("label").alias("__given")), "doc_id", "left")
    found = F.lit(None).cast("string")
    if existing is not None:
        out = out.join(existing.select("doc_id", F.col("path").alias("__found")), "doc_id", "left")
        found = F.col("__found")
    return out.select("doc_id", F.coalesce("__given", found, F.col("doc_id").cast("string")).alias("label"))
