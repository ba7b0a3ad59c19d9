"""Queries of the reference operators on the test tables, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions import bbox as B
from leafwright.functions import labels as L
from leafwright.functions import text as X
from leafwright.operators import candidates as C
from leafwright.operators import cases as K
from leafwright.operators import chunking as CH
from leafwright.operators import enrich as E
from leafwright.operators import evaluate as V
from leafwright.operators import links as LK
from leafwright.operators import normalize as N
from leafwright.operators import prompts as P
from leafwright.operators import tables as TB
from leafwright.operators import tree as TR
from leafwright.runtime import latest, table
from leafwright.sources import sinks as SK

#: Chunks of the test documents, which are short.
CHUNK = 8


#: What the stages on text need, and what trees need besides.
TEXT = ("doc_id", "id", "page", "type", "content", "bbox")
LINKS = ("level", "contd", "image", "source_label")
TEXTUAL, TITLE, TABLE = "block_type IN ('text', 'list_item')", "block_type = 'title'", "block_type = 'table'"


def blocks(spark: SparkSession, folder: str, *columns: str, where: str | None = None) -> DataFrame:
    """The block table, each block once, in its latest delivery.

    Only the columns asked for are read. A delivery repeats its fields, so `where` may go before the choice of the
    latest and reaches the scan.
    """
    b = table(spark, folder, "blocks")
    if where:
        b = b.filter(where)
    if columns:
        b = b.select("block_key", "loaded_at", *["block_type" if c == "type" else c for c in columns if c != "block_key"])
    return latest(b, ["block_key"], "loaded_at").withColumnsRenamed({"block_type": "type"})


def _content(c: str = "content"):
    return F.coalesce(c, F.lit(""))


def normalize_text(spark, folder):
    return blocks(spark, folder, "content").select("block_key", X.normalize_text(F.col("content")).alias("content"))


def bbox_scale(spark, folder):
    box = B.to_unit(F.col("bbox"), 1000.0)
    return blocks(spark, folder, "bbox").select("block_key", *[F.round(box[i], 6).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def bbox_thousandths(spark, folder):
    return blocks(spark, folder, "bbox").select("block_key", F.array_join(B.thousandths(B.four(F.col("bbox"))).cast("array<string>"), " ").alias("box"))


def label_map(spark, folder):
    """Source labels under every vendor's table."""
    b = table(spark, folder, "blocks").filter("source_label is not null").select("source_label").distinct()
    vendors = spark.createDataFrame([(v,) for v in L.LABELS], "vendor string")
    return L.map_labels(b.join(F.broadcast(vendors), F.lit(True)), "vendor", "source_label").select("vendor", "source_label", "canonical", "sub_type", "label_level")


def validate_blocks(spark, folder):
    return N.invalid_blocks(blocks(spark, folder, "type", "bbox"))


def block_order(spark, folder):
    return N.numbered(blocks(spark, folder, "doc_id", "page", "block_order", "bbox")).select("block_key", F.col("number").cast("bigint").alias("number"))


def sentence_head_tail(spark, folder):
    b = blocks(spark, folder, "content", where=TEXTUAL)
    return b.select("block_key", X.sentence_head(_content()).alias("head"), X.sentence_tail(_content()).alias("tail"), X.shortened(_content()).alias("short"))


def merge_rule_flags(spark, folder):
    b = blocks(spark, folder, "content", where=TEXTUAL)
    return b.select("block_key", X.is_list_item(_content()).alias("list_item"), X.may_be_cut_off(_content()).alias("cut_off"), X.may_go_on(_content()).alias("goes_on"), X.starts_with_digit(_content()).alias("digit"))


def truncation_candidates(spark, folder):
    return C.truncation_pairs(blocks(spark, folder, "doc_id", "id", "type", "content"))


def truncation_rows(spark, folder):
    return C.truncation_rows(blocks(spark, folder, *TEXT)).select("doc_id", "ord", "idx", "page", F.array_join(F.col("box").cast("array<string>"), " ").alias("box"), "content")


def title_candidates(spark, folder):
    return C.title_rows(blocks(spark, folder, *TEXT, where=TITLE)).select("doc_id", "idx", "page", "content")


def visual_candidates(spark, folder):
    return C.visual_rows(blocks(spark, folder, *TEXT)).select("doc_id", "idx", "type", "page", "content")


def containment_links(spark, folder):
    """With tables as the large blocks, which the test data has."""
    return C.containment_links(blocks(spark, folder, "doc_id", "id", "type", "bbox"), ("table", "image_block"), ("image_caption", "table_caption", "image"))


def table_pairs(spark, folder):
    return C.table_pairs(blocks(spark, folder, "doc_id", "id", "page", "type", where=TABLE))


def table_screen(spark, folder):
    return C.screened_pairs(blocks(spark, folder, *TEXT)).select("doc_id", "upper_idx", "lower_idx", F.coalesce("reason", F.lit("passed")).alias("reason"))


def _checks(spark, folder):
    return C.pair_checks(blocks(spark, folder, *TEXT))


def table_screen_text_between(spark, folder):
    return _checks(spark, folder).select("doc_id", "upper_idx", "lower_idx", "text_after", "text_before")


def table_screen_caption(spark, folder):
    return _checks(spark, folder).select("doc_id", "upper_idx", "lower_idx", "cap1", "cap2", "number1", "number2")


def table_screen_footnotes(spark, folder):
    return _checks(spark, folder).select("doc_id", "upper_idx", "lower_idx", F.col("notes").cast("bigint").alias("notes"))


def table_screen_width(spark, folder):
    return _checks(spark, folder).select("doc_id", "upper_idx", "lower_idx", F.round("width1", 6).alias("width1"), F.round("width2", 6).alias("width2"))


def chunk_ranges(spark, folder):
    return CH.chunk_ranges(C.title_rows(blocks(spark, folder, *TEXT, where=TITLE)), CHUNK)


def chunk_items(spark, folder):
    rows = C.title_rows(blocks(spark, folder, *TEXT, where=TITLE))
    return CH.chunk_items(rows, CH.chunk_ranges(rows, CHUNK)).select("doc_id", "chunk_no", "idx", "page")


def _requests(spark, folder, task):
    b = blocks(spark, folder, *TEXT, where=TITLE if task == "title" else None)
    rows = {"title": C.title_rows, "contd": C.truncation_rows, "image": C.visual_rows}[task](b)
    return P.prompts(CH.chunk_items(rows, CH.chunk_ranges(rows, CHUNK)), task)


def prompt_text(spark, folder):
    rows = C.title_rows(blocks(spark, folder, *TEXT, where=TITLE))
    return P.prompts(rows.withColumn("chunk_no", F.lit(0)), "title").select("doc_id", "prompt")


def _answers(spark, folder, task):
    return P.answered(_requests(spark, folder, task), P.RuleModel)


def parse_links(spark, folder):
    return P.parsed_links(_answers(spark, folder, "contd")).select("doc_id", "chunk_no", "src", "tgt")


def parse_levels(spark, folder):
    return P.parsed_levels(_answers(spark, folder, "title")).select("doc_id", "chunk_no", "idx", "level")


def level_sync(spark, folder):
    return LK.synced_levels(P.parsed_levels(_answers(spark, folder, "title")))


def apply_links(spark, folder):
    contd = LK.distinct_links(P.parsed_links(_answers(spark, folder, "contd")))
    images = LK.distinct_links(P.parsed_links(_answers(spark, folder, "image")))
    out = LK.linked_blocks(blocks(spark, folder, "doc_id", "id"), contd, level_sync(spark, folder), images)
    return out.select("block_key", "contd", "level", "image")


def table_cells(spark, folder):
    t = blocks(spark, folder, "doc_id", "id", "content", where=TABLE)
    return TB.table_cells(t).select("doc_id", "id", "row", "cell", "col", "text")


def table_shapes(spark, folder):
    t = blocks(spark, folder, "doc_id", "id", "content", where=TABLE)
    return TB.table_shapes(TB.table_cells(t)).select("doc_id", "id", F.col("n_rows").cast("bigint").alias("n_rows"), "n_cells", F.col("n_cols").cast("bigint").alias("n_cols"))


def _table_ids(spark, folder):
    return C.table_pairs(blocks(spark, folder, "doc_id", "id", "page", "type", where=TABLE)).select("doc_id", (F.col("upper_idx") + 1).alias("upper_id"), (F.col("lower_idx") + 1).alias("lower_id"))


def table_header_rows(spark, folder):
    t = blocks(spark, folder, "doc_id", "id", "content", where=TABLE)
    return TB.header_rows(_table_ids(spark, folder), TB.table_cells(t))


def table_visual_header_rows(spark, folder):
    t = blocks(spark, folder, "doc_id", "id", "content", where=TABLE)
    return TB.visual_header_rows(_table_ids(spark, folder), TB.table_cells(t))


def chunk_pages(spark, folder):
    rows = C.title_rows(blocks(spark, folder, *TEXT, where=TITLE))
    return CH.chunk_pages(CH.chunk_items(rows, CH.chunk_ranges(rows, CHUNK))).select("doc_id", "chunk_no", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"))


def input_labels(spark, folder):
    """Documents with the labels that some rows give."""
    d = table(spark, folder, "documents")
    return N.input_labels(d.select("doc_id"), d.filter("input_label <> ''").select("doc_id", F.col("input_label").alias("label")))


def table_merge(spark, folder):
    """All tables on consecutive pages are taken as pairs, so that chains occur."""
    b = blocks(spark, folder, *TEXT, where=TABLE)
    pairs = C.table_pairs(b).withColumn("cells", F.array(F.lit(0)))
    return TB.merged_tables(LK.merged_pairs(b, pairs)).select("doc_id", "head_id", "content", F.array_join(F.col("member_ids").cast("array<string>"), ",").alias("members"))


def text_components(spark, folder):
    return TR.text_components(blocks(spark, folder, *TEXT, *LINKS)).select("doc_id", "comp_id", "title", "content", "level", F.array_join(F.col("block_ids").cast("array<string>"), ",").alias("block_ids"))


def tree_parents(spark, folder):
    return TR.parents(TR.component_levels(blocks(spark, folder, "doc_id", "id", "type", "content", *LINKS))).select("doc_id", "comp_id", "parent_id")


def tree_locations(spark, folder):
    """Places of all text components, a row per block."""
    c = TR.text_components(blocks(spark, folder, *TEXT, *LINKS)).select("doc_id", "comp_id", F.posexplode(F.arrays_zip("block_ids", "locations")).alias("pos", "x"))
    return c.select("doc_id", "comp_id", "pos", F.col("x.block_ids").alias("id"), F.col("x.locations.page").alias("page"), F.round(F.get("x.locations.bbox", 0), 6).alias("x1"), F.round(F.get("x.locations.bbox", 3), 6).alias("y2"))


def tree_visuals(spark, folder):
    return TR.visual_components(blocks(spark, folder, *TEXT, *LINKS)).select("doc_id", "vis_id", "type", "title", "metadata", "link", F.array_join(F.col("block_ids").cast("array<string>"), ",").alias("block_ids"))


def tree_attached(spark, folder):
    b = blocks(spark, folder, *TEXT, *LINKS)
    return TR.attached_visuals(b, TR.text_components(b), TR.visual_components(b))


def tree_supplements(spark, folder):
    return TR.supplements(blocks(spark, folder, *TEXT, "level", "source_label")).select("doc_id", "id", "type", "title", "content")


def tree_preview(spark, folder):
    return TR.preview(TR.tree(blocks(spark, folder, *TEXT, *LINKS)))


def tree_json(spark, folder):
    return SK.tree_json(TR.tree(blocks(spark, folder, *TEXT, *LINKS)))


def relations(spark, folder):
    return K.relations(blocks(spark, folder, "doc_id", "id", "type", "contd", "image", "level"))


def relation_records(spark, folder):
    return K.relation_records(relations(spark, folder))


def subnode_split(spark, folder):
    n = latest(table(spark, folder, "sub_com_trees"), ["node_key"], "loaded_at").withColumnRenamed("node_type", "type").withColumns({"title": F.coalesce("title", F.lit(TR.DEFAULT_TITLE)), "content": _content()})
    return E.subnodes(n, ("node_key",)).select("node_key", "sub_no", "content", F.array_join(F.col("block_ids").cast("array<string>"), ",").alias("block_ids"))


def title_linking(spark, folder):
    return LK.title_links(blocks(spark, folder, "doc_id", "id", "type", "level")).select("doc_id", F.col("idx").cast("bigint").alias("idx"), F.col("to_idx").cast("bigint").alias("to_idx"))


def level_marks(spark, folder):
    return K.level_marks(blocks(spark, folder, "doc_id", "id", "type", "content", "level")).select("doc_id", "id", "type", "marked")


def training_cases(spark, folder):
    b = blocks(spark, folder, *TEXT, "level", where=TITLE)
    labels = b.filter("level >= 0").select("doc_id", (F.col("id") - 1).alias("idx"), "level")
    return K.cases(C.title_rows(b), labels, "title").select("doc_id", "case")


def _truth(spark, folder):
    """Truth made from the blocks: titles asked for as a request, boxes and levels moved a little."""
    b = blocks(spark, folder, *TEXT, "level", where=TITLE).withColumn("bbox", F.transform(B.to_unit(F.col("bbox"), 1000.0), lambda v: v * F.lit(0.98)))
    asked = P.prompts(C.title_rows(b, 200).withColumn("chunk_no", F.lit(0)), "title").select("doc_id", "prompt")
    line = F.concat(F.lit("<|id|>"), F.col("id") - 1, F.lit("<|level|>"), F.greatest(F.coalesce("level", F.lit(1)), F.lit(1)) + F.when(F.col("id") % 5 == 0, 1).otherwise(0))
    answers = b.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))).alias("x")).select("doc_id", F.array_join(F.transform("x", lambda v: v["line"]), "\n").alias("label"))
    return asked.join(answers, "doc_id")


def gt_parse(spark, folder):
    return V.truth_titles(_truth(spark, folder)).select("doc_id", "gt_id", "page", F.array_join(F.transform("bbox", lambda v: F.round(v, 1).cast("string")), " ").alias("box"), "content")


def _aligned(spark, folder):
    truth = V.truth_titles(_truth(spark, folder))
    mine = blocks(spark, folder, *TEXT, "block_id", "title_level", where=TITLE).withColumn("bbox", F.transform(B.to_unit(F.col("bbox"), 1000.0), lambda v: v * 1000.0))
    return truth, mine, V.alignment(truth, mine)


def box_iou(spark, folder):
    truth, mine, _ = _aligned(spark, folder)
    p = truth.select("doc_id", "page", "gt_id", F.col("bbox").alias("a")).join(mine.select("doc_id", "page", "block_id", F.col("bbox").alias("b")), ["doc_id", "page"])
    return p.select("doc_id", "gt_id", "block_id", F.round(B.iou(F.col("a"), F.col("b")), 6).alias("iou"), F.round(B.overlap_smaller(F.col("a"), F.col("b")), 6).alias("smaller"))


def align_score(spark, folder):
    return _aligned(spark, folder)[2].select("doc_id", "gt_id", "block_id", F.round("score", 6).alias("score"))


def align_match(spark, folder):
    return V.matched(_aligned(spark, folder)[2])


def teds(spark, folder):
    truth, mine, pairs = _aligned(spark, folder)
    predicted = V.predicted_titles(V.matched(pairs), mine)
    levels = V.truth_levels(_truth(spark, folder))
    return V.tree_scores(V.labelled(levels, truth, "content_aware"), V.labelled(predicted, truth, "content_aware"))


def eval_summary(spark, folder):
    """Means over the documents' statuses, with the share of blocks as a stand-in for the score."""
    status = N.latest_status(table(spark, folder, "doc_status"))
    scores = status.groupBy("doc_id").agg((F.max(F.coalesce("n_blocks", F.lit(0))) / 1000.0).alias("score"))
    return V.summary(scores, status)


def doc_status(spark, folder):
    return N.latest_status(table(spark, folder, "doc_status"))


def resume_anti_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return N.not_done(docs, N.latest_status(table(spark, folder, "doc_status")).filter("status = 'ok'"), ["doc_id"])


def doc_ids(spark, folder):
    return N.doc_ids(table(spark, folder, "documents").select("doc_id"), table(spark, folder, "blocks").select("doc_id"), table(spark, folder, "trees").select("doc_id"))


def interchange_pages(spark, folder):
    b = N.numbered(blocks(spark, folder, *TEXT, "block_order", "block_id", "title_level", "source_label"))
    return N.interchange(b)


_QUERIES = (
    normalize_text, bbox_scale, bbox_thousandths, label_map, validate_blocks, block_order, sentence_head_tail, merge_rule_flags, truncation_candidates, truncation_rows, title_candidates, visual_candidates, containment_links, table_pairs, table_screen, table_screen_text_between, table_screen_caption, table_screen_footnotes, table_screen_width,
    chunk_ranges, chunk_items, chunk_pages, prompt_text, parse_links, parse_levels, level_sync, apply_links, table_cells, table_shapes, table_header_rows, table_visual_header_rows, table_merge, text_components, tree_locations, tree_parents, tree_visuals, tree_attached, tree_supplements, tree_preview, tree_json, relations, relation_records, subnode_split,
    title_linking, level_marks, training_cases, gt_parse, box_iou, align_score, align_match, teds, eval_summary, doc_status, resume_anti_join, doc_ids, input_labels, interchange_pages,
)


def queries():
    return {f.__name__: f for f in _QUERIES}
