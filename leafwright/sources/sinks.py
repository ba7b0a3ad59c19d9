"""Writers of the stages' results, and reading them again."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators import normalize as N

FORMATS = ("pages", "blocks", "titles", "interchange")


def document_json(blocks: DataFrame, form: str = "interchange") -> DataFrame:
    """doc_id, value: one JSON object per document in one of FORMATS; blocks are numbered."""
    if form not in FORMATS:
        raise ValueError(f"unknown format {form}")
    if form == "titles":
        blocks = blocks.filter("type = 'title'")
    if form in ("pages", "interchange"):
        out = N.interchange(blocks)
        value = F.col("pages") if form == "pages" else F.concat(F.lit('{"doc_id":'), F.concat(F.lit('"'), F.col("doc_id"), F.lit('"')), F.lit(',"pages":'), F.col("pages"), F.lit("}"))
        return out.select("doc_id", value.alias("value"))
    row = F.struct("number", "block_id", "page", "type", "content", "bbox", "title_level")
    g = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("blocks"))
    return g.select("doc_id", F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "blocks")).alias("value"))


def write_documents(documents: DataFrame, folder: str) -> None:
    """A line of JSON per document, in files by the model's layout of the cluster."""
    documents.select("value").write.mode("overwrite").text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, page, pos, type, content, bbox, title_level, source_label, source_id from interchange files."""
    block = "struct<type string, content string, bbox array<double>, title_level int, source_label string, source_id string>"
    d = spark.read.schema(f"doc_id string, pages map<string, array<{block}>>").json(folder)
    pages = d.select("doc_id", F.explode("pages").alias("page", "blocks"))
    return pages.select("doc_id", F.col("page").cast("int").alias("page"), F.posexplode("blocks").alias("pos", "b")).select("doc_id", "page", "pos", "b.*")


def annotated_json(blocks: DataFrame) -> DataFrame:
    """doc_id, value: one JSON object per document, page number to annotated blocks in order, with links, level and merges."""
    extra = [c for c in ("table_merge", "cell_list") if c in blocks.columns]
    block = F.struct("id", "type", "content", "bbox", "page", "contd", "level", "image", *extra)
    page = blocks.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    pages = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("page").cast("string"), F.lit("")), "blocks"))))
    return page.groupBy("doc_id").agg(F.to_json(pages).alias("value"))


def write_evaluation(details: DataFrame, summary: DataFrame, folder: str) -> None:
    """Scores per document and their means, as lines of JSON in <folder>/details and <folder>/summary."""
    details.write.mode("overwrite").json(f"{folder}/details")
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")


def write_cases(cases: DataFrame, folder: str) -> None:
    """Training cases or relation records (one JSON column each), a line per row."""
    column = "case" if "case" in cases.columns else "record"
    cases.select(F.col(column).alias("value")).write.mode("overwrite").text(folder)


def append_log(answers: DataFrame, folder: str) -> None:
    """Adds requests and answers to the log of model calls."""
    answers.write.mode("append").parquet(folder)


def tree_json(nodes: DataFrame) -> DataFrame:
    """doc_id, value: the nested tree of each document's nodes (node, parent, path, type, title, metadata, content, level, block_ids, locations).

    A document's tree is one JSON object, so its nodes meet in one row.
    """
    row = F.struct("path", "node", "parent", "type", "title", "metadata", "content", "level", F.col("locations").alias("location"), "block_ids")
    docs = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("nodes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rows in b.column("nodes").to_pylist():
                root = {"type": "root", "title": "", "metadata": "", "content": "", "level": -1, "location": [], "block_ids": [], "children": []}
                by = {"root": root}
                for r in rows:  # parents come first in path order
                    by[r["node"]] = {k: r[k] for k in ("type", "title", "metadata", "content", "level", "location", "block_ids")} | {"children": []}
                    by[r["parent"]]["children"].append(by[r["node"]])
                out.append(json.dumps(root, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "value"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, value string")


def read_normalized(spark: SparkSession, root: str, model: str) -> DataFrame:
    """doc_id, page, pos, type, content, bbox, title_level, source_label, source_id of a model's normalized files.

    Places in this order, for each document the first that it has: <root>/<document>/<file>.json,
    <root>/<model>/<document>.json, and lines or a list of documents in <root>/<model>.json.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    top = root.rstrip("/").rpartition("/")[2]
    rest = raw.select("content", F.regexp_replace("path", f"^.*?(?<=/){top}/", "").alias("rest"))
    folder, file = F.regexp_extract("rest", "^(?:(.*)/)?[^/]*$", 1), F.regexp_extract("rest", r"([^/]*)\.json$", 1)
    kind = F.when(folder == model, 1).when((folder == "") & (file == model), 2).when(folder != "", 0)
    files = rest.select("content", kind.alias("kind"), F.when(folder == model, file).otherwise(F.regexp_extract("rest", "^([^/]+)/", 1)).alias("name")).filter("kind is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, kinds, pages, pos, blocks = [], [], [], [], []
            for kind_, name, content in zip(*(b.column(c).to_pylist() for c in ("kind", "name", "content")), strict=True):
                text = content.decode("utf-8", "replace")
                try:
                    found = json.loads(text)
                except ValueError:
                    found = [json.loads(x) for x in text.splitlines() if x.strip()[:1] == "{" and x.strip()[-1:] == "}"]
                for doc in found if isinstance(found, list) else [found]:
                    if not isinstance(doc, dict):
                        continue
                    inside = doc.get("pages", doc)
                    for page, items in (inside.items() if isinstance(inside, dict) else ()):
                        for i, x in enumerate(items if isinstance(items, list) and str(page).isdigit() else ()):
                            docs.append(str(doc.get("doc_id") or name))
                            kinds.append(kind_)
                            pages.append(int(page))
                            pos.append(i)
                            blocks.append(json.dumps(x, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array(kinds, pa.int32()), pa.array(pages, pa.int32()), pa.array(pos, pa.int32()), pa.array(blocks, pa.string())], ["doc_id", "kind", "page", "pos", "block"])

    rows = files.mapInArrow(run, "doc_id string, kind int, page int, pos int, block string")
    best = rows.groupBy("doc_id").agg(F.min("kind").alias("kind"))
    b = F.from_json("block", "type string, content string, bbox array<double>, title_level int, source_label string, source_id string")
    return rows.join(best, ["doc_id", "kind"]).select("doc_id", "page", "pos", b.alias("b")).select("doc_id", "page", "pos", "b.*")
