"""Readers of five OCR vendors' output folders: <root>/<document>/... to one block table and one status table."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.functions import bbox as B
from leafwright.functions import labels as L
from leafwright.functions import text as X

#: Files of each vendor below a document's folder, the preferred first; {doc} is the document, {n} a number.
FILES = {
    "mineru": (r"vlm/{doc}_model\.json", r"vlm/{doc}_middle\.json", r"vlm/{doc}_content_list\.json"),
    "monkeyocr": (r"{doc}_middle\.json",),
    "PaddleOCR-VL-1.5": (r"layout_parsing\.json", r"{doc}_\d+_res\.json"),
    "dolphin": (r"recognition_json/{doc}\.json",),
    "glm-ocr": (r"{doc}_model\.json", r"glm_ocr\.json", r"page_.*\.json"),
}
Item = dict


def _first(item: dict, *names: str) -> object:
    return next((item[n] for n in names if item.get(n)), None)


def _words(item: dict) -> str:
    """The text of an item: its own, else its lines' spans joined."""
    own = _first(item, "content", "text", "html", "words")
    if own:
        return own if isinstance(own, str) else json.dumps(own, ensure_ascii=False)
    spans = [s.get("content") or s.get("text") or "" for line in item.get("lines") or [] if isinstance(line, dict) for s in line.get("spans") or [] if isinstance(s, dict)]
    return " ".join(s for s in spans if s)


def pages_of(data: object) -> Iterator[tuple[int, list[Item], dict]]:
    """Page number, items and the page itself, of lists of lists, lists of pages, and objects with pages."""
    if isinstance(data, dict):
        inside = data.get("pages") or data.get("pdf_info")
        if isinstance(inside, list):
            yield from pages_of(inside)
        return
    for at, page in enumerate(data if isinstance(data, list) else [], start=1):
        if isinstance(page, list):
            yield at, [x for x in page if isinstance(x, dict)], {}
        elif isinstance(page, dict):
            items = _first(page, "blocks", "items", "elements", "para_blocks")
            if isinstance(items, list):
                number = page["page"] if page.get("page") is not None else page["page_idx"] + 1 if page.get("page_idx") is not None else at
                yield int(number), [x for x in items if isinstance(x, dict)], page
            else:
                yield at, [page], {}


def _row(page: int, label: object, text: str, box: object, scale: float | None = None, size: object = (None, None), order: object = None, level: object = None) -> Item:
    return {"page": page, "label": str(label if label is not None else "text"), "content": text, "bbox": box, "scale": scale, "size": size, "order": order, "level": level}


def _size(page: dict) -> tuple:
    inner = page.get("response") if isinstance(page.get("response"), dict) else {}
    for holder in (page, inner):
        for w, h in (("width", "height"), ("image_width", "image_height"), ("page_width", "page_height")):
            if holder.get(w) and holder.get(h):
                return float(holder[w]), float(holder[h])
    return None, None


def _model(data: object, label: str = "type", box: tuple[str, ...] = ("bbox",)) -> Iterator[Item]:
    for page, items, _ in pages_of(data):
        for x in items:
            yield _row(page, x.get(label, "text"), _words(x), _first(x, *box), 1000.0)


def _middle(data: object) -> Iterator[Item]:
    for at, page in enumerate((data.get("pdf_info") if isinstance(data, dict) else data) or [], start=1):
        number = int(page["page_idx"]) + 1 if page.get("page_idx") is not None else at
        for x in page.get("para_blocks") or []:
            yield _row(number, x.get("type", "text"), _words(x), x.get("bbox"), None, tuple(page.get("page_size") or (None, None))[:2])


def _content_list(data: object) -> Iterator[Item]:
    for x in data if isinstance(data, list) else []:
        if isinstance(x, dict) and x.get("bbox"):
            level = x.get("text_level")
            yield _row(int(x.get("page_idx") or 0) + 1, "title" if level else x.get("type", "text"), _words(x), x["bbox"], 1000.0, level=level)


def _layout(data: object) -> Iterator[Item]:
    for at, page in enumerate(data.get("result", {}).get("layoutParsingResults") or [], start=1):
        inner = page.get("prunedResult") or {}
        for x in inner.get("parsing_res_list") or []:
            yield _row(at, x.get("block_label", "text"), x.get("block_content") or "", x.get("block_bbox"), None, (inner.get("width"), inner.get("height")), x.get("block_order"))


def _page_result(data: object) -> Iterator[Item]:
    for x in data.get("parsing_res_list") or []:
        yield _row(int(data["page_index"]) + 1 if data.get("page_index") is not None else 0, x.get("block_label", "text"), x.get("block_content") or "", x.get("block_bbox"), None, _size(data), x.get("block_order"))


def _recognition(data: object) -> Iterator[Item]:
    for at, page in enumerate(data.get("pages") or [], start=1):
        number = page.get("page_number")
        for x in page.get("elements") or []:
            yield _row(int(number) if isinstance(number, int) and number > 0 else at, x.get("label", "text"), x.get("text") or "", x.get("bbox"), None, _size(page), x.get("reading_order"))


def _recognized_words(page: dict, number: int) -> Iterator[Item]:
    inner = page.get("response") if isinstance(page.get("response"), dict) else page
    for x in inner.get("words_result") or []:
        at = x.get("location") or {}
        left, top = float(at.get("left", 0)), float(at.get("top", 0))
        if (x.get("words") or "").strip():
            yield _row(number, "words_result", x["words"], [left, top, left + float(at.get("width", 0)), top + float(at.get("height", 0))], None, _size(page))


def _merged_pages(data: object) -> Iterator[Item]:
    for at, page in enumerate(data.get("pages") or [], start=1):
        yield from _recognized_words(page, at)


#: A function per vendor and file kind; page 0 stands for the file's own number.
PARSERS: dict[str, tuple[Callable[[object], Iterator[Item]], ...]] = {
    "mineru": (_model, _middle, _content_list),
    "monkeyocr": (_middle,),
    "PaddleOCR-VL-1.5": (_layout, _page_result),
    "dolphin": (_recognition,),
    "glm-ocr": (lambda d: _model(d, "label", ("bbox_2d", "bbox")), _merged_pages, lambda d: _recognized_words(d, 0)),
}
#: Fixed value: how much larger than the page the pictures are that per-page results refer to.
RENDER_SCALE = 2.0
_OUT = "doc_id string, page int, pos int, label string, content string, bbox array<double>, scale double, width double, height double, block_order string, title_level int, problem string"


def _numbers(box: object) -> list[float] | None:
    if not isinstance(box, (list, tuple)) or not all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in box):
        return None
    return [float(v) for v in box]


def register_reader(vendor: str, files: tuple[str, ...], parsers: tuple[Callable[[object], Iterator[Item]], ...], labels: dict[str, tuple[str, str]]) -> None:
    """Adds a vendor: patterns of its files, a parser for each, and its labels."""
    FILES[vendor], PARSERS[vendor], L.LABELS[vendor] = files, parsers, labels


def _chosen(spark: SparkSession, root: str, vendor: str) -> DataFrame:
    """doc_id, kind, file_no, content of the preferred files of each document; numbered files in numeric order."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    base = F.regexp_replace(F.col("path"), r"^.*?" + f"(?<=/){root.rstrip('/').rpartition('/')[2]}/", "")
    f = raw.select("content", base.alias("rest")).withColumns({"doc_id": F.regexp_extract("rest", "^([^/]+)/", 1), "name": F.regexp_replace("rest", "^[^/]+/", "")})
    kind = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(FILES[vendor]))):
        before, doc, after = f"^{pattern}$".partition("{doc}")
        full = F.concat(F.lit(before + r"\Q"), "doc_id", F.lit(r"\E" + after)) if doc else F.lit(before)
        kind = F.when(F.regexp_like("name", full), i).otherwise(kind)
    f = f.withColumn("kind", kind).filter("kind is not null")
    best = f.groupBy("doc_id").agg(F.min("kind").alias("kind"))
    number = F.coalesce(F.regexp_extract("name", r"_(\d+)(?:_res)?\.json$", 1).try_cast("int"), F.lit(1_000_000_000))
    file_no = F.row_number().over(Window.partitionBy("doc_id").orderBy(number, "name"))
    return f.join(best, ["doc_id", "kind"]).withColumn("file_no", file_no).select("doc_id", "kind", "file_no", "content")


def read_vendor(spark: SparkSession, root: str, vendor: str, ids: DataFrame | None = None, page_sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """blocks (doc_id, model, block_id, page, number, type, sub_type, content, bbox, title_level, source_label) and
    status (doc_id, model, status, message, n_blocks) of a vendor's folder.

    ids: documents that are expected; those without files are missing. page_sizes: doc_id, page, width, height for
    results on rendered pages. A file that is no JSON of the vendor's form makes its document invalid, not the job fail.
    Titles, texts and captions without text are dropped; skipped labels as well.
    """
    if vendor not in FILES:
        raise ValueError(f"unknown vendor {vendor}")
    parsers = PARSERS[vendor]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.int32(), pa.string())
        names = [x.split()[0] for x in _OUT.split(", ")]
        for b in batches:
            rows: list[tuple] = []
            for doc, kind, no, content in zip(*(b.column(c).to_pylist() for c in ("doc_id", "kind", "file_no", "content")), strict=True):
                try:
                    found = []
                    for pos, x in enumerate(parsers[kind](json.loads(content))):
                        w, h = x["size"]
                        level = x["level"]
                        found.append((doc, x["page"] or no, pos, x["label"], x["content"], _numbers(x["bbox"]), x["scale"], None if w is None else float(w), None if h is None else float(h), None if x["order"] is None else str(x["order"]), level if isinstance(level, int) else None, None))
                    rows += found or [(doc, *[None] * 10, "")]
                except (ValueError, TypeError, KeyError, AttributeError) as e:
                    rows.append((doc, *[None] * 10, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    raw = _chosen(spark, root, vendor).mapInArrow(run, T._parse_datatype_string(_OUT))
    bad = raw.filter("problem <> ''").groupBy("doc_id").agg(F.min("problem").alias("message"))
    items = raw.filter("problem is null").join(bad.select("doc_id"), "doc_id", "left_anti")
    if page_sizes is not None:
        sizes = page_sizes.select(F.col("doc_id").cast("string"), "page", (F.col("width") * RENDER_SCALE).alias("__w"), (F.col("height") * RENDER_SCALE).alias("__h"))
        items = items.join(sizes, ["doc_id", "page"], "left").withColumns({"width": F.coalesce("width", "__w"), "height": F.coalesce("height", "__h")})
    kept = L.map_labels(items.withColumn("model", F.lit(vendor)), "model", "label")
    text = X.normalize_text(F.col("content"))
    box = F.when(F.col("scale").isNotNull(), B.to_unit(F.col("bbox"), 1000.0)).otherwise(B.to_unit(F.col("bbox"), None, F.col("width"), F.col("height")))
    kept = kept.select("doc_id", "model", "page", "pos", F.col("block_order").try_cast("int").alias("o"), F.col("canonical").alias("type"), "sub_type", text.alias("content"), box.alias("bbox"), F.coalesce("label_level", "title_level").alias("title_level"), F.col("label").alias("source_label"))
    kept = kept.filter(~F.col("type").isin("title", "text", "caption") | (F.col("content") != ""))
    place = Window.partitionBy("doc_id").orderBy("page", F.col("o").asc_nulls_last(), F.col("pos"))
    blocks = kept.withColumn("number", F.row_number().over(place)).withColumn("block_id", F.concat(F.col("doc_id"), F.lit("_"), F.col("number"))).drop("o", "pos")
    seen = raw.select("doc_id").distinct()
    every = seen if ids is None else seen.union(ids.select(F.col(ids.columns[0]).cast("string"))).distinct()
    counts = blocks.groupBy("doc_id").agg(F.count("*").cast("int").alias("n_blocks"))
    status = every.join(seen.withColumn("__seen", F.lit(True)), "doc_id", "left").join(bad, "doc_id", "left").join(counts, "doc_id", "left")
    state = F.when(F.col("__seen").isNull(), "missing").when(F.col("message").isNotNull(), "invalid").otherwise("ok")
    return blocks, status.select("doc_id", F.lit(vendor).alias("model"), state.alias("status"), "message", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))
