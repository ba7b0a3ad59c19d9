import json

import pytest
from pyspark.sql import functions as F

from leafwright.operators import normalize
from leafwright.sources import sinks, vendors


def put(folder, name, data):
    p = folder / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(data if isinstance(data, str) else json.dumps(data))


CASES = {
    "mineru": {
        "a/vlm/a_model.json": [[{"type": "title", "bbox": [100, 100, 500, 200], "content": " A  b "}, {"type": "discarded", "content": "x"}, {"type": "image", "bbox": [0, 0, 1000, 1000]}], [{"type": "text", "content": ""}, {"type": "list", "text": "item"}]],
        "a/vlm/a_middle.json": {"pdf_info": []},
        "b/vlm/b_middle.json": {"pdf_info": [{"page_idx": 0, "page_size": [200, 100], "para_blocks": [{"type": "text", "bbox": [20, 10, 100, 50], "lines": [{"spans": [{"content": "x"}, {"content": "y"}]}]}]}]},
        "c/vlm/c_content_list.json": [{"type": "text", "bbox": [0, 0, 500, 500], "page_idx": 2, "text_level": 2, "text": "T"}, {"type": "text", "text": "no box"}],
        "d/vlm/d_model.json": "{broken",
    },
    "monkeyocr": {"a/a_middle.json": {"pdf_info": [{"page_idx": 0, "page_size": [10, 10], "para_blocks": [{"type": "interline_equation", "bbox": [0, 0, 5, 5], "content": "E"}]}]}},
    "PaddleOCR-VL-1.5": {
        "a/layout_parsing.json": {"result": {"layoutParsingResults": [{"prunedResult": {"width": 100, "height": 200, "parsing_res_list": [{"block_label": "text", "block_content": "second", "block_bbox": [0, 0, 50, 100], "block_order": 2}, {"block_label": "doc_title", "block_content": "first", "block_bbox": [0, 0, 50, 100], "block_order": "1"}, {"block_label": "number", "block_content": "last", "block_bbox": [0, 0, 1, 1], "block_order": None}]}}]}},
        "b/b_2_res.json": {"parsing_res_list": [{"block_label": "text", "block_content": "two", "block_bbox": [0, 0, 200, 200]}]},
        "b/b_10_res.json": {"parsing_res_list": [{"block_label": "text", "block_content": "ten", "block_bbox": [0, 0, 200, 200]}]},
    },
    "dolphin": {"a/recognition_json/a.json": {"pages": [{"page_number": 3, "elements": [{"label": "para", "text": "p", "bbox": [0.1, 0.1, 0.2, 0.2], "reading_order": 1}, {"label": "sec_2", "text": "s", "bbox": [0, 0, 1, 1], "reading_order": 0}, {"label": "fig", "text": ""}]}]}},
    "glm-ocr": {
        "a/a_model.json": [{"page": 1, "blocks": [{"label": "figure_title", "bbox_2d": [0, 0, 500, 1000], "content": "cap"}]}],
        "b/page_2.json": {"width": 100, "height": 100, "words_result": [{"words": "two", "location": {"left": 10, "top": 10, "width": 40, "height": 40}}]},
        "b/page_10.json": {"response": {"width": 100, "height": 100, "words_result": [{"words": "ten", "location": {}}]}},
    },
}


def read(spark, tmp_path, vendor, **more):
    for name, data in CASES[vendor].items():
        put(tmp_path / vendor, name, data)
    blocks, status = vendors.read_vendor(spark, str(tmp_path / vendor), vendor, **more)
    got = [tuple(r) for r in blocks.orderBy("doc_id", "number").select("doc_id", "page", "type", "sub_type", "content", "title_level", "bbox").collect()]
    return got, {r.doc_id: (r.status, r.n_blocks) for r in status.collect()}


def test_mineru(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("z",)], "doc_id string")
    got, status = read(spark, tmp_path, "mineru", ids=ids)
    assert [g[:6] for g in got] == [("a", 1, "title", "title", "A b", None), ("a", 1, "image", "image", "", None), ("a", 2, "text", "list_item", "item", None), ("b", 1, "text", "text", "x y", None), ("c", 3, "title", "title", "T", 2)]
    assert got[0][6] == [0.1, 0.1, 0.5, 0.2] and got[3][6] == [0.1, 0.1, 0.5, 0.5]
    assert status == {"a": ("ok", 3), "b": ("ok", 1), "c": ("ok", 1), "d": ("invalid", 0), "z": ("missing", 0)}


def test_monkeyocr(spark, tmp_path):
    got, _ = read(spark, tmp_path, "monkeyocr")
    assert got == [("a", 1, "text", "equation", "E", None, [0.0, 0.0, 0.5, 0.5])]


def test_paddle(spark, tmp_path):
    sizes = spark.createDataFrame([("b", 1, 100.0, 100.0), ("b", 2, 100.0, 100.0)], "doc_id string, page int, width double, height double")
    got, _ = read(spark, tmp_path, "PaddleOCR-VL-1.5", page_sizes=sizes)
    assert [g[:5] for g in got] == [("a", 1, "title", "title", "first"), ("a", 1, "text", "text", "second"), ("a", 1, "text", "page_number", "last"), ("b", 1, "text", "text", "two"), ("b", 2, "text", "text", "ten")]
    assert got[0][6] == [0.0, 0.0, 0.5, 0.5] and got[3][6] == [0.0, 0.0, 1.0, 1.0]


def test_dolphin(spark, tmp_path):
    got, _ = read(spark, tmp_path, "dolphin")
    assert [g[:6] for g in got] == [("a", 3, "title", "title", "s", 2), ("a", 3, "text", "text", "p", None), ("a", 3, "image", "image", "", None)]


def test_glm(spark, tmp_path):
    got, _ = read(spark, tmp_path, "glm-ocr")
    assert [g[:5] for g in got] == [("a", 1, "caption", "image_caption", "cap"), ("b", 1, "text", "text", "two"), ("b", 2, "text", "text", "ten")]
    assert got[1][6] == [0.1, 0.1, 0.5, 0.5]


def test_unknown_vendor(spark):
    with pytest.raises(ValueError):
        vendors.read_vendor(spark, "/nowhere", "other")


def test_interchange_round_trip(spark, tmp_path):
    read(spark, tmp_path, "mineru")
    blocks, _ = vendors.read_vendor(spark, str(tmp_path / "mineru"), "mineru")
    for form in sinks.FORMATS:
        assert sinks.document_json(blocks, form).count() >= 2
    sinks.write_documents(sinks.document_json(blocks), str(tmp_path / "out"))
    back = sinks.read_documents(spark, str(tmp_path / "out"))
    key = ["doc_id", "page", "type", "content"]
    assert sorted(map(tuple, back.select(key).collect())) == sorted(map(tuple, blocks.select(key).collect()))
    assert normalize.doc_ids(back.select("doc_id"), limit=1).count() == 1
    assert back.filter(F.col("source_id").isNull()).count() == 0


def test_places_of_normalized_files(spark, tmp_path):
    page = lambda text: {"2": [{"type": "text", "content": text, "bbox": [0, 0, 1, 1]}], "1": [{"type": "title", "content": "t"}]}
    put(tmp_path / "n", "a/a.json", {"doc_id": "a", "pages": page("own folder")})
    put(tmp_path / "n", "m/a.json", page("model's folder"))
    put(tmp_path / "n", "m/b.json", page("model's folder"))
    put(tmp_path / "n", "m.json", [{"doc_id": "c", "pages": page("one file")}, {"doc_id": "b", "pages": page("one file")}])
    got = {(r.doc_id, r.page): r.content for r in sinks.read_normalized(spark, str(tmp_path / "n"), "m").collect()}
    assert got == {("a", 1): "t", ("a", 2): "own folder", ("b", 1): "t", ("b", 2): "model's folder", ("c", 1): "t", ("c", 2): "one file"}
