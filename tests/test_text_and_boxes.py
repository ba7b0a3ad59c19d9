import pytest
from pyspark.sql import functions as F

from leafwright.functions import bbox as B
from leafwright.functions import labels as L
from leafwright.functions import text as X


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("text, want", [(None, ""), ("", ""), ("　a \n b\t", "a b"), ("x", "x")])
def test_normalize(spark, text, want):
    assert one(spark, X.normalize_text, text) == want


@pytest.mark.parametrize("text, head, tail", [("", "", ""), ("One. Two", "One.", "Two"), ("One", "One", "One"), ("A… b", "A…", "b"), ("...", ".", "..."), ("甲。乙；", "甲。", "乙")])
def test_head_and_tail(spark, text, head, tail):
    assert one(spark, X.sentence_head, text) == head and one(spark, X.sentence_tail, text) == tail


@pytest.mark.parametrize("text, want", [("1. a", True), ("12） a", True), ("(a) b", True), ("B) c", True), ("三、 d", True), ("⑳ e", True), ("mild. f", True), ("第三条", True), ("-x", True), ("\\tx", True), ("word", False), ("1st", False), ("", False)])
def test_list_items(spark, text, want):
    assert one(spark, X.is_list_item, text) is want


@pytest.mark.parametrize("text, want", [("short", False), ("a text that goes on", True), ("a text that ends.", False), ("he said: 'it ends.'", False), ("with a\ttab in it here", False), ("ends with dots……", True)])
def test_cut_off(spark, text, want):
    assert one(spark, X.may_be_cut_off, text) is want


def test_names(spark):
    assert one(spark, X.safe_name, "a b/c.d") == "a_b_c.d" and one(spark, X.stem, "a.b.pdf") == "a.b" and one(spark, X.stem, ".x") == ".x"


@pytest.mark.parametrize("box, want", [(None, [0, 0, 0, 0]), ([1.0], [0, 0, 0, 0]), ([0.1, 0.2, 0.3, 1.2], [0.1, 0.2, 0.3, 1.0]), ([100.0, 200.0, 300.0, 2000.0], [0.1, 0.2, 0.3, 1.0]), ([100.0, None, 300.0, 1.0], [0, 0, 0, 0]), ([0.1, 0.2, 0.3, 0.4, 9.0], [0.1, 0.2, 0.3, 0.4])])
def test_unit_boxes(spark, box, want):
    assert one(spark, lambda c: B.to_unit(c, 1000.0), box, "array<double>") == want


@pytest.mark.parametrize("box, want", [(None, "length"), ([0.0, 0.0, 1.0], "length"), ([0.0, 0.0, float("nan"), 1.0], "number"), ([0.5, 0.0, 0.4, 1.0], "order"), ([0.0, 0.0, 1.1, 1.0], "range"), ([0.0, 0.0, 1.0, 1.0], None)])
def test_violations(spark, box, want):
    assert one(spark, B.violations, box, "array<double>") == want


def test_overlaps(spark):
    df = spark.createDataFrame([([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0]), ([0.0, 0.0, 1.0, 1.0], [0.0, 0.0, 0.0, 0.0])], "a array<double>, b array<double>")
    got = df.select(F.round(B.iou(F.col("a"), F.col("b")), 6), B.overlap_smaller(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(0.142857, 0.25), (0.0, 0.0)]


def test_labels_with_clashing_columns_and_nulls(spark):
    df = spark.createDataFrame([("dolphin", "sec_3", 1), ("dolphin", "sec_0", 2), ("mineru", "discarded", 3), ("mineru", None, 4), (None, "title", 5), ("glm-ocr", "header", 6)], "vendor string, label string, n int")
    got = {r.n: (r.canonical, r.sub_type, r.label_level) for r in L.map_labels(df, "vendor", "label").collect()}
    assert got == {1: ("title", "title", 3), 2: ("text", "text", None), 4: ("text", "text", None), 5: ("text", "text", None), 6: ("text", "text", None)}
