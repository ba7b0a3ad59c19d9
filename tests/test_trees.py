import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafwright.functions import html_table as H
from leafwright.functions import similarity as S
from leafwright.operators import candidates as C
from leafwright.operators import chunking as CH
from leafwright.operators import enrich as E
from leafwright.operators import evaluate as V
from leafwright.operators import links as LK
from leafwright.operators import prompts as P
from leafwright.operators import tables as TB
from leafwright.operators import tree as TR
from leafwright.runtime import fill, salted_join

BLOCK = "doc_id long, id int, page int, type string, content string, bbox array<double>, level int, contd int, image int, source_label string"


def block(doc, i, kind, text, level=-1, contd=-1, image=-1, page=1, label=None):
    return (doc, i, page, kind, text, [0.0, 0.0, 1.0, 1.0], level, contd, image, label)


def make(spark, *rows):
    return spark.createDataFrame(list(rows), BLOCK)


def test_fill_over_runs(spark):
    rng = random.Random(1)
    rows = [(d, i, rng.choice([None, None, i * 10])) for d in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, o int, v int")
    for forward in (True, False):
        got = {(r.k, r.o): r.near for r in fill(df, "k", "o", {"near": F.col("v")}, forward, run_length=7).collect()}
        for k, o, _ in rows:
            side = [v for kk, oo, v in rows if kk == k and v is not None and (oo < o if forward else oo > o)]
            assert got[k, o] == (None if not side else side[-1] if forward else side[0])


def test_salted_join(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 0)], "k long, v int")
    small = spark.createDataFrame([(1, "a"), (3, "b"), (1, "c")], "k long, w string")
    for how in ("left", "inner"):
        assert sorted(map(str, salted_join(big, small, "k", how, salts=4).collect())) == sorted(map(str, big.join(small, "k", how).collect()))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-1, 5), min_size=1, max_size=60))
def test_parents_are_those_of_a_stack(spark, levels):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(levels)], "doc_id long, comp_id int, level int")
    stack, want = [], {}
    for i, v in enumerate(levels):
        v = v if v > 0 else 100
        while stack and stack[-1][0] >= v:
            stack.pop()
        want[i] = (stack[-1][1] if stack else -1, [x[1] for x in stack])
        stack.append((v, i))
    got = {r.comp_id: (r.parent_id, r.ancestors) for r in TR.parents(df, run_length=9).collect()}
    assert got == want


def test_components_and_marks(spark):
    b = make(spark, block(1, 1, "text", "lead"), block(1, 2, "title", "T", 1), block(1, 3, "text", "a", contd=5), block(1, 4, "image", None), block(1, 5, "list_item", "b"), block(1, 6, "text", "c"), block(1, 7, "header", "h"), block(1, 8, "title", "no level", -1), block(2, 1, "title", "only", 1), block(3, 1, "table", "x"), block(4, 1, "text", None))
    got = {(r.doc_id, r.comp_id): (r.title, r.content, r.block_ids) for r in TR.text_components(b).collect()}
    assert got == {(1, 0): (TR.DEFAULT_TITLE, "lead", [1]), (1, 2): ("T", "a<|txt_contd|>b<|txt_split|>c<|txt_split|>no level", [2, 3, 5, 6, 8]), (2, 1): ("only", "", [1]), (4, 0): (TR.DEFAULT_TITLE, "", [1])}


def test_preview_with_nested_visuals(spark):
    b = make(spark, block(1, 1, "title", "T", 1), block(1, 2, "text", "x" * 40), block(1, 3, "table", "<t>", image=-1), block(1, 4, "table_caption", "cap", image=3), block(1, 5, "image", None, image=4), block(1, 6, "title", "U", 2), block(1, 7, "header", "H"), block(1, 8, "header", "H2"), block(2, 1, "image", None))
    got = [r.line for r in TR.preview(TR.tree(b)).filter("doc_id = 1").orderBy("path").collect()]
    assert got == ["|", "    T|" + "x" * 30 + "...", "        U|", "        cap|<t>", "            |", "    Page 1 - header|H", "    Page 1 - header - 1|H2"]
    assert [r.line for r in TR.preview(TR.tree(b)).filter("doc_id = 2").orderBy("path").collect()] == ["|", "    |"]


def test_tree_as_json(spark):
    import json

    from leafwright.sources import sinks

    b = make(spark, block(1, 1, "title", "T", 1), block(1, 2, "text", "x"), block(1, 3, "table", "<t>"), block(1, 4, "title", "U", 2), block(1, 5, "footer", "f"))
    root = json.loads(sinks.tree_json(TR.tree(b)).first().value)
    assert [(c["type"], c["title"]) for c in root["children"]] == [("text", "T"), ("footer", "Page 1 - footer")]
    assert [c["type"] for c in root["children"][0]["children"]] == ["text", "table"] and root["children"][0]["block_ids"] == [1, 2]


def test_cases_and_relations(spark):
    import json

    from leafwright.operators import cases as K

    b = make(spark, block(1, 1, "title", "T", 1), block(1, 2, "text", "x", contd=3), block(1, 3, "text", "y"), block(1, 4, "image", None, image=1))
    rel = K.relations(b)
    assert sorted(map(tuple, rel.collect())) == [(1, "contd", 2, 3), (1, "image", 4, 1), (1, "title", 1, 1)]
    assert json.loads(K.relation_records(rel).first().record) == {"contd": [[2, 3]], "image": [[4, 1]], "title": [[1, 1]]}
    asked = spark.createDataFrame([(1, 0, 1, "p"), (1, 5, 6, "q")], "doc_id long, upper_idx int, lower_idx int, prompt string")
    answers = spark.createDataFrame([(1, 0, 1, [1, 0])], "doc_id long, upper_idx int, lower_idx int, cells array<int>")
    said = {r.upper_idx: json.loads(r.case)["conversations"][1]["value"] for r in K.table_cases(asked, answers).collect()}
    assert said == {0: "[1, 0]", 5: "[]"}
    rows = C.title_rows(b)
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, idx int, level int")
    talk = json.loads(K.cases(rows, labels, "title").first().case)["conversations"]
    assert talk[0]["from"] == "human" and talk[0]["value"].startswith("<image>\nTitle Level Analysis: <|id|>0") and talk[1]["value"] == "<|id|>0<|level|>1"


def test_links_and_containment(spark):
    b = make(spark, block(1, 1, "image_block", None), block(1, 2, "image", None), block(1, 3, "text", "t"))
    links = spark.createDataFrame([(1, 1, 2, 0), (1, 1, 0, 1), (1, 9, 0, 0)], "doc_id long, src int, tgt int, ord int")
    inside = C.containment_links(b)
    assert [tuple(r) for r in inside.collect()] == [(1, 1, 0)]
    for first, want in ((False, 1), (True, 1)):
        out = LK.linked_blocks(b, images=links, contained=inside, model_first=first)
        assert {r.id: r.image for r in out.collect()} == {1: -1, 2: want, 3: -1}
    late = spark.createDataFrame([(1, 1, 2, 0)], "doc_id long, src int, tgt int, ord int")
    assert {r.id: r.image for r in LK.linked_blocks(b, images=late, contained=inside, model_first=True).collect()}[2] == 3


def test_empty_tables(spark):
    b = make(spark)
    assert TR.tree(b).count() == C.truncation_pairs(b).count() == C.screened_pairs(b).count() == LK.title_links(b).count() == 0


def test_truncation(spark):
    b = make(spark, block(1, 1, "text", "a text without an end"), block(1, 2, "image", "x"), block(1, 3, "list_item", "1) item"), block(1, 4, "text", "its rest goes here"), block(1, 5, "text", "5 begins with a digit"), block(1, 6, "text", "6 does so too"), block(1, 7, "equation", "e"), block(1, 8, "text", "after the equation"), block(1, 9, "text", None))
    assert sorted(map(tuple, C.truncation_pairs(b).collect())) == [(1, 0, 3), (1, 3, 4)]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 9), min_size=1, max_size=60))
def test_chunks_cover_all_items(pages):
    ranges = CH.page_chunks(list(pages), list(pages.values()))
    assert all(any(a <= p <= z for a, z in ranges) for p in pages)
    assert ranges == sorted(ranges)


def test_known_chunks():
    every = lambda n: CH.page_chunks(list(range(1, n + 1)), [1] * n)
    assert every(30) == [(1, 30)] and every(100) == [(1, 47), (45, 92), (90, 100)]
    assert CH.page_chunks([1], [5], single=False) == [] and CH.page_chunks([1], [5]) == [(1, 1)]


def test_level_sync(spark):
    rows = [(1, 0, 0, 10, 1), (1, 0, 1, 11, 2), (1, 1, 0, 11, 4), (1, 1, 1, 12, 5), (1, 1, 2, 13, 0), (1, 2, 0, 99, 1), (2, 0, 0, 5, 3)]
    df = spark.createDataFrame(rows, "doc_id long, chunk_no int, pos int, idx int, level int")
    got = sorted(map(tuple, LK.synced_levels(df).collect()))
    assert got == [(1, 10, 1), (1, 11, 2), (1, 12, 3), (1, 13, 0), (1, 99, 1), (2, 5, 3)]


def test_answers(spark):
    df = spark.createDataFrame([(1, "<|src_id|>3<|tgt_id|>5\nbad\n<|from|>1<|to|>2\n<|src_id|>-1<|tgt_id|>2", "<|id|>3<|level|>2\n<|id|>4<|level|>-1\nx", "so [1, 0] and [0,1,1]"), (2, None, None, "none")], "doc_id long, a string, b string, c string")
    assert sorted((r.doc_id, r.src, r.tgt) for r in P.parsed_links(df, "a").collect()) == [(1, 1, 2), (1, 3, 5)]
    assert [(r.idx, r.level) for r in P.parsed_levels(df, "b").collect()] == [(3, 2)]
    assert [r[0] for r in df.orderBy("doc_id").select(P.last_flags(F.col("c"))).collect()] == [[0, 1, 1], None]
    fenced = spark.createDataFrame([("x ```json\n[1]\n``` y",), ("a [2, [3]] b",), ("-",)], "v string")
    assert [r[0] and r[0].strip() for r in fenced.select(P.fenced_json(F.col("v"))).collect()] == ["[1]", "[2, [3]]", None]


def test_prompt_round_trip(spark):
    b = make(spark, block(1, 1, "title", "A", 1), block(1, 5, "title", "B <x>", 1, page=2))
    asked = P.prompts(C.title_rows(b).withColumn("chunk_no", F.lit(0)), "title")
    got = [(r.idx, r.page, r.box, r.content) for r in P.parsed_prompt(asked, "prompt").orderBy("idx").collect()]
    assert got == [(0, 1, [0, 0, 1000, 1000], "A"), (4, 2, [0, 0, 1000, 1000], "B <x>")]
    assert P.unanswered(asked, P.answered(asked, P.RuleModel)).count() == 0


A = "<table><tr><th colspan='2'>h</th></tr><tr><td rowspan='2'>1</td><td>2</td></tr><tr><td>3</td></tr></table>"


def test_grid():
    t = H.read_table(A)
    assert [[c for c, _ in r] for r in H.grid(t)] == [[0], [0, 1], [1]]
    assert H.total_columns(t) == 2 and H.effective_columns(t) == [2, 2, 2]
    assert H.read_table(None).rows == [] and H.read_table("<p>x").rows == []


@pytest.mark.parametrize("lower, flags, want", [
    ("<table><tr><th colspan='2'>h</th></tr><tr><td>4</td><td>5</td></tr></table>", None, 4),
    ("<table><tr><td>4</td><td>5</td></tr></table>", [0, 1], 4),
    ("<table><tr><td></td><td>rest</td></tr></table>", [1, 1], 3),
    ("", None, 3),
])
def test_merge(lower, flags, want):
    t = H.read_table(H.merge_tables(A, lower, flags))
    assert len(t.rows) == want
    if flags == [1, 1]:
        assert "3rest" in t.render()


def test_three_page_chain(spark):
    row = lambda x: f"<table><tr><td>{x}</td></tr></table>"
    b = make(spark, *[block(1, i, "table", row(i), page=i) for i in (1, 2, 3)], block(1, 4, "table_caption", "c", image=2))
    linked = LK.merged_pairs(b, spark.createDataFrame([(1, 0, 1, [0])], "doc_id long, upper_idx int, lower_idx int, cells array<int>"))
    both = LK.merged_pairs(b, spark.createDataFrame([(1, 0, 1, [0]), (1, 1, 2, [0])], "doc_id long, upper_idx int, lower_idx int, cells array<int>"))
    assert [r.member_ids for r in TB.merged_tables(linked).collect()] == [[1, 2]]
    whole = TB.merged_tables(both)
    assert whole.count() <= 1
    out = TB.without_parts(linked, TB.merged_tables(linked))
    assert {r.id: r.image for r in out.collect()} == {1: -1, 3: -1, 4: 1}


def test_header_rows(spark):
    html = [(1, 1, A), (1, 2, "<table><tr><th colspan='2'> h </th></tr><tr><td>x</td><td>2</td></tr></table>")]
    cells = TB.table_cells(spark.createDataFrame(html, "doc_id long, id int, content string"))
    pairs = spark.createDataFrame([(1, 1, 2)], "doc_id long, upper_id int, lower_id int")
    assert TB.header_rows(pairs, cells).first().n_header == 1
    assert {r.n_cols for r in TB.table_shapes(cells).collect()} == {2}
    assert {(r.id, r.row): r.effective for r in TB.row_shapes(cells).collect()}[1, 2] == 2


def screened(spark, upper, lower, widths=(1.0, 1.0), after=(), before=()):
    """Reason for one pair: blocks before and after the tables on their pages, given as (type, content)."""
    rows, i = [], 0
    for page, parts in ((1, [*upper, ("table", "<tr><td>1</td></tr>"), *after]), (2, [*before, *lower, ("table", "<tr><td>2</td></tr>")])):
        for kind, text in parts:
            i += 1
            rows.append((1, i, page, kind, text, [0.0, 0.0, widths[page - 1], 1.0], -1, -1, -1, None))
    return C.screened_pairs(spark.createDataFrame(rows, BLOCK)).first().reason


@pytest.mark.parametrize("args, want", [
    (dict(upper=[], lower=[]), None),
    (dict(upper=[("table_caption", "Table 1. x")], lower=[]), None),
    (dict(upper=[], lower=[], after=[("text", "t")]), "text after upper table"),
    (dict(upper=[], lower=[], before=[("list_item", "t")]), "text before lower table"),
    (dict(upper=[("image", "")], lower=[("table_caption", "Table 2")]), "caption of lower table only"),
    (dict(upper=[("table_caption", "Table 1")], lower=[("table_caption", "Table 2 (continued)")]), "captions differ"),
    (dict(upper=[("table_caption", "Table 1")], lower=[("table_caption", "Table 1")]), "no mark of continuation"),
    (dict(upper=[("table_caption", "Table 1")], lower=[("table_caption", "Table 1（续）")]), None),
    (dict(upper=[("title", "Prices")], lower=[("title", "prices (cont.)")]), None),
    (dict(upper=[("table_caption", "表 A-1")], lower=[("table_caption", "表A1 续表")]), None),
    (dict(upper=[], lower=[], after=[("table_footnote", "n")]), "footnotes"),
    (dict(upper=[], lower=[], widths=(1.0, 0.8)), "widths differ"),
    (dict(upper=[], lower=[], widths=(0.0, 0.8)), None),
])
def test_screening(spark, args, want):
    assert screened(spark, **args) == want


def test_subnodes(spark):
    long = "<|txt_split|>".join(["a" * 300, "b" * 300, "c" * 10])
    n = spark.createDataFrame([(1, "x", "text", "T", long, [1, 2, 3, 4]), (1, "y", "text", TR.DEFAULT_TITLE, long, [2, 3, 4]), (1, "z", "text", "T", "d" * 600, [1, 2]), (1, "w", "table", "T", long, None)], "doc_id long, node string, type string, title string, content string, block_ids array<int>")
    got = sorted((r.node, r.sub_no, len(r.content), r.block_ids) for r in E.subnodes(n).collect())
    assert got == [("x", 1, 600, [1, 2, 3]), ("x", 2, 10, [1, 4]), ("y", 1, 600, [2, 3]), ("y", 2, 10, [4])]


def test_annotation(spark):
    df = spark.createDataFrame([("[T] a [M] b\nc [C] d",), ("nothing",)], "v string")
    assert [tuple(r[0]) for r in df.select(E.annotation(F.col("v"))).collect()] == [("a", "b\nc", "d"), ("Default Title", "Default Metadata", "Default Content")]


titles = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3)), max_size=7)


@settings(max_examples=80, deadline=None)
@given(titles, titles)
def test_tree_distance(a, b):
    x, y = S.level_tree(a), S.level_tree(b)
    assert S.tree_distance(x, x) == 0
    assert S.tree_distance(x, y) == S.tree_distance(y, x) <= len(a) + len(b)
    assert S.tree_distance(x, y) >= abs(len(a) - len(b))
    assert 0.0 <= S.tree_score(a, b) <= 1.0


def plain_distance(a, b):
    """Distance of two forests by the recursive definition."""
    from functools import cache

    def forest(nodes):
        labels, parents = S.level_tree(nodes)
        make = lambda p: tuple((labels[i], make(i)) for i, q in enumerate(parents) if q == p)
        return make(-1)

    size = lambda f: sum(1 + size(k) for _, k in f)

    @cache
    def d(x, y):
        if not x or not y:
            return size(x) + size(y)
        (u, ku), (v, kv) = x[-1], y[-1]
        return min(d(x[:-1] + ku, y) + 1, d(x, y[:-1] + kv) + 1, d(ku, kv) + d(x[:-1], y[:-1]) + (u != v))

    return d(forest(a), forest(b))


@settings(max_examples=150, deadline=None)
@given(titles, titles, st.sampled_from([-1, 48]))
def test_tree_distance_by_definition(a, b, wide):
    before, S.WIDE = S.WIDE, wide
    try:
        assert S.tree_distance(S.level_tree(a), S.level_tree(b)) == plain_distance(a, b)
    finally:
        S.WIDE = before


def test_matching_is_one_to_one(spark):
    p = spark.createDataFrame([(1, 1, "g1", "m1", 0.9, 1.0, 1.0), (1, 1, "g1", "m2", 0.8, 1.0, 1.0), (1, 1, "g2", "m1", 0.7, 1.0, 1.0), (1, 1, "g2", "m2", 0.6, 0.1, 0.1), (1, 1, "g3", "m2", 0.5, 0.9, 0.1)], "doc_id long, page int, gt_id string, block_id string, score double, box double, text double")
    assert sorted((r.gt_id, r.block_id) for r in V.matched(p).collect()) == [("g1", "m1"), ("g3", "m2")]


def test_captions_in_other_scripts_differ(spark):
    from leafwright.operators.candidates import _clean_caption

    df = spark.createDataFrame([("Результаты измерений (continued)", "Состав комиссии"), ("Prüfung", "Prfung"), ("Tabelle: Ä 1", "tabelleä1")], "a string, b string")
    got = [tuple(r) for r in df.select(_clean_caption(F.col("a")), _clean_caption(F.col("b"))).collect()]
    assert got == [("результатыизмерений", "составкомиссии"), ("prüfung", "prfung"), ("tabelleä1", "tabelleä1")]


def test_table_screen_looks_at_columns_last(spark):
    from leafwright.operators import candidates as C
    from leafwright.operators import tables as TB

    t = lambda n: "<table><tr>" + "<td>1</td>" * n + "</tr></table>"
    rows = [(1, 1, 1, "table", t(3)), (1, 2, 2, "table", t(3)), (2, 1, 1, "table", t(3)), (2, 2, 2, "table", t(2)), (3, 1, 1, "table", None), (3, 2, 2, "table", t(2)), (4, 1, 1, "table", t(2)), (4, 2, 1, "text", "x"), (4, 3, 2, "table", t(2))]
    b = spark.createDataFrame([(*r, [0.1, 0.1, 0.9, 0.9]) for r in rows], "doc_id long, id int, page int, type string, content string, bbox array<double>")
    got = {r.doc_id: r.reason for r in C.screened_pairs(b).collect()}
    assert got == {1: None, 2: "columns differ", 3: "columns differ", 4: "text after upper table"}
    pairs = C.screened_pairs(b).filter("reason is null")
    asked = TB.merge_prompts(pairs, b).collect()
    assert [(r.doc_id, r.upper_idx, r.lower_idx) for r in asked] == [(1, 0, 1)] and "rowspan=1,colspan=1, 1" in asked[0].prompt


def test_visual_headers(spark):
    from leafwright.operators import tables as TB

    html = lambda *rows: "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"
    a, b = html("<td colspan=2>H</td><td>K</td>", "<td>1</td><td>2</td><td>3</td>"), html("<td>Ｈ</td><td colspan=2>K</td>", "<td>4</td><td>2</td><td>3</td>")
    rows = [(1, 1, a), (1, 2, b), (2, 1, a), (2, 2, a), (3, 1, a), (3, 2, html("<td>x</td>"))]
    cells = TB.table_cells(spark.createDataFrame(rows, "doc_id long, id int, content string"))
    pairs = spark.createDataFrame([(d, 1, 2) for d in (1, 2, 3)], "doc_id long, upper_id int, lower_id int")
    assert {r.doc_id: r.n_header for r in TB.visual_header_rows(pairs, cells).collect()} == {1: 1, 2: 2, 3: 0}


def test_chunks_always_go_on():
    from leafwright.operators.chunking import page_chunks

    pages = list(range(1, 41))
    got = page_chunks(pages, [100 if p == 1 else 1 for p in pages], size=3, overlap=1, reach=9)
    assert got[-1][1] == 40 and len(got) < 40
    assert page_chunks(pages, [1] * 40, size=10, overlap=3)[-2:] == [(page_chunks(pages, [1] * 40, size=10, overlap=3)[-2][0], 40), (37, 40)]


def test_long_requests_are_marked_and_resumed(spark, monkeypatch):
    from leafwright.operators import prompts as P

    monkeypatch.setattr(P, "PROMPT_LIMIT", 50)
    df = spark.createDataFrame([(1, P.HEADS["contd"] + ": " + "<|id|>1<|page|>1x\n" * 9), (2, "short")], "doc_id long, prompt string")
    done = P.answered(df, P.RuleModel).withColumn("response", F.lit("x"))
    assert {r.doc_id: r.lost > 0 for r in done.collect()} == {1: True, 2: False}
    assert P.unanswered(df, done).count() == 0 and P.unanswered(df, done.filter("doc_id = 2").drop("request_id")).count() == 1


def test_places_keep_their_entries_and_envelopes_their_roots():
    from leafwright.operators import nested as N

    boxes = lambda box: N.flatten_payload('{"type": "a", "location": [{"bbox": %s, "page": 1}]}' % box)[0]["places"][0]["bbox"]  # noqa: E731, UP031
    assert boxes('[null, 0.2, "0.3", "x"]') == [None, 0.2, 0.3, None] and boxes('["0.1", true]') == [0.1, None]
    value = '{"type": "a"}'
    for _ in range(12):
        value = '{"data": ' + value + "}"
    assert [n["type"] for n in N.flatten_payload(value)] == ["a"]
    assert [n["type"] for n in N.flatten_payload('{"x": {"type": "a"}, "y": {"type": "b", "children": [{"type": "c"}]}}')] == ["a", "b", "c"]


def test_merged_tables_keep_their_places(spark):
    from leafwright.operators import tables as TB
    from leafwright.operators import tree as TR

    t = "<table><tr><td>1</td></tr></table>"
    rows = [(1, 1, 1, "table", t, [0.1, 0.1, 0.5, 0.5], -1, 2, [0]), (1, 2, 2, "table", t, [0.2, 0.2, 0.6, 0.6], -1, 1, [0]), (1, 3, 2, "table_caption", "cap", [0.3, 0.3, 0.4, 0.4], 2, -1, [])]
    b = spark.createDataFrame(rows, "doc_id long, id int, page int, type string, content string, bbox array<double>, image int, table_merge int, cell_list array<int>").withColumns({"level": F.lit(-1), "contd": F.lit(-1), "source_label": F.lit(None).cast("string")})
    whole = TB.without_parts(b, TB.merged_tables(b))
    v = TR.visual_components(whole).collect()
    assert len(v) == 1 and v[0].block_ids == [1, 2, 3] and v[0].title == "cap" and [(x.page, x.bbox[0]) for x in v[0].locations] == [(1, 0.1), (2, 0.2), (2, 0.3)]
