import random

import pytest

from leafwright.llm import residue

TEXTS = [
    (1, "404 Not Found\nMenu", "message"), (2, "Please enable JavaScript to view this document.", "message"), (3, "A title\nDear {{ client_name }},\nmore text", "slot"), (4, "Title\nLorem ipsum dolor sit amet magna aliqua.", "filler"), (5, "Title\nTBD TBD TBD", "filler"), (6, "Prepared for: [department]", "slot"), (7, "ДОСТУП ЗАПРЕЩЁН", "message"),
    (8, "The policy forbids pages that ask visitors to enable JavaScript before the x is shown.\nMore.", None), (9, "The manual explains that the token {{client_name}} is replaced before printing.", None), (10, "Reviewers argue that filler such as lorem ipsum hides faults.", None), (11, "In the outage we counted 40 answers with status 404.", None), (12, None, None), (13, " \n", None), (14, "See [22] and [68]. <b> {80; 69} #29", None), (15, "Menu\nHelp | Terms", None), (16, "x" * 200_000, "filler"), (1, "404 Not Found\nMenu", "message"),
]
LONG_LINES = [
    ("404 Not Found. The page you asked for was moved or deleted. Access denied for this address. Please wait: internal server error. Session expired. Menu. Bad gateway. Connection refused.", "message"),
    ("Please enable JavaScript to view this document. Scripts are disabled in your browser. This viewer requires scripts. Without JavaScript the pages are not shown. Cookies must be enabled for it too.", "message"),
    ("The committee met in March and heard five reports on roads, bridges and water supply in the northern towns. Your text goes here. The next meeting takes place in the autumn.", "filler"),
    ("The style guide explains that writers leave strings such as these in drafts of reports and letters all too often. Your text goes here. It then asks them to remove all of these.", None),
    ("The committee met in March and heard five reports on roads, bridges and water supply in the northern towns. Access denied. The next meeting takes place in the autumn.", None),
    ("Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit", "filler"), ("Sunt in culpa qui officia", "filler"), ("Il est et non qui sed, in est", None),
    ("The committee met in March and heard five reports on roads, bridges and water supply in the northern towns. " + "x" * 150 + ". The next meeting takes place in the autumn.", None), ("x" * 300 + "y", None),
    ("This page of the document archive of the northern towns and their neighbouring districts cannot be shown to visitors at all, since the viewer that draws tables, figures, footnotes and formulas requires JavaScript and your browser has it switched off at the moment; please switch it on", "message"),
    ("The document that you asked for is not kept in the archive of the northern towns any longer, or has never been kept there, and the server that looked for it in all of its stores and in those of the neighbouring districts answers with this notice only: Error 404.", "message"),
    ("Replace this paragraph with a short account of what the committee decided on roads, bridges and water supply in the northern towns, who voted for it, and what it costs", "filler"),
    ("Menu\nToo many requests. Wait 36 seconds.", "message"), ("请启用 JavaScript 后查看本文档。\nSign in", "message"), ("Dear [Your Name], thank you for the order of <Customer Name>", "slot"), ("Hello {% if user.name %}there", "slot"), ("long " * 300 + "{{client_name}} more", "slot"),
]


def found(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r.kind for r in residue.residues(df).collect()}


def test_residues(spark):
    docs = spark.createDataFrame([(d, t, "k", 5) for d, t, _ in TEXTS], "doc_id long, text string, kind string, leaf int")
    got = sorted(map(tuple, residue.residues(docs).collect()))
    assert got == sorted({(d, k) for d, _, k in TEXTS if k})
    assert residue.residues(docs.limit(0)).count() == residue.mined_templates(docs.limit(0)).count() == 0
    assert sorted({r.doc_id for r in residue.without_residue(docs).collect()}) == list(range(8, 16))


def test_whole_lines_count_at_any_length(spark):
    texts = [t for t, _ in LONG_LINES] + ["Menu\n" + t for t, _ in LONG_LINES]
    got = found(spark, texts)
    assert [got.get(i) for i in range(len(texts))] == [k for _, k in LONG_LINES] * 2


#: Messages of languages that no pattern knows, and furniture around them.
UNKNOWN = ["Strona {} nie istnieje", "Siden {} blev ikke fundet her", "Het document {} is niet beschikbaar"]


def unknown_pages(rng):
    """Pages of unknown messages with furniture, and ordinary texts, one of which quotes such a message."""
    pages = ["\n".join(rng.sample(["Menu", "Sign in", "Help | Terms"], 2) + [m.format(rng.choice("abcdefgh") + str(rng.randint(1, 99)))]) for m in UNKNOWN for _ in range(6)]
    words = [f"word{chr(97 + i)}{chr(97 + k)}" for i in range(20) for k in range(20)]
    plain = ["Menu\n" + " ".join(rng.sample(words, 30)) + "." for _ in range(30)]
    quoting = ["Notes on pages\nSiden 4 blev ikke fundet her\n" + " ".join(rng.sample(words, 30))]
    return pages, plain + quoting


def test_templates_tell_messages_that_no_pattern_knows(spark, monkeypatch):
    pages, plain = unknown_pages(random.Random(4))
    assert all(residue.seed(s) is None and not residue.furniture(s) for p in pages for s in p.lower().split("\n")[2:])
    got = found(spark, pages + plain)
    assert {i for i in got} == set(range(len(pages))) and set(got.values()) == {"message"}
    learned = residue.mined_templates(spark.createDataFrame([(i, t) for i, t in enumerate(pages + plain)], "doc_id long, text string")).filter("learned")
    assert {r.template for r in learned.collect()} == {"strona <*> nie istnieje", "siden <*> blev ikke fundet her", "het document <*> is niet beschikbaar"}
    monkeypatch.setattr(residue, "SUPPORT", 10**9)  # without support the templates tell nothing
    assert not found(spark, pages + plain)


def test_copies_of_one_text_are_no_support(spark):
    assert not found(spark, ["Menu\nStrona a1 nie istnieje"] * 20)


def test_quoted_messages_lose_their_verdict(spark):
    texts = [f"Minutes of {w}{w}\nInternal server error in the old hall\nMore about {w}" for w in "abcdefgh"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert residue.mined_templates(df).filter("verdict = 'error'").count() == 0


def test_prefix_tree():
    t = residue.PrefixTree()
    lines = ("could not open file in store #", "could not open file in store a#b", "could not read the file now", "could not open file on disk #")
    for line in lines:
        t.add(line.split())
    assert sorted(" ".join(x) for x, _ in t.leaves.values()) == ["could not open file <*> <*> <*>", "could not read the file now"]
    assert sorted(n for _, n in t.leaves.values()) == [1, 3]
    assert residue.tokens("第#页abc") == ["第", "#", "页", "abc"]


@pytest.mark.parametrize("pattern", [residue.ERRORS, residue.SCRIPTS, residue.FILLERS])
def test_the_gate_loses_no_match(pattern):
    for text in [t for _, t, _ in TEXTS if t] + [t for t, _ in LONG_LINES]:
        for line in residue.masked_lines(text):
            for s in residue.sentences(line):
                if pattern.search(s):
                    assert any(x and x[1].search(s) for x in residue._found(s))
