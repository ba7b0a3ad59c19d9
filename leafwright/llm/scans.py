"""Problem 2: traces of scanned pages in text: cut words, misread characters, running headers, page numbers.

Two passes over the records. The first counts the corpus vocabulary (words, hyphenated words, cut words),
combined per partition. From it follow, as small tables, the misread words (same shape as a far more
frequent word, reachable from it by known misreadings) and the cut words whose mark is no part of the word.
Header lines come per document from header blocks, from fuzzy repetition of lines at page edges (same shape,
digits set aside, on two pages or more) and from the document's first title. Page numbers are those of the record's
own page, and those of a sequence: numbers alone in a line, Arabic or Roman, that keep one distance from the page over
pages in a row. The second pass looks for all four in every whole record.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.llm.lookalike import one_form
from leafwright.llm.records import TEXT_BLOCKS, TEXT_NODES, block_key, node_key
from leafwright.operators.nested import tree_nodes
from leafwright.runtime import cut, hot_keys, salted_join, written

#: What a scanner makes of printed characters, as pairs of printed and read.
MISREADINGS = (
    ("e", "c"), ("s", "5"), ("t", "f"), ("o", "0"), ("i", "1"), ("l", "1"), ("d", "cl"), ("m", "rn"), ("u", "ii"), ("g", "9"), ("b", "6"), ("b", "8"), ("h", "li"), ("w", "vv"), ("ri", "n"), ("rn", "m"),
    ("l", "I"), ("l", "|"), ("i", "|"), ("l", "!"), ("i", "!"), ("о", "0"), ("и", "н"), ("п", "н"), ("з", "3"), ("б", "6"), ("ш", "щ"),
)
#: What each character turns into so that characters read for one another, or for pairs of others, become equal.
SHAPES = str.maketrans({
    "h": "ll", "u": "ll", "d": "cl", "w": "vv", "n": "rl", "m": "rrl", "i": "l", "1": "l", "|": "l", "!": "l", "e": "c", "t": "f", "0": "o", "о": "o", "5": "s", "6": "b", "8": "b", "б": "b", "9": "g", "и": "н", "п": "н", "3": "з", "щ": "ш",
})
#: A misread word has at least this length, and its model is at least so many times as frequent.
MIN_LENGTH, TIMES = 5, 8
#: Up to so many misread and cut words travel to the executors as a set; more are joined.
SET_LIMIT = 300_000

_NO_PROSE = re.compile(r"<\|txt_\w+\|>|<[^<>]*>|&#?\w+;|(?<!\S)[^\s\\/@_]*[\\/@_]\S*")
_WORD = re.compile(r"[0-9A-Za-z\u00aa-\u058f\u1e00-\u1fff]+")
_COMPOUND = re.compile(r"[0-9A-Za-z\u00aa-\u058f\u1e00-\u1fff]+(?:-[0-9A-Za-z\u00aa-\u058f\u1e00-\u1fff]+)+")
_CUT_AT = re.compile(r"(?<=[^\W\d_])[-‐¬\u00ad](?:\s*<\|txt_contd\|>\s*|\s+)(?=([^\W\d_]+))")
_LINE_END = re.compile(r"\r\n|[\n\r\v\f  ]|<\|txt_(?:split|contd)\|>")
_HAS_LETTERS = re.compile(r"[^\W\d_][\W_]?[^\W\d_]")
_SEQUENCE = r"(?P<n>\d{1,6})"
_OF = r"\s*(?:of|von|de|sur|из|/|di|van)\s*\d{1,6}"
_LABEL = r"(?:p|pp|pág|S|s|Seite|seite|Page|page|PAGE|Página|página|Стр|стр|Pag)\.?"
#: Printed page numbers that stand alone in a line, and those that stand out inside one.
PAGE_LINE = re.compile(rf"\s*(?:[-–—]\s*{_SEQUENCE}\s*[-–—]|\[\s*(?P<n2>\d+)\s*\]|(?P<n3>\d+)\s*/\s*\d+|(?P<n4>\d+)|{_LABEL}\s*(?P<n5>\d+)(?:{_OF})?|第\s*(?P<n6>\d+)\s*页(?:\s*共\s*\d+\s*页)?)\s*\Z")
PAGE_INSIDE = re.compile(r"(?<=\s)(?:(?:Seite|Page|Página|Стр\.|第)\s*(?P<n>\d{1,6})(?:\s*页(?:\s*共\s*\d+\s*页)?|\s*(?:of|von|de|sur|из)\s*\d{1,6})?|[-–—] (?P<n2>\d{1,6}) [-–—])(?=\s)")
#: Words after which a page is referred to.
_REFERENCE = re.compile(r"(?i)(?:(?<!\w)(?:see|siehe|voir(?: la)?|véase(?: la)?|page|pages|Seite|página|см\.|стр\.)|详见)\s*\Z")
_END_TOKEN = re.compile(r"[|·•–—\-]+\Z|\d{1,6}\Z")
_HAN = re.compile(r"[\u3400-\u9fff]")


def shape(text: str) -> str:
    return text.casefold().translate(SHAPES)


@lru_cache(maxsize=1 << 18)
def token_shape(token: str) -> str:
    return shape(one_form(token, "Latin") or "")


def _line_tokens(line: str) -> list[str]:
    return [t for t in line.split() if token_shape(t)]


def line_shape(line: str) -> str:
    """Fuzzy form of a line: case, look-alikes and misreadings, and numbers and signs at the ends set aside."""
    tokens = _line_tokens(line)
    while tokens and _END_TOKEN.match(tokens[0]):
        tokens.pop(0)
    while tokens and _END_TOKEN.match(tokens[-1]):
        tokens.pop()
    return " ".join(map(token_shape, tokens))


def _cuts(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Start and end of each word that is cut by a mark and a break, and its two parts."""
    if "-" in text or "\u00ad" in text or "‐" in text or "¬" in text:
        for m in _CUT_AT.finditer(text):
            start = m.start()
            while start and text[start - 1].isalpha():
                start -= 1
            yield start, m.end(1), text[start : m.start()], m[1]


def cut_words(text: str) -> Iterator[tuple[str, str]]:
    return ((a, b) for _, _, a, b in _cuts(text))


def _replace_cuts(text: str, by: Callable[[str, str, str], str]) -> str:
    out, at = [], 0
    for start, end, a, b in _cuts(text):
        if start >= at:
            out += text[at:start], by(a, b, text[start:end])
            at = end
    return "".join((*out, text[at:])) if at else text


def prose(text: str) -> str:
    """The text without tags, addresses, paths, marks and cut words, whose parts are no words."""
    if "<" in text or "\\" in text or "/" in text or "@" in text or "_" in text or "&" in text:
        text = _NO_PROSE.sub(" ", text)
    return _replace_cuts(text, lambda a, b, both: " ")


def could_be_misread(word: str) -> bool:
    """Codes are mostly digits; a word in capitals, with a capital at its start or inside may be misread as well."""
    return len(word) >= MIN_LENGTH and 2 * sum(map(str.isalpha, word)) > len(word)


def as_read(word: str) -> str:
    """The word in lower case, but for a capital I amid small letters, which stands for an l."""
    return word.lower() if word.isupper() else "".join(c if c == "I" else c.lower() for c in word)


def is_misreading(printed: str, read: str) -> bool:
    """Whether misreadings alone lead from printed to read."""
    seen, todo = set(), [(0, 0)]
    while todo:
        i, j = todo.pop()
        if (i, j) in seen:
            continue
        seen.add((i, j))
        if i == len(printed) and j == len(read):
            return printed != read
        if i < len(printed) and j < len(read) and printed[i] == read[j]:
            todo.append((i + 1, j + 1))
        todo += [(i + len(a), j + len(b)) for a, b in MISREADINGS if printed.startswith(a, i) and read.startswith(b, j)]
    return False


def _vocabulary_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    cuts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        rows = [("w", w, n) for w, n in words.items() if not w.isdigit()] + [("c", f"{a} {b}", n) for (a, b), n in cuts.items()]
        out = pa.RecordBatch.from_pydict({"kind": pa.array([r[0] for r in rows], pa.string()), "key": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int64())})
        words.clear()
        cuts.clear()
        return out

    for b in batches:
        for t in b.column("text").to_pylist():
            if t:
                t_prose = prose(t)
                words.update(_WORD.findall(t_prose))
                if "-" in t_prose:
                    words.update(_COMPOUND.findall(t_prose))
                cuts.update(cut_words(t))
        if len(words) > 200_000:
            yield flush()
    yield flush()


def vocabulary(records: DataFrame) -> DataFrame:
    """kind, key, n over all texts: words and hyphenated words (kind w) and cut words (kind c, two parts)."""
    out = records.select("text").mapInArrow(_vocabulary_rows, "kind string, key string, n long")
    return out.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def misread_words(words: DataFrame) -> DataFrame:
    """word, printed: rare words of (word, n) that misreadings make of a word at least TIMES as frequent."""

    @F.pandas_udf(T.StringType())
    def _shape(s: pd.Series) -> pd.Series:
        return s.map(lambda w: shape(w))

    @F.pandas_udf(T.BooleanType())
    def _reached(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([could_be_misread(y) and is_misreading(x.lower(), as_read(y)) for x, y in zip(a, b, strict=True)])

    shaped = words.withColumn("shape", _shape("word"))
    top = shaped.filter(~F.col("word").rlike(r"\d")).groupBy("shape").agg(F.max(F.struct("n", "word")).alias("top"))
    near = shaped.join(top, "shape").filter((F.col("n") * TIMES <= F.col("top.n")) & (F.col("word") != F.col("top.word")))
    return near.select("word", F.col("top.word").alias("printed")).filter(_reached("printed", "word"))


def cut_decisions(vocab: DataFrame) -> DataFrame:
    """pair, whole: cut words whose mark is no part of the word, and the word they make.

    The joined word must be known and at least as frequent as the hyphenated one. Where neither is known,
    the mark goes unless the second part is a word of its own (as in "short- and long-term").
    """
    words = vocab.filter("kind = 'w'").select(F.lower("key").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n"))
    pairs = vocab.filter("kind = 'c'").select(F.col("key").alias("pair"), F.split(F.lower("key"), " ").alias("p"))
    a, b = F.col("p")[0], F.col("p")[1]
    asked = pairs.select("pair", F.explode(F.array(*[F.struct(F.lit(k).alias("as"), w.alias("w")) for k, w in (("joined", F.concat(a, b)), ("marked", F.concat_ws("-", a, b)), ("second", b))])).alias("q"))
    known = asked.select("pair", "q.as", "q.w").join(words, "w", "left").groupBy("pair").agg(*[F.max(F.when(F.col("as") == k, F.coalesce("n", F.lit(0)))).alias(k) for k in ("joined", "marked", "second")])
    yes = F.when(F.col("joined") > 0, F.col("joined") >= F.col("marked")).when(F.col("marked") > 0, F.lit(False)).otherwise(F.col("second") <= F.lit(3))
    return known.filter(yes).select("pair", F.regexp_replace("pair", " ", "").alias("whole"))


def page_number_in(text: str, pages: set[int]) -> bool:
    """Whether a line, or a marked number inside one, is the printed number of a page of the record."""
    if pages and not any(str(p) in text for p in pages):
        return False
    before = ""
    for line in _LINE_END.split(text):
        if m := PAGE_LINE.match(line):
            n = int(next(x for x in m.groups() if x))
            strict = any(c.isalpha() for c in line) or line.strip()[0] in "-–—"
            if (n in pages if pages else strict) and not _REFERENCE.search(before):
                return True
        elif pages and ("age " in line or "eite " in line or "ágina " in line or "Стр." in line or "第" in line or "- " in line or "— " in line or "– " in line):
            for m in PAGE_INSIDE.finditer(line):
                if int(m["n"] or m["n2"]) in pages and not _REFERENCE.search(line[: m.start()]):
                    return True
        before = line
    return False


_ROMAN_LINE = re.compile(r"\s*[-–—]?\s*([ivxlc]{1,9}|[IVXLC]{1,9})\s*[-–—]?\s*\Z")
#: Roman digits.
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def roman(text: str) -> int:
    """Value of a Roman numeral."""
    v = [_ROMAN[c] for c in text.lower()]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0], strict=True))


def numbers_alone(text: str) -> Iterator[tuple[str, int]]:
    """Kind (n or r for Roman) and value of numbers that stand alone in a line, as printed page numbers do."""
    before = ""
    for line in _LINE_END.split(text):
        if line and not line.isspace():
            if m := PAGE_LINE.match(line):
                if not _REFERENCE.search(before):
                    yield "n", int(next(x for x in m.groups() if x))
            elif m := _ROMAN_LINE.match(line):
                yield "r", roman(m[1])
        before = line


def page_sequences(numbers: DataFrame, least: int = 3) -> DataFrame:
    """doc_id, kind, shift: sequences of numbers (doc_id, kind, page, number) that grow with the pages.

    shift is number less page; it counts if it holds on `least` pages in a row or more, so that front matter, extracts and
    Roman numerals are found at any offset. A page's numbers count once, so rows are few at any length of texts.
    """
    d = numbers.select("doc_id", "kind", (F.col("number") - F.col("page")).alias("shift"), "page").distinct()
    row = F.row_number().over(Window.partitionBy("doc_id", "kind", "shift").orderBy("page"))
    return d.withColumn("run", F.col("page") - row).groupBy("doc_id", "kind", "shift", "run").count().filter(F.col("count") >= least).select("doc_id", "kind", "shift").distinct()


def header_in(text: str, head: str, pages: set[int]) -> tuple[bool, bool]:
    """Whether the text holds the header line (its line_shape), and whether a page number goes with it.

    The header may be a line of its own, with a number before or after it, or stand inside a line.
    """
    found = number = False
    want = head.split(" ")
    han = bool(_HAN.search(head))
    if "<|txt_" in text:
        text = text.replace("<|txt_split|>", "\n").replace("<|txt_contd|>", "\n")
    if not han and not {*want} <= {*map(token_shape, text.split())}:
        return False, False
    for line in _LINE_END.split(text):
        tokens = _line_tokens(line)
        shapes = [token_shape(t) for t in tokens]
        if head not in " ".join(shapes):
            continue
        at = next((i for i in range(len(shapes) - len(want) + 1) if shapes[i : i + len(want)] == want), -1)
        if at < 0:
            found = found or han
            continue
        left, right = tokens[:at], tokens[at + len(want) :]
        alone = all(map(_END_TOKEN.match, left + right))
        if not alone and left[:1] and left[0][0] in "#=\\<*" and len(left) == 1:
            continue  # a heading's markup
        found = True
        near = left[-2:] + right[:2] if alone else [t for t in right[:2] if not (right[0][0].isalpha())]
        number = number or any(t.isdigit() and (not pages or int(t) in pages) for t in near)
    return found, number


def scan_records(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """doc_id, rec_key, text, pages: all text records with the pages they stand on; those without a text or key are left out."""
    b = blocks.filter(F.col("block_type").isin(*TEXT_BLOCKS)).select("doc_id", block_key().alias("rec_key"), F.col("content").alias("text"), F.when(F.col("page").isNotNull(), F.array("page")).otherwise(F.array().cast("array<int>")).alias("pages"))
    t = tree_nodes(trees, ["node_no", "content", "places"], ["tree_key", "doc_id"], only_types=TEXT_NODES)
    t = t.select("doc_id", node_key().alias("rec_key"), F.col("content").alias("text"), F.array_distinct(F.filter(F.transform("places", lambda p: p["page"]), lambda p: p.isNotNull())).alias("pages"))
    return b.unionByName(t).filter("text <> '' and rec_key is not null")


def header_lines(blocks: DataFrame) -> DataFrame:
    """doc_id, head: the line_shape of each running header line of a document.

    Header blocks and the document's first title count by themselves; the first and last lines of the blocks at a page's edges
    count if they come back on two pages that are a quarter of the document's pages or more, or on three pages in a row.
    Sentences are no header lines.
    """
    edges = blocks.groupBy("doc_id", "page").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    n_pages = edges.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    first = blocks.filter("block_type = 'title' and content <> ''").groupBy("doc_id").agg(F.min(F.struct("id", "content")).alias("t")).select("doc_id", F.col("t.content").alias("line"), F.lit(True).alias("sure"), F.lit(0).alias("page"))
    typed = blocks.filter("block_type = 'header' and content <> ''").select("doc_id", F.col("content").alias("line"), F.lit(True).alias("sure"), "page")
    lines = F.split(F.trim("content"), r"\s*[\r\n]\s*")
    outer = F.array_distinct(F.array(F.get(lines, 0), F.element_at(lines, -1)))
    text = blocks.filter(F.col("block_type").isin(*TEXT_BLOCKS) & (F.trim("content") != "")).select("doc_id", "page", "id", F.explode(outer).alias("line")).filter(~F.col("line").rlike(r"[.!?。:;]\s*$"))
    at_edge = text.join(edges, ["doc_id", "page"]).filter("id = lo or id = hi").select("doc_id", "line", F.lit(False).alias("sure"), "page")

    @F.pandas_udf(T.StringType())
    def _line_shape(s: pd.Series) -> pd.Series:
        return s.map(lambda x: line_shape(x) if _HAS_LETTERS.search(x) and not PAGE_LINE.match(x) else "")

    shaped = first.unionByName(typed).unionByName(at_edge).withColumn("head", _line_shape("line")).filter(F.length("head") >= 6)
    pages = shaped.groupBy("doc_id", "head", "page").agg(F.max("sure").alias("sure"))
    row = F.row_number().over(Window.partitionBy("doc_id", "head").orderBy("page"))
    runs = pages.withColumn("run", F.col("page") - row).groupBy("doc_id", "head", "run").agg(F.max("sure").alias("sure"), F.count("*").alias("n"))
    heads = runs.groupBy("doc_id", "head").agg(F.max("sure").alias("sure"), F.sum("n").alias("n"), F.max("n").alias("longest"))
    return heads.join(n_pages, "doc_id").filter("sure or longest >= 3 or (n >= 2 and 4 * n >= n_pages)").select("doc_id", "head")


Mark = tuple[str, str, str]


def _each_record(marks: Callable[[str, set[int]], Iterator[Mark]], *more: str) -> Callable:
    """A function for mapInArrow: rows (doc_id, rec_key, noise, key, fix) of the marks of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take: list[int] = []
            out: tuple[list, ...] = ([], [], [], [])
            for i, (k, t, p, *rest) in enumerate(zip(*(b.column(c).to_pylist() for c in ("rec_key", "text", "pages", *more)), strict=True)):
                for mark in marks(t, set(p or ()), *rest):
                    take.append(i)
                    for col, x in zip(out, (k, *mark), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(take, pa.int64())), *(pa.array(x, pa.string()) for x in out)], ["doc_id", "rec_key", "noise", "key", "fix"])

    return run


_MARKS = "doc_id long, rec_key string, noise string, key string, fix string"


def _words(text: str) -> set[str]:
    return set(_WORD.findall(prose(text)))


def noise_marks(records: DataFrame, blocks: DataFrame) -> DataFrame:
    """rec_key, noise, key, fix: what was found in each record, and what is to stand there instead.

    glyph: the word and the printed word; hyphen: the two parts and the whole word; running_head: the header's
    line_shape; page_no: empty. records must be written or cached, as several passes go over it.
    """
    spark = records.sparkSession
    vocab = written(vocabulary(records), "vocabulary")
    words = vocab.filter("kind = 'w' and not contains(key, '-')").select(F.col("key").alias("word"), "n")
    glyphs = misread_words(words).select(F.lit("glyph").alias("noise"), F.col("word").alias("key"), F.col("printed").alias("fix"))
    wrong = cut(glyphs.unionByName(cut_decisions(vocab).select(F.lit("hyphen").alias("noise"), F.col("pair").alias("key"), F.col("whole").alias("fix"))))
    if wrong.count() <= SET_LIMIT:
        rows = wrong.collect()
        known = spark.sparkContext.broadcast(tuple({r[1]: r[2] for r in rows if r[0] == noise} for noise in ("hyphen", "glyph")))

        def marks(text: str, pages: set[int]) -> Iterator[Mark]:
            cut_pairs, misread = known.value
            for pair in {f"{a} {b}" for a, b in cut_words(text)}:
                if fix := cut_pairs.get(pair):
                    yield "hyphen", pair, fix
            for w in _words(text) & misread.keys():
                yield "glyph", w, misread[w]
            yield from page_marks(text, pages)

        inside = records.mapInArrow(_each_record(marks), _MARKS)
    else:

        def marks(text: str, pages: set[int]) -> Iterator[Mark]:
            yield from (("hyphen", f"{a} {b}", "") for a, b in set(cut_words(text)))
            yield from (("glyph", x, "") for x in _words(text) if could_be_misread(x))
            yield from page_marks(text, pages)

        rows = records.mapInArrow(_each_record(marks), _MARKS)
        inside = rows.filter("noise in ('hyphen', 'glyph')").drop("fix").join(wrong, ["noise", "key"]).select("doc_id", "rec_key", "noise", "key", "fix").unionByName(rows.filter("noise not in ('hyphen', 'glyph')"))
    inside = written(inside, "scan_marks")

    asked = inside.filter("noise = 'number'").select("doc_id", "rec_key", F.col("key").alias("kind"), F.explode(F.from_json("fix", "array<struct<page int, number int>>")).alias("x")).select("doc_id", "rec_key", "kind", "x.*")
    shifted = asked.withColumn("shift", F.col("number") - F.col("page")).join(page_sequences(asked), ["doc_id", "kind", "shift"], "left_semi")
    numbers = shifted.select("doc_id", "rec_key", F.lit("page_no").alias("noise"), F.col("number").cast("string").alias("key"), F.lit("").alias("fix"))
    found = inside.filter("noise <> 'number'").unionByName(numbers)

    def heads(text: str, pages: set[int], names: list[str]) -> Iterator[Mark]:
        for head in heads_within(text, names):
            running, number = header_in(text, head, pages)
            if running:
                yield "running_head", head, ""
            if number:
                yield "page_no", "", ""

    hot = hot_keys(records.select("doc_id"), "doc_id")
    joined = salted_join(records, head_groups(header_lines(blocks)), "doc_id", "inner", hot=hot)
    return found.unionByName(joined.select("doc_id", "rec_key", "text", "pages", "heads").mapInArrow(_each_record(heads, "heads"), _MARKS)).drop("doc_id")


def page_marks(text: str, pages: set[int]) -> Iterator[Mark]:
    """A mark if the text holds the number of its page, and one per kind with its other numbers that stand alone and its pages."""
    if page_number_in(text, pages):
        yield "page_no", "", ""
    by: dict[str, list[dict]] = {}
    for kind, n in numbers_alone(text) if pages else ():
        by.setdefault(kind, []).extend({"page": p, "number": n} for p in pages if kind == "r" or n != p)
    for kind, pairs in by.items():
        if pairs:
            yield "number", kind, json.dumps(pairs)


#: Header lines of a document that go with its records in one row; a document with more of them gets more rows.
HEADS_A_ROW = 256


def head_groups(heads: DataFrame) -> DataFrame:
    """doc_id, heads: the header lines of each document in groups, so that its records meet few rows and each row stays small."""
    n = heads.groupBy("doc_id").agg(F.ceil(F.count("*") / HEADS_A_ROW).alias("n_groups"))
    return heads.join(n, "doc_id").groupBy("doc_id", F.pmod(F.xxhash64("head"), F.col("n_groups")).alias("group")).agg(F.collect_list("head").alias("heads")).select("doc_id", "heads")


@lru_cache(maxsize=64)
def _heads_by_token(names: tuple[str, ...]) -> tuple[dict[str, list[str]], list[str]]:
    by: dict[str, list[str]] = {}
    for h in names:
        by.setdefault(h.split(" ")[0], []).append(h)
    return by, [h for h in names if _HAN.search(h)]


def heads_within(text: str, names: list[str]) -> list[str]:
    """The header lines whose first token the text has; Chinese ones stand without blanks and are all tried."""
    by, han = _heads_by_token(tuple(names))
    if "<|txt_" in text:
        text = text.replace("<|txt_split|>", " ").replace("<|txt_contd|>", " ")
    return [*(h for t in {*map(token_shape, text.split())} & by.keys() for h in by[t] if h not in han), *han]


def noisy_records(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """rec_key, noise (hyphen, glyph, running_head, page_no): a row per record and kind, repeated rows once.

    Null and blank texts have no noise. A block without a page can hold page numbers only in a marked form.
    """
    records = written(scan_records(blocks, trees), "scan_records")
    return noise_marks(records, blocks).select("rec_key", "noise").distinct()


_PARAGRAPH = re.compile(r"\n\s*\n")


def _without_head(line: str, want: list[str]) -> str:
    """The line without a header that stands inside it, and without the sign and number after that."""
    tokens = line.split()
    shapes = [token_shape(t) for t in tokens]
    at = next((i for i in range(len(shapes) - len(want) + 1) if shapes[i : i + len(want)] == want), -1)
    if at < 0:
        return line
    end = at + len(want)
    if end + 1 < len(tokens) and tokens[end] in ("|", "·", "•") and tokens[end + 1].isdigit():
        end += 2
    return " ".join(tokens[:at] + tokens[end:])


def _without_page(line: str, pages: set[int]) -> str:
    return PAGE_INSIDE.sub(lambda m: m[0] if int(m["n"] or m["n2"]) not in pages or _REFERENCE.search(line[: m.start()]) else "", line)


def repair(text: str, fixes: dict[tuple[str, str], str], pages: set[int]) -> str:
    """The text with header and page-number lines taken out, words made whole and read right, lines joined.

    A blank line ends a paragraph, unless only a header or page number stood between its two parts.
    """
    pages = pages | {int(k) for n, k in fixes if n == "page_no" and k}  # numbers of a sequence, at any offset from the page
    heads = [k for n, k in fixes if n == "running_head"]
    has_page = any(n == "page_no" for n, _ in fixes)
    lines: list[str] = []
    gap = False
    for line in re.split(r"\r\n|[\n\r]", text):
        s = line_shape(line) if heads else ""
        if s and s in heads or PAGE_LINE.match(line) and page_number_in(line, pages) or (m := _ROMAN_LINE.match(line)) and has_page and roman(m[1]) in pages:
            while lines and not lines[-1].strip():
                lines.pop()
            gap = True
            continue
        if gap and not line.strip():
            continue
        gap = False
        for head in heads:
            line = _without_head(line, head.split(" "))
        lines.append(_without_page(line, pages) if has_page else line)
    text = "\n".join(lines)
    text = _replace_cuts(text, lambda a, b, both: fixes.get(("hyphen", f"{a} {b}")) or (f"{a}-{b}" if "\n" in both else both))
    words = {k: f for (n, k), f in fixes.items() if n == "glyph"}
    if words:
        text = _WORD.sub(lambda m: words.get(m[0], m[0]), text)
    return "\n\n".join(" ".join(p.split()) for p in _PARAGRAPH.split(text))


def repaired(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """rec_key, text: every text record as continuous paragraphs; records without noise only get their lines joined."""
    records = written(scan_records(blocks, trees), "scan_records")
    fixes = noise_marks(records, blocks).groupBy("rec_key").agg(F.collect_set(F.struct("noise", "key", "fix")).alias("fixes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [repair(t, {(f["noise"], f["key"]): f["fix"] for f in fx or ()}, set(p or ())) for t, p, fx in zip(*(b.column(c).to_pylist() for c in ("text", "pages", "fixes")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("rec_key"), pa.array(texts, pa.string())], ["rec_key", "text"])

    return records.dropDuplicates(["rec_key"]).join(fixes, "rec_key", "left").select("rec_key", "text", "pages", "fixes").mapInArrow(run, "rec_key string, text string")
