"""Problem 5: residue of HTML, Markdown, wiki text and LaTeX in running text.

A record is read once into nodes: each piece of text with the path of the markup around it
("html/p/a", "wiki/template", "latex/itemize/item"). Over all records, each path's text length and punctuation
per node are summed. Ratios are smoothed twice: along the text, as a node that goes on a sentence of its line counts with the
line's text on both sides, and along the paths, as a rare path is drawn towards the same markup elsewhere or the path above.
The two are fused, and paths below a threshold are residue, the others content: so comments, templates, categories and
references fall, bold words, links and entities stay, without a list of either. Headings, lists, code, tables and formulas are
structure and keep their text, so that they stay recognisable by their kind.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from html.entities import html5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Element names of HTML.
HTML_TAGS = """
a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del div dl dt em
figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main
mark meta nav ol option p pre q s samp script section select small span strike strong style sub sup svg table tbody td
textarea tfoot th thead time title tr tt u ul var video
""".split()
_BREAKS = {"p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "pre", "blockquote", "hr", "section", "article"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "col"}
#: Kinds that keep their text whatever their path's ratio.
STRUCTURE = ("heading", "item", "code", "cell", "link", "formula")
_KIND_OF_TAG = {"li": "item", "pre": "code", "code": "code", "td": "cell", "th": "cell", "a": "link", "title": "heading"} | {f"h{i}": "heading" for i in range(1, 7)}
_KIND_OF_COMMAND = {"section": "heading", "subsection": "heading", "subsubsection": "heading", "chapter": "heading", "paragraph": "heading", "title": "heading", "texttt": "code", "item": "item", "href": "link", "url": "link"}
_KIND_OF_ENVIRONMENT = {"itemize": "item", "enumerate": "item", "description": "item", "verbatim": "code", "lstlisting": "code", "equation": "formula", "align": "formula", "displaymath": "formula", "math": "formula"}
#: LaTeX commands whose argument is a reference, no text.
_REFERENCES = {"cite", "ref", "label", "citep", "citet", "eqref", "pageref", "includegraphics", "usepackage", "documentclass", "input", "bibliography"}

_SEGMENT = re.compile(r"<\|txt_(?:split|contd)\|>")
#: A cheap test that a text may hold markup; everything the grammar below starts with is in it.
MAYBE = r"[<&\\$#*_`\[{=|>]|''|~~|(?m:^[ \t]*[-+][ \t])|(?m:^-{3,}\s*$)"
_RAW_FORMULA = re.compile(r"\\(?:frac|sum|int|prod|leq|geq|sqrt|cdot|times|alpha|beta|gamma|lim|infty)(?![a-zA-Z])|[_^]\{")
_PROSE_WORD = re.compile(r"(?<![\\a-zA-Z])[^\W\d_]{4,}|[。，]")
_NAMES = "|".join(sorted(HTML_TAGS, key=len, reverse=True))
_GRAMMAR = re.compile(
    rf"""
    (?P<html_comment><!--.*?-->)
  | (?P<html_tag><(?P<close>/?)(?P<tag>{_NAMES})(?:\s+[^<>]*|\s*)/?>)
  | (?P<html_entity>&(?:\#\d{{2,6}}|\#[xX][0-9a-fA-F]{{2,5}}|[a-zA-Z][a-zA-Z0-9]{{1,30}});)
  | (?P<md_fence>^```[^\n`]*\n(?P<fence>.*?)\n?^```[ \t]*$)
  | (?P<latex_env>\\begin\{{(?P<env>[a-zA-Z]+)\*?\}}(?:\[[^\]]*\])?(?P<env_in>.*?)\\end\{{(?P=env)\*?\}})
  | (?P<latex_half>\\(?:begin|end)\{{[a-zA-Z]+\*?\}})
  | (?P<latex_math>\\\[(?P<m1>.+?)\\\]|\\\((?P<m2>.+?)\\\)|\$\$(?P<m3>[^$]+)\$\$|\$(?P<m4>[^$\n]*[\\^_{{][^$\n]*)\$)
  | (?P<latex_command>(?<![\w:\\])\\(?P<cmd>[a-zA-Z]+)\*?(?:\[[^\]\n]*\])?\{{(?P<arg>(?:[^{{}}]|\{{[^{{}}]*\}})*)\}}|~\\(?P<cmd3>[a-zA-Z]+)\{{(?P<arg3>[^{{}}]*)\}})
  | (?P<latex_word>(?<![\w:\\])\\(?P<cmd2>item|leq|geq|sum|int|prod|cdot|times|ldots|dots|quad|noindent|newline|newpage|maketitle|centering|par|\\)(?![a-zA-Z\\]))
  | (?P<wiki_table>^\{{\|(?P<wt>.*?)^\|\}})
  | (?P<wiki_template>\{{\{{(?P<tpl>[^{{}}]*)\}}\}})
  | (?P<wiki_link>\[\[(?P<wl>[^\[\]\n]+)\]\])
  | (?P<wiki_heading>^(?P<eq>={{2,6}})[ \t]*(?P<wh>[^=\n]+?)[ \t]*(?P=eq)[ \t]*\r?$)
  | (?P<wiki_quote>(?<![\d'])(?P<q>'{{2,3}})(?=[^\s'])(?P<wq>(?:(?!'')[^\n])+?)(?<=\S)(?P=q)(?!'))
  | (?P<wiki_magic>(?<!\w)__[A-Z]+__(?!\w))
  | (?P<md_heading>^[ ]{{0,3}}(?P<hash>\#{{1,6}})[ \t]+(?P<mh>\S[^\n]*)$)
  | (?P<md_setext>^(?P<ms>(?=[^\n]*?\w)[^\n]++)\n(?:={{3,}}|-{{3,}})[ \t]*\r?$)
  | (?P<md_table>(?:^\|[^\n]*\|[ \t]*\r?\n)^\|[ :|-]*-[ :|-]*\|[ \t]*\r?(?:\n\|[^\n]*\|[ \t]*\r?$)*)
  | (?P<md_image>!\[(?P<alt>[^\[\]\n]*)\]\([^()\s]+(?:[ ]"[^"\n]*")?\))
  | (?P<md_link>(?<!!)\[(?P<lt>[^\[\]\n]+)\]\((?P<lu>[^()\s]+)(?:[ ]"[^"\n]*")?\))
  | (?P<md_code>(?<!`)`(?P<mc>[^`\n]+)`(?!`))
  | (?P<md_bold>\*\*(?=[^\s*])(?P<mb>[^*]+?)(?<=\S)\*\*)
  | (?P<md_em>(?<![\w*])\*(?=[^\s*])(?P<me>[^*\n]+?)(?<=\S)\*(?![\w*])|(?<![\w_])_(?=[^\s_])(?P<me2>[^_\n]+?)(?<=\S)_(?![\w_]))
  | (?P<md_strike>~~(?=\S)(?P<mz>[^~\n]+)~~)
  | (?P<md_quote>^[ ]{{0,3}}>[ \t]+(?=\S))
  | (?P<md_item>^[ \t]*[-*+][ \t]+(?!\d{{1,6}}[ \t]*[-–—][ \t]*$)(?=\S))
    """,
    re.VERBOSE | re.MULTILINE | re.DOTALL | re.IGNORECASE,
)
#: Where the grammar can start; it is tried there only.
_START = re.compile(r"[<&\\$*_`{\[~]|!\[|''|^[ \t]*+[#>=|+*-]", re.MULTILINE)
_START_UNDERLINED = re.compile(_START.pattern + r"|^(?=[^\n]++\n(?:={3,}|-{3,})[ \t]*\r?$)", re.MULTILINE)
_PUNCT_MARKS = ".,;:!?。，；：！？"
_PUNCT = re.compile(f"[{_PUNCT_MARKS}]")


_RULES = {k for k in _GRAMMAR.groupindex if k.startswith(("html_", "md_", "latex_", "wiki_"))}


@dataclass
class Node:
    path: str
    kind: str  # text, a kind of STRUCTURE, or residue
    text: str


def _kind(path: str) -> str:
    last = path.rpartition("/")[2]
    return last if last in STRUCTURE else "text"


class _Reader:
    def __init__(self) -> None:
        self.nodes: list[Node] = []

    def put(self, path: str, text: str, kind: str = "") -> None:
        if text or kind == "mark":
            self.nodes.append(Node(path, kind or "text", text))

    def read(self, text: str, path: str, kind: str) -> None:
        at = look = 0
        tags: list[str] = []
        find = (_START_UNDERLINED if "\n==" in text or "\n--" in text else _START).search

        def place() -> tuple[str, str]:
            return "/".join([path, "html", *tags]) if tags else path, next((_KIND_OF_TAG[t] for t in reversed(tags) if t in _KIND_OF_TAG), kind)

        while start := find(text, look):
            m = _GRAMMAR.match(text, start.start())
            which = m and next(k for k, v in m.groupdict().items() if v is not None and k in _RULES)
            here, now = place()
            step = m and self.step(which, m, here, now, tags)
            if not step:  # no markup after all
                look = start.start() + 1
                continue
            self.put(here, text[at : m.start()], now)
            step()
            at = look = m.end()
        here, now = place()
        self.put(here, text[at:], now)

    def step(self, which: str, m: re.Match, path: str, kind: str, tags: list[str]):
        def inner(text: str, name: str, new: str = ""):
            return lambda: self.read(text, f"{path}/{name}", new or kind)

        def leaf(text: str, name: str, new: str):
            return lambda: self.put(f"{path}/{name}", text, new)

        if which == "html_comment":
            return leaf(m[0], "html/comment", "residue")
        if which == "html_tag":
            return lambda: self.tag(m, path, tags)
        if which == "html_entity":
            return leaf(unescape(m[0]).replace("\xa0", " "), "html/entity", kind) if m[0][1] == "#" or m[0][1:] in html5 else None
        if which == "md_fence":
            return leaf(m["fence"], "markdown/fence", "code")
        if which == "latex_env":
            env = m["env"]
            new = _KIND_OF_ENVIRONMENT.get(env, kind)
            return leaf(m["env_in"].strip("\n"), f"latex/{env}", new) if new in ("code", "formula") else inner(m["env_in"], f"latex/{env}", new)
        if which == "latex_half":
            return leaf("", "latex/environment", "mark")
        if which == "latex_math":
            return leaf(next(x for x in (m["m1"], m["m2"], m["m3"], m["m4"]) if x).strip(), "latex/math", "formula")
        if which == "latex_command":
            name, arg = (m["cmd"], m["arg"]) if m["cmd"] else (m["cmd3"], m["arg3"])
            if name in _REFERENCES:
                return leaf(arg, f"latex/{name}", "residue")
            if name in ("frac", "sqrt", "sum", "int"):
                return leaf(m[0], "latex/raw", "formula")
            return inner(arg, f"latex/{name}", _KIND_OF_COMMAND.get(name, ""))
        if which == "latex_word":
            return leaf("\n• " if m["cmd2"] == "item" else "\n" if m["cmd2"] in ("\\", "newline", "par") else m[0], f"latex/{m['cmd2']}", "mark" if m["cmd2"] in ("item", "\\", "newline", "par") else "formula")
        if which == "wiki_table":
            cells = [c.strip() for row in re.split(r"^\|-.*$", m["wt"], flags=re.MULTILINE)[1:] or [m["wt"]] for c in re.split(r"\|\||!!|^[|!]", row, flags=re.MULTILINE)]
            return lambda: [self.put(f"{path}/wiki/table", c, "cell") for c in cells if c]
        if which == "wiki_template":
            return leaf(m["tpl"], "wiki/template", "residue")
        if which == "wiki_link":
            target, _, label = m["wl"].partition("|")
            return leaf(m["wl"], "wiki/category", "residue") if re.match(r"(?i)(category|file|image|kategorie|catégorie|categoría|категория|分类)\s*:", target) else leaf(label or target, "wiki/link", "link")
        if which == "wiki_heading":
            return leaf(m["wh"], "wiki/heading", "heading")
        if which == "wiki_quote":
            return inner(m["wq"], "wiki/quote")
        if which == "wiki_magic":
            return leaf(m[0], "wiki/magic", "residue")
        if which == "md_heading":
            return inner(m["mh"], "markdown/heading", "heading")
        if which == "md_setext":
            return inner(m["ms"], "markdown/heading", "heading") if "|" not in m["ms"] else None
        if which == "md_table":
            cells = [c.strip() for i, row in enumerate(m[0].splitlines()) if i != 1 for c in row.strip().strip("|").split("|")]
            return lambda: [self.put(f"{path}/markdown/table", c, "cell") for c in cells if c]
        if which == "md_image":
            return leaf(m["alt"], "markdown/image", "residue")
        if which == "md_link":
            return inner(m["lt"], "markdown/link", "link")
        if which == "md_code":
            return inner(m["mc"], "markdown/code", "code")
        if which in ("md_bold", "md_em", "md_strike"):
            return inner(next(x for x in (m["mb"], m["me"], m["me2"], m["mz"]) if x), "markdown/emphasis")
        return leaf("\n• " if which == "md_item" else "\n", "markdown/" + which[3:], "mark")

    def tag(self, m: re.Match, path: str, tags: list[str]) -> None:
        name = m["tag"].lower()
        self.put(f"{path}/html/{name}" if not tags else f"{path}/{name}", "\n• " if name == "li" and not m["close"] else "\n" if name in _BREAKS else "\t" if name in ("td", "th") else "", "mark")
        if m["close"]:
            while name in tags and tags.pop() != name:
                pass
        elif name not in _VOID and not m[0].endswith("/>"):
            if name in ("li", "p") and name in tags:  # these need no end tag
                while tags.pop() != name:
                    pass
            tags.append(name)


def read_nodes(text: str) -> list[Node]:
    """The nodes of a text in reading order; paths of plain text are "text"."""
    reader = _Reader()
    for i, part in enumerate(_SEGMENT.split(text)):
        if i:
            reader.put("text", "\n\n", "mark")
        if _RAW_FORMULA.search(part) and not _PROSE_WORD.search(part) and "$" not in part and "\n" not in part.strip():
            reader.put("text/latex/raw", part.strip().strip("$"), "formula")
        else:
            reader.read(part, "text", "text")
    return reader.nodes


_FORMATS = ("html", "markdown", "wiki", "latex")


def formats(nodes: list[Node]) -> set[str]:
    return {f for n in nodes for f in n.path.split("/") if f in _FORMATS}


def clean_text(nodes: list[Node], residue: set[str], scored: set[str] = frozenset()) -> str:
    """The content nodes' text. Paths in residue go; where a path was not scored, the kind that the grammar gives decides. Headings stand in a line of their own after "# ", items after "• ", code between
    lines of ```; cells are parted by tabs, formulas stand in $ $."""
    out: list[str] = []
    before = ""
    for n in nodes:
        if n.kind not in (*STRUCTURE, "mark") and (n.path in residue or (n.kind == "residue" and n.path not in scored)):
            continue
        t = n.text
        if n.kind == "heading" and t.strip():
            t = t if before == "heading" else "\n# " + t.strip()
        elif n.kind == "code" and t.strip():
            t = f"\n```\n{t}\n```\n" if "\n" in t or "fence" in n.path or "verbatim" in n.path or "pre" in n.path else f"`{t}`"
        elif n.kind == "cell":
            t = ("\t" if before == "cell" else "\n") + t
        elif n.kind == "formula":
            t = f"${t}$"
        elif before in ("heading", "cell") and n.kind == "text" and t.strip():
            t = "\n" + t.lstrip()
        if t == "\n• " and (not out or out[-1].endswith("\n")):
            t = "• "
        out.append(t)
        if t.strip():
            before = n.kind
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", "".join(out))).strip()


_ENDS = ".!?:。！？："


def spans(nodes: list[Node]) -> Iterator[tuple[str, int, int]]:
    """path, characters and punctuation of each node with text; a node that goes on a sentence counts with the rest of its line."""
    whole = "".join(n.text for n in nodes)
    at = 0
    for n in nodes:
        begin, at = at, at + len(n.text)
        if n.kind == "mark" or (n.text.isspace() and "\n" in n.text):
            continue
        left = whole.rfind("\n", 0, begin) + 1
        before = whole[left:begin].rstrip()
        if before and before[-1] not in _ENDS and before[-1] != "•":
            right = whole.find("\n", at)
            line = whole[left : len(whole) if right < 0 else right]
            yield n.path, max(len(line), len(n.text)), len(_PUNCT.findall(line))
        else:
            yield n.path, len(n.text), len(_PUNCT.findall(n.text))


def path_ratios(nodes: DataFrame) -> DataFrame:
    """path, n_nodes, text_ratio, punct_ratio: sums over all nodes (rec_key, path, kind, text), per path."""
    return nodes.groupBy("path").agg(F.sum("n").alias("n_nodes"), F.sum("chars").alias("chars"), F.sum("punct").alias("punct")).select("path", "n_nodes", (F.col("chars") / F.col("n_nodes")).alias("text_ratio"), (F.col("punct") / F.col("n_nodes")).alias("punct_ratio"))


def path_counts(records: DataFrame) -> DataFrame:
    """path, n, chars, punct of all records (text), combined per task.

    A record without markup is one node "text"; its numbers are taken in the JVM, and its text stays there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
        for b in batches:
            plain = [pc.sum(b.column(c)).as_py() or 0 for c in ("n", "chars", "punct")]
            if plain[0]:
                sums["text"] = [x + y for x, y in zip(sums["text"], plain, strict=True)]
            for t in pc.drop_null(b.column("text")).to_pylist():
                for path, chars, punct in spans(read_nodes(t)):
                    s = sums[path]
                    s[0] += 1
                    s[1] += chars
                    s[2] += punct
        yield pa.RecordBatch.from_pydict({"path": pa.array(list(sums), pa.string()), **{c: pa.array([v[i] for v in sums.values()], pa.int64()) for i, c in enumerate(("n", "chars", "punct"))}})

    text, plain = F.col("text"), ~maybe() & (F.col("text") != "")
    signs = F.length(text) - F.length(F.translate(text, _PUNCT_MARKS, ""))
    src = records.select(F.when(maybe(), text).alias("text"), *[F.when(plain, x).cast("long").alias(c) for c, x in (("n", F.lit(1)), ("chars", F.length(text)), ("punct", signs))])
    return src.mapInArrow(run, "path string, n long, chars long, punct long")


def scored_paths(ratios: DataFrame, weight: float = 5.0, cutoff: float = 1.0) -> DataFrame:
    """path, score, content: smoothed and fused ratios, and whether the path is content.

    Smoothing draws a path with few nodes towards another one that has nodes: the same markup under less other markup
    (html/p/latex/ref towards latex/ref), else the nearest path above it: (n * own + weight * other) / (n + weight).
    The score is the geometric mean of text and punctuation ratio; paths below cutoff deviations of all
    scores are residue. Plain text is content in any case.
    """
    names = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(names) - 1), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(names, 1, i), "/").alias("parent")))
    tails = F.transform(F.sequence(F.lit(2), F.greatest(F.size(names) - 2, F.lit(2))), lambda i: F.struct((F.lit(1000) - i).alias("depth"), F.concat(F.lit("text/"), F.array_join(F.slice(names, i + 1, F.size(names)), "/")).alias("parent")))
    above = F.when(F.size(names) > 3, F.concat(above, tails)).otherwise(above)
    up = ratios.select(F.col("path").alias("parent"), F.col("text_ratio").alias("pt"), F.col("punct_ratio").alias("pp"))
    near = ratios.select("path", F.explode(above).alias("a")).select("path", "a.*").join(up, "parent").groupBy("path").agg(F.max_by(F.struct("pt", "pp"), "depth").alias("up"))
    s = ratios.join(near, "path", "left").select("*", "up.*")
    mix = lambda a, b: (F.col("n_nodes") * F.col(a) + F.lit(weight) * F.coalesce(b, a)) / (F.col("n_nodes") + weight)
    s = s.select("path", "n_nodes", F.sqrt(mix("text_ratio", "pt") * (1 + mix("punct_ratio", "pp"))).alias("score"))
    spread = s.agg(F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("spread"))
    return s.crossJoin(F.broadcast(spread)).select("path", "n_nodes", "score", ((F.col("score") >= cutoff * F.col("spread")) | (F.col("path") == "text")).alias("content"))


def maybe() -> Column:
    """Whether the column text may hold markup; if not, the record is one node "text"."""
    return F.col("text").rlike(MAYBE)


def marked_up(records: DataFrame) -> DataFrame:
    """Records (rec_key, text) that may hold markup; null and empty texts do not."""
    return records.filter(maybe())


def markup_formats(records: DataFrame) -> DataFrame:
    """rec_key, markup: a row per record and format found among its nodes' paths; repeated records count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found = [], []
            for k, t in zip(b.column("rec_key").to_pylist(), b.column("text").to_pylist(), strict=True):
                for f in formats(read_nodes(t)):
                    keys.append(k)
                    found.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], ["rec_key", "markup"])

    return marked_up(records).select("rec_key", "text").mapInArrow(run, "rec_key string, markup string").distinct()


def cleaned(records: DataFrame) -> DataFrame:
    """rec_key, clean: the clean text of every record with a text; one without markup comes back as it is.

    The residue paths are a set of path names, bounded by the grammar's nesting, not by the number of records.
    """
    paths = scored_paths(path_ratios(path_counts(records))).select("path", "content").collect()
    residue, scored = {r[0] for r in paths if not r[1]}, {r[0] for r in paths}

    def clean(text: str) -> str:
        nodes = read_nodes(text)
        return text if [n.path for n in nodes] == ["text"] else clean_text(nodes, residue, scored)

    @F.arrow_udf("string")
    def _clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else clean(t) for t in texts.to_pylist()], pa.string())

    # a text without markup is no argument, so it does not travel to Python
    out = records.filter("text <> ''").select("rec_key", F.coalesce(_clean(F.when(maybe(), F.col("text"))), "text").alias("clean"))
    return out.dropDuplicates(["rec_key"])


def count_formats(texts: Iterator[str]) -> Counter:
    return Counter(f for t in texts for f in formats(read_nodes(t)))
