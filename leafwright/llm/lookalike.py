"""Problem 1: one consistent form for text that reads the same but differs in its characters.

Each token's letters are looked up in classes of look-alike letters. A letter's resolved scripts are the
scripts in which its class has a spelling; their intersection over the token gives the scripts the whole
token can be spelled in. One script: the token is respelled in it (a mixed-script token loses its foreign
letters). Several: it is a whole-script confusable and takes the script of the text's unambiguous letters,
which are the same in every variant. None: each letter takes its class's first spelling.
Invisible characters go, spaces become plain, wide, ligature and radical forms become plain, accents are
composed. Case, accents, raised and circled digits stay, as a reader sees them.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.runtime import written

SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian")
#: Letters that look alike, one class per entry, spelled in the order of SCRIPTS; "." where a script has none.
LETTER_CLASSES = """
aаα. cсϲ. dԁ.. eе.. g..ց hһ.հ iіι. jјϳ. lӏ.. n..ո oоοօ pрρ. qԛ.. sѕ.. u.υս vѵν. wԝ.. xх.. yуγ.
AАΑ. BВΒ. CСϹ. EЕΕ. GԌ.. HНΗ. IІΙ. JЈͿ. KКΚ. LᏞ.Լ MМΜ. N.Ν. OОΟՕ PРΡ. QԚ.. SЅ.Տ TТΤ. U..Ս WԜ.. XХΧ. YУΥ. Z.Ζ.
.ГΓ. .ПΠ. .ФΦ. .кκ.
""".split()
#: Second spellings of a letter within one script.
SAME_SCRIPT = {"ɑ": "a", "ɡ": "g", "Ү": "У", "Ӏ": "І", "ĸ": "к"}
#: Blocks whose compatibility forms look like the plain ones (ligatures, digraphs, Roman numerals, radicals, dots).
_COMPAT_LOOKS_SAME = ((0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2024, 0x2026), (0x2160, 0x217F), (0x2E80, 0x2FD5), (0xFB00, 0xFB17), (0xFE70, 0xFEFC))
_KINDS_LOOK_SAME = ("<wide>", "<narrow>", "<noBreak>")

_CLASS_OF: dict[str, dict[str, str]] = {}
for _c in LETTER_CLASSES:
    _spell = {s: ch for s, ch in zip(SCRIPTS, _c, strict=True) if ch != "."}
    for _ch in _spell.values():
        _CLASS_OF[_ch] = _spell
for _ch, _as in SAME_SCRIPT.items():
    _CLASS_OF[_ch] = _CLASS_OF[_as]

_TOKEN = re.compile(r"[A-Za-zª-ɏɐ-ʯ̀-ԯԱ-ևḀ-῿]+")
_NEEDS_SCRIPTS = re.compile(r"[ɐ-ʯͰ-ևᎠ-᏿ἀ-῿]")
#: Characters that no step changes: composed Latin letters, printable ASCII, line ends, Han and its comma and stop.
_UNCHANGED = re.compile(r"[\n\r\x20-\x7e\u00a1-\u00a7\u00a9-\u00ac\u00ae\u00b0-\u00b3\u00b6\u00b7\u00b9\u00bb-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u2013\u2014\u2018\u2019\u201c\u201d\u3001\u3002\u4e00-\u9fff]*\Z")
_ASCII_CONTROLS = re.compile(r"[\x00-\x09\x0b\x0c\x0e-\x1f\x7f]")
_ROMAN = re.compile(r"[IVX]+\Z")


def script(ch: str) -> str | None:
    o = ord(ch)
    if o < 0x250 or 0x1E00 <= o < 0x1F00 or 0x250 <= o < 0x2B0:
        return "Latin" if ch.isalpha() else None
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "Greek"
    if 0x400 <= o < 0x530:
        return "Cyrillic"
    if 0x531 <= o < 0x588:
        return "Armenian"
    return None


class _Fold(dict):
    """Character table for str.translate, filled as characters turn up."""

    def __missing__(self, o: int) -> str | int:
        ch = chr(o)
        kind = unicodedata.category(ch)
        how = unicodedata.decomposition(ch)
        to: str | int = o
        if ch in "\n\r":
            to = o
        elif kind in ("Zs", "Zl", "Zp") or ch in "\t\v\f\x85":
            to = " "
        elif kind in ("Cf", "Cc") or o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF:
            to = ""
        elif o in (0x2010, 0x2011):
            to = "-"
        elif how.startswith(_KINDS_LOOK_SAME) or (how.startswith("<") and any(a <= o <= b for a, b in _COMPAT_LOOKS_SAME)):
            to = unicodedata.normalize("NFKC", ch)
        self[o] = to
        return to


_FOLD = _Fold()


def resolved_scripts(letters: str) -> set[str] | None:
    """Scripts in which the whole token can be spelled; None if it has no letter of these scripts."""
    out: set[str] | None = None
    for ch in letters:
        spell = _CLASS_OF.get(ch)
        own = set(spell) if spell else {s} if (s := script(ch)) else None
        if own is not None:
            out = own if out is None else out & own
    return out


@lru_cache(maxsize=200_000)
def respell(token: str, context: str) -> str:
    """The token in one script, see the module's text; token is decomposed, context the script of the text."""
    scripts = resolved_scripts(token)
    if scripts is None:
        return token
    if len(scripts) > 1 and "Latin" in scripts and _ROMAN.match("".join(_CLASS_OF[c]["Latin"] if c in _CLASS_OF and "Latin" in _CLASS_OF[c] else c for c in token)):
        to: str | None = "Latin"
    elif scripts:
        to = context if context in scripts else next(s for s in SCRIPTS if s in scripts)
    else:
        to = None
    out = []
    for ch in token:
        spell = _CLASS_OF.get(ch)
        own = spell is None or (script(ch) == to and to != "Latin")
        out.append(ch if own else spell[to] if to in spell else next(iter(spell.values())))
    return "".join(out)


def context_script(text: str) -> str:
    """The script of most letters that no other script has; Latin if there are none or as many."""
    n = Counter(s for ch, k in Counter(text).items() if ch not in _CLASS_OF and (s := script(ch)) for _ in range(k))
    return max(SCRIPTS, key=lambda s: (n[s], -SCRIPTS.index(s)))


def one_form(text: str | None, context: str | None = None) -> str | None:
    """The consistent form of a text; line breaks stay. None stays None, equal-looking texts become equal.

    context: the script for whole-script confusables, where it must not depend on the text around them.
    """
    if text is None:
        return text
    if text.isascii():
        return text if text.isprintable() or not _ASCII_CONTROLS.search(text) else text.translate(_FOLD)
    if _UNCHANGED.match(text):
        return text
    text = text.translate(_FOLD)
    if _NEEDS_SCRIPTS.search(text):
        text = unicodedata.normalize("NFD", text)
        to = context or context_script(text)
        text = _TOKEN.sub(lambda m: respell(m[0], to), text)
    return unicodedata.normalize("NFC", text)


def compare_form(text: str | None) -> str | None:
    """one_form with all white space as single spaces and none at the ends."""
    text = one_form(text)
    return None if text is None else " ".join(text.split())


@F.pandas_udf(T.StringType())
def _one_form(s: pd.Series) -> pd.Series:
    return s.map(one_form, na_action="ignore")


@F.pandas_udf(T.StringType())
def _compare_form(s: pd.Series) -> pd.Series:
    return s.map(compare_form, na_action="ignore")


def _skip_plain(udf, text: Column, plain: Column) -> Column:
    """The UDF gets only texts with other than printable ASCII characters; the rest stays in the JVM."""
    is_plain = text.rlike(r"^[\x20-\x7e]*$")
    return F.when(is_plain, plain).otherwise(udf(F.when(~is_plain, text)))


def one_form_column(text: Column) -> Column:
    return _skip_plain(_one_form, text, text)


def compare_form_column(text: Column) -> Column:
    return _skip_plain(_compare_form, text, F.trim(F.regexp_replace(text, " +", " ")))


def normalize_texts(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """df with the consistent form of a text column; null stays null, empty stays empty."""
    return df.withColumn(out, one_form_column(F.col(text)))


def same_look_classes(records: DataFrame) -> DataFrame:
    """doc_id, form, text, rec_key: membership of records in classes of equal stored texts, for every form of a document that is
    stored in two ways or more. One row per record, so a form that a third of all records have stays linear.

    Null texts and texts without a visible character are in no class, nor are records without a document or key;
    repeated rows of a record count once. Forms are computed once and written.
    """
    src = records.filter("text is not null and doc_id is not null and rec_key is not null").select("doc_id", "rec_key", "text")
    forms = written(src.withColumn("form", compare_form_column(F.col("text"))).filter("form <> ''"), "forms")
    wide = forms.groupBy("doc_id", "form").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).filter("lo <> hi").select("doc_id", "form")
    return forms.join(wide, ["doc_id", "form"], "left_semi").select("doc_id", "form", "text", "rec_key").distinct()


def same_look_pairs(records: DataFrame) -> DataFrame:
    """key_a, key_b of records (doc_id, rec_key, text) of one document that look the same but are stored differently.

    Texts are compared as classes of equal stored texts, so equal copies never meet each other: the work
    is the size of the result. Each class pair is expanded by its members; where forms are repeated very often,
    same_look_classes holds the same in one row per record.
    """
    members = written(same_look_classes(records), "form_members")
    classes = members.select("doc_id", "form", "text").distinct()
    pairs = classes.alias("a").join(classes.alias("b"), ["doc_id", "form"]).filter("a.text < b.text").select("doc_id", "form", F.col("a.text").alias("ta"), F.col("b.text").alias("tb"))
    left = members.select("doc_id", "form", F.col("text").alias("ta"), F.col("rec_key").alias("ka"))
    right = members.select("doc_id", "form", F.col("text").alias("tb"), F.col("rec_key").alias("kb"))
    out = pairs.join(left, ["doc_id", "form", "ta"]).join(right, ["doc_id", "form", "tb"])
    return out.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).filter("key_a <> key_b").distinct()


def mixed_script_tokens(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Tokens spelled in more than one script or respelled in another, with their form."""
    for t in texts:
        folded = unicodedata.normalize("NFD", t.translate(_FOLD))
        context = context_script(folded)
        for m in _TOKEN.finditer(folded):
            if (r := respell(m[0], context)) != m[0]:
                yield m[0], unicodedata.normalize("NFC", r)
