"""Column functions on text. Java patterns name their character classes, so that other engines can follow them."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What ends a sentence, what closes after it; the dots split sentences but end none.
TERMINATORS = ".。?!？！¿¡؟ฯ۔:：;；"
SPLITTERS = TERMINATORS + "…"
CLOSERS = "’”'\"）」】])"
#: White space as Unicode has it.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]"
#: Digits besides decimal ones: raised, lowered, circled, bracketed and dotted ones.
DIGIT = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}]"
_CJK = "一二三四五六七八九十百千万"
#: How list items begin.
LIST_PREFIXES = (
    r"\p{Nd}+[.)）．、]",
    r"[a-z][.)]",
    rf"[{_CJK}]+、",
    r"[①-⑳㉑-㉟]",
    r"[•▪▫]",
    r"[ivxlcdm]+\.",
    "-",
    r"\$",
    r"\\t",
    r"[\[(「【（]",
    rf"第[{_CJK}][条节章]",
)
LIST_ITEM = "(?i)^(?:" + "|".join(LIST_PREFIXES) + ")"
_TERMINATOR_CLASS = "[" + "".join("\\" + c if c in ".?" else c for c in SPLITTERS) + "]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def normalize_text(text: Column) -> Column:
    """Null becomes empty, all white space one space, none at the ends."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "))


def sentence_head(text: Column) -> Column:
    """Up to and with the first terminator; the whole text without one."""
    return strip(F.regexp_extract(text, rf"(?s)^(.*?{_TERMINATOR_CLASS}|.*)", 1))


def sentence_tail(text: Column) -> Column:
    """The last non-blank part between terminators; the text itself if there is none."""
    parts = F.filter(F.transform(F.split(text, _TERMINATOR_CLASS), strip), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1)).otherwise(strip(text))


def shortened(text: Column, most: int = 103, each: int = 50) -> Column:
    """Head and tail sentence; if that is longer than most, its ends."""
    head, tail = sentence_head(text), sentence_tail(text)
    both = F.when(head == tail, head).otherwise(F.concat(head, F.lit(" ... "), tail))
    return F.when(F.length(both) <= most, both).otherwise(F.concat(F.substring(both, 1, each), F.lit("..."), F.right(both, F.lit(each))))


def is_list_item(text: Column) -> Column:
    return text.rlike(LIST_ITEM)


def starts_with_digit(text: Column) -> Column:
    return text.rlike("^" + DIGIT)


def may_be_cut_off(text: Column) -> Column:
    """Whether a text may go on in a later one: long enough, no tab, no terminator at its end, nor before a closer."""
    t = strip(text)
    ends = F.right(t, F.lit(1))
    closed = (F.length(t) > 1) & F.lit(CLOSERS).contains(ends) & F.lit(TERMINATORS).contains(F.substring(F.right(t, F.lit(2)), 1, 1))
    return (text != "") & (F.length(text) >= 10) & ~F.contains(text, F.lit("\t")) & ~((t != "") & F.lit(TERMINATORS).contains(ends)) & ~closed


def may_go_on(text: Column) -> Column:
    """Whether a text may be the rest of an earlier one: not empty, no tab, no list item."""
    return (text != "") & ~F.contains(text, F.lit("\t")) & ~is_list_item(text)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def ends_with_hyphen(text: Column) -> Column:
    return text.rlike(r"[A-Za-z]+-\s*$")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^0-9A-Za-z_.-]+", "_")


def stem(name: Column) -> Column:
    """A file name without what follows its last dot, if anything stands before it."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
