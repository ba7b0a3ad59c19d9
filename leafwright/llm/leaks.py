"""Problem 7: passages of evaluation items inside corpus documents.

Words are hashed under spaced seeds: fixed masks over a window that ignore some positions, so that a window
with a replaced word still meets its copy under some mask. Test and corpus hashes are joined; around each hit
the two texts are laid side by side, and the overlap is verified with its substitutions and its longest
exact run. A mask's span is at most MIN_WORDS, so no exact run of MIN_WORDS words can be missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.llm.lookalike import one_form
from leafwright.runtime import salted_join, written

MIN_WORDS = 12
#: Spaced seeds: 1 = the word counts, 0 = it is ignored. Weight 8 in a span of 11.
MASKS = ("11101100111", "11011011011", "10111110101")
#: Test sets up to so many words are held by every executor; larger ones are joined by hash.
TABLE_LIMIT = 5_000_000

_BREAK = re.compile(r"(?<=\w)[-‐‑¬­]\s*(?=\w)")
_MARKS = re.compile(r"[^\w\s]+|_+")
_ASCII_MARKS = str.maketrans("", "", "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()))


def words(text: str | None) -> list[str]:
    """Words without case, signs, breaks and kinds of characters; a hyphen joins its two sides."""
    if not text:
        return []
    if text.isascii():
        if "-" in text:
            text = _BREAK.sub("", text)
        return text.translate(_ASCII_MARKS).lower().split()
    if "­" in text or "¬" in text:
        text = _BREAK.sub("", text)
    text = one_form(text, "Latin") or ""
    if "-" in text:
        text = _BREAK.sub("", text)
    return _MARKS.sub("", text.casefold()).split()


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


_FACTORS = np.random.default_rng(20240607).integers(1, 2**63, size=32, dtype=np.uint64) | np.uint64(1)


def seed_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each window start; ids are uint64, windows that do not fit are left out."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for o in _offsets(mask):
        out += ids[o : o + n] * _FACTORS[o]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class TestTable:
    """Words and seed hashes of all test items, for lookups inside a task."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.vocab: dict[str, int] = {}
        self.item_ids: list[int] = []
        self.item_words: list[np.ndarray] = []
        for item, text in items:
            w = words(text)
            if w:
                self.item_ids.append(item)
                self.item_words.append(np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w], np.uint64))
        self.seeds = []
        for mask in MASKS:
            h = [seed_hashes(w, mask) for w in self.item_words]
            flat = np.concatenate(h) if h else np.zeros(0, np.uint64)
            item = np.repeat(np.arange(len(h)), [len(x) for x in h])
            pos = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, int)
            order = np.argsort(flat, kind="stable")
            self.seeds.append((flat[order], item[order], pos[order]))

    def find(self, docs: list[list[str]]) -> Iterator[tuple[int, int, int, int, int]]:
        """document, item, longest exact run, overlap, substitutions: the best side-by-side place of each pair."""
        get = self.vocab.get
        ids = [np.fromiter((get(w, 0) for w in d), np.uint64, len(d)) for d in docs]
        starts = np.cumsum([0, *(len(x) + 1 for x in ids)])
        flat = np.zeros(int(starts[-1]) + 32, np.uint64)
        for s, x in zip(starts, ids, strict=False):
            flat[s : s + len(x)] = x
        known = flat > 0
        hits: set[tuple[int, int, int]] = set()
        for mask, (hashes, item, pos) in zip(MASKS, self.seeds, strict=True):
            n = len(flat) - len(mask) + 1
            if n <= 0 or not len(hashes):
                continue
            ok = np.ones(n, bool)
            for o in _offsets(mask):
                ok &= known[o : o + n]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for o in _offsets(mask):
                h += flat[at + o] * _FACTORS[o]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(hi > lo):
                doc = int(np.searchsorted(starts, at[i], "right")) - 1
                for k in range(lo[i], hi[i]):
                    hits.add((doc, int(item[k]), int(at[i] - starts[doc]) - int(pos[k])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, it, shift in hits:
            found = compare(ids[doc], self.item_words[it], shift)
            key = (doc, self.item_ids[it])
            if found > best.get(key, (0, 0, 0)):
                best[key] = found
        for (doc, it), found in best.items():
            yield doc, it, *found


def compare(doc: np.ndarray, item: np.ndarray, shift: int, rate: float = 0.2) -> tuple[int, int, int]:
    """Longest exact run, and length and substitutions of the longest overlap with at most `rate` substitutions, of
    doc and item laid side by side so that item[0] is at doc[shift]."""
    lo, hi = max(0, shift), min(len(doc), shift + len(item))
    same = (doc[lo:hi] == item[lo - shift : hi - shift]) & (doc[lo:hi] > 0)
    if not same.any():
        return 0, 0, 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    begins, ends = edge[::2], edge[1::2]
    run = int((ends - begins).max())
    # prefix sums of (rate - substitution): the longest stretch whose end is not below its start, from run to run
    score = np.concatenate(([0.0], np.cumsum(np.where(same, rate, rate - 1.0))))
    best, subs = 0, 0
    low_at = np.minimum.accumulate(score[begins])
    for e in ends:
        k = int(np.argmax(low_at <= score[e] + 1e-9))
        if low_at[k] <= score[e] + 1e-9 and e - begins[k] > best:
            best, subs = int(e - begins[k]), int((~same[begins[k] : e]).sum())
    return run, best, subs


_OUT = "doc_id long, item_id long, run int, overlap int, substitutions int"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 5
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "run", "overlap", "substitutions"])


def leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, table_limit: int = TABLE_LIMIT) -> DataFrame:
    """doc_id, item_id, run, overlap, substitutions of all pairs whose longest exact run has min_words words or more,
    or whose overlap with substitutions is twice as long.

    Items with fewer words than min_words, null texts and rows without an id are in no pair; every item that shares a passage counts;
    of repeated rows the best counts.
    """
    docs = documents.select(F.col("doc_id").cast("long"), "text").filter("text <> '' and doc_id is not null")
    tests = items.select(F.col("item_id").cast("long"), "text").filter("text <> '' and item_id is not null").distinct()
    size = tests.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    keep = (F.col("run") >= min_words) | (F.col("overlap") >= 2 * min_words)
    found = _by_table(docs, tests) if size <= table_limit else _by_join(docs, tests)
    best = F.max(F.struct("run", "overlap", "substitutions")).alias("b")
    return found.filter(keep).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def _by_table(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The test set is small by its checked size: each task looks its documents up in it."""
    table = docs.sparkSession.sparkContext.broadcast(TestTable([(r[0], r[1]) for r in tests.collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for at in range(0, len(ids), 2000):
                got = table.value.find([words(t) for t in texts[at : at + 2000]])
                yield _rows([(ids[at + d], i, *x) for d, i, *x in got])

    return docs.mapInArrow(run, _OUT)


def _word_id(w: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(w) | 1


def _by_join(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """Any size: hashes of both sides are joined, candidate pairs get their texts and are verified."""

    def seeds(key: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k, t in zip(b.column(key).to_pylist(), b.column("text").to_pylist(), strict=True):
                    ids = np.array([_word_id(w) for w in words(t)], np.uint64)
                    for m, mask in enumerate(MASKS):
                        h = np.unique(seed_hashes(ids, mask)).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k)), pa.array(np.full(len(h), m, np.int32)), pa.array(h)], [key, "mask", "hash"])

        return run

    seed = F.xxhash64("mask", "hash").alias("seed")  # boilerplate makes hot seeds, which are salted
    a = docs.mapInArrow(seeds("doc_id"), "doc_id long, mask int, hash long").select("doc_id", seed)
    b = tests.mapInArrow(seeds("item_id"), "item_id long, mask int, hash long").select("item_id", seed)
    pairs = salted_join(written(a, "leak_seeds"), b, "seed", "inner").select("doc_id", "item_id").distinct()
    both = pairs.join(docs, "doc_id").join(tests.withColumnRenamed("text", "item_text"), "item_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            tables: dict[int, TestTable] = {}
            for d, i, t, it in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "text", "item_text")), strict=True):
                if i not in tables:  # an item's table serves all its documents of the batch
                    tables[i] = TestTable([(i, it)])
                rows += [(d, i, *x) for _, _, *x in tables[i].find([words(t)])]
            yield _rows(rows)

    return both.select("doc_id", "item_id", "text", "item_text").mapInArrow(run, _OUT)
