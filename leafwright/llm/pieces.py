"""Problem 4: nodes longer than their limit, cut into pieces at natural boundaries by their content.

A rolling hash over the last characters marks landmarks; a cut goes to the natural boundary nearest to the first
landmark between the least and the greatest size. Landmarks and boundaries depend on the text around them only, so
after an edit the cuts fall into step again. Segments that fit stay whole and are put together up to a segment
whose own hash is a landmark; consecutive pieces of a segment that had to be cut share overlap characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = re.compile(r"<\|txt_(?:split|contd)\|>")
#: Natural boundaries, best first. A cut is after the match.
BOUNDARIES = (re.compile(r"\n\s*\n|</tr>|</table>|</p>|\\end\{\w+\}"), re.compile(r"[.!?。！？…][\"'”’)\]]*(?:\s+|(?<=[。！？…]))|\r?\n|</td>|</th>"), re.compile(r"[,;:，；：、]\s*|\s+"))
#: Characters that the rolling hash sees, and the mean distance of its landmarks as a part of the limit.
WINDOW, SPACING = 16, 4
#: A piece that is cut off is at least this part of the limit.
LEAST = 4

_GEAR = np.random.default_rng(11).integers(0, 2**63, size=4096, dtype=np.uint64)


def rolling_hash(text: str) -> np.ndarray:
    """For each position, a hash of the WINDOW characters before it (fewer at the start)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    g = _GEAR[(codes ^ (codes >> 12)) & 4095]
    out = np.zeros(len(g), np.uint64)
    for k in range(min(WINDOW, len(g))):
        out[k:] += g[: len(g) - k] * np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return out ^ (out >> np.uint64(31))


@dataclass
class Piece:
    text: str
    first: int  # segments from .. to
    last: int
    start: int  # characters within the first segment, where it was cut
    cut: bool


def _no_break(text: str, at: int) -> bool:
    return at < len(text) and (unicodedata.combining(text[at]) > 0 or text[at] in "‍️" or text[at - 1] == "‍")


def cut_points(text: str, limit: int, overlap: int) -> list[int]:
    """Ends of the pieces of one text longer than limit, the last being its length."""
    overlap = min(overlap, limit // 2)
    least = max(1, limit // LEAST)
    hashes = rolling_hash(text)
    spacing = max(2, limit // SPACING)
    landmarks = np.flatnonzero(hashes % np.uint64(spacing) == 0) + 1
    tiers = [np.array([m.end() for m in b.finditer(text)], int) for b in BOUNDARIES]
    cuts: list[int] = []
    at = 0
    while len(text) - at > (room := limit - (overlap if at else 0)):
        lo, hi = at + min(least, room), at + room
        inside = landmarks[np.searchsorted(landmarks, lo) : np.searchsorted(landmarks, hi, "right")]
        mark = int(inside[0]) if len(inside) else hi
        to = 0
        for t in tiers:
            near = t[np.searchsorted(t, lo) : np.searchsorted(t, hi, "right")]
            if len(near):
                to = int(near[np.argmin(np.abs(near - mark))])
                break
        if not to:
            to = mark
            while to > at + 1 and _no_break(text, to):
                to -= 1
        cuts.append(to)
        at = to
    return [*cuts, len(text)]


def pieces_of(content: str, limit: int, overlap: int) -> list[Piece]:
    """Pieces of a node's content; marks between segments of one piece stay, and do not count."""
    marks = MARK.findall(content)
    segments = MARK.split(content)
    out: list[Piece] = []
    group: list[int] = []
    size = 0
    least = max(1, limit // LEAST)

    def flush() -> None:
        nonlocal group, size
        if group:
            text = segments[group[0]] + "".join(marks[i - 1] + segments[i] for i in group[1:])
            out.append(Piece(text, group[0], group[-1], 0, False))
        group, size = [], 0

    for i, s in enumerate(segments):
        if len(s) > limit:
            flush()
            at = 0
            for end in cut_points(s, limit, overlap):
                start = max(0, at - min(overlap, limit // 2)) if at else 0
                out.append(Piece(s[start:end], i, i, start, True))
                at = end
            continue
        if size + len(s) > limit:
            flush()
        group.append(i)
        size += len(s)
        if size >= least and s and int(rolling_hash(s[-WINDOW:])[-1]) % 4 == 0:
            flush()
    flush()
    return out


def _block_ids(ids: list[int] | None, n_segments: int, first: int, last: int, is_text: bool) -> list[int]:
    """Blocks of the segments first..last. In a text node a title's block comes before the segments' blocks."""
    ids = ids or []
    if not is_text:
        return ids
    own = ids[1:] if len(ids) > n_segments else ids
    return own[first : last + 1]


def size_limits(limits: DataFrame, table: str = "sub_com_trees") -> dict[str, tuple[int, int]]:
    """node_type to (max_size, overlap_size) in characters; types without a limit are left out.

    A limit is a setting per node type; more than 1,000 of them are no settings, and an error.
    """
    rows = limits.filter((F.col("table_name") == table) & (F.col("size_unit") == "characters") & F.col("max_size").isNotNull()).select("node_type", "max_size", "overlap_size").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("size_limits holds more than 1,000 limits")
    return {r[0]: (r[1], r[2] or 0) for r in rows}


_OUT = "node_key long, piece_no int, n_pieces int, content string, n_chars int, block_ids array<int>, start_char int, was_cut boolean"


def node_pieces(nodes: DataFrame, limits: DataFrame, only_oversized: bool = False) -> DataFrame:
    """node_key, piece_no, n_pieces, content, n_chars (marks not counted), block_ids, start_char (within its segment), was_cut.

    A node within its limit, or of a type without one, is one piece. Nodes without content or key have no piece.
    Nodes delivered twice give their pieces once. Types without limit are never read into Python.
    """
    by = size_limits(limits)
    size = F.length(F.regexp_replace("content", r"<\|txt_(split|contd)\|>", ""))
    limit = F.lit(None).cast("int")
    for kind, (most, _) in by.items():
        limit = F.when(F.col("node_type") == kind, F.lit(most)).otherwise(limit)
    src = nodes.select("node_key", "node_type", "content", "block_ids").filter("content <> '' and node_key is not null").withColumn("over", F.coalesce(size > limit, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for key, kind, content, ids in zip(*(b.column(c).to_pylist() for c in ("node_key", "node_type", "content", "block_ids")), strict=True):
                pieces = pieces_of(content, *by[kind])
                n = len(MARK.findall(content)) + 1
                for no, p in enumerate(pieces):
                    for col, x in zip(cols, (key, no, len(pieces), p.text, len(MARK.sub("", p.text)), _block_ids(ids, n, p.first, p.last, kind == "text"), p.start, p.cut), strict=True):
                        col.append(x)
            types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.bool_())
            names = ["node_key", "piece_no", "n_pieces", "content", "n_chars", "block_ids", "start_char", "was_cut"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    cut = src.filter("over").select("node_key", "node_type", "content", "block_ids").mapInArrow(run, _OUT)
    if only_oversized:
        return cut
    one = F.lit(1).cast("int")
    whole = src.filter("not over").select("node_key", F.lit(0).alias("piece_no"), one.alias("n_pieces"), "content", size.alias("n_chars"), F.coalesce("block_ids", F.array().cast("array<int>")).alias("block_ids"), F.lit(0).alias("start_char"), F.lit(False).alias("was_cut"))
    return cut.unionByName(whole).dropDuplicates(["node_key", "piece_no"])


def oversized(nodes: DataFrame, limits: DataFrame) -> DataFrame:
    """node_key of the nodes that came out as more than one piece."""
    return node_pieces(nodes, limits, only_oversized=True).filter("piece_no = 1").select("node_key").distinct()
