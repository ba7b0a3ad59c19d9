"""Problem 6: texts into containers of fixed capacity, measured in tokens of a public tokenizer.

Hierarchical residual packing: each partition packs its items best-fit, largest first; nearly full containers are
done, underfull ones go on as items to the next round, in fewer partitions, until few are left. Every round is
written before the next, and which items meet in a partition depends on their keys only, so a lost executor
neither loses nor repeats an item.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.runtime import written

#: Where the tokenizer's vocabulary (ranks of byte pairs) lies on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer parts a text into words before pairing bytes.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A container is done when at most this part of it is unused.
SLACK = 0.005
#: So many underfull containers make a partition of the next round.
PER_PARTITION = 20_000


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str = VOCABULARY):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts_of(text: str, capacity: int, enc) -> list[tuple[int, int, int]]:
    """start, end (characters) and tokens of the parts of a text; one part unless it exceeds the capacity.

    Cuts go between words where there is one within the second half of a part, else between characters.
    """
    tokens = enc.encode_ordinary(text)
    if len(tokens) <= capacity:
        return [(0, len(text), len(tokens))] if tokens else []
    _, offsets = enc.decode_with_offsets(tokens)
    offsets.append(len(text))
    out = []
    at = 0
    while at < len(tokens):
        begin = offsets[at]
        to = min(at + capacity, len(tokens))
        while True:
            best = to
            if to < len(tokens):
                while best > at + 1 and (offsets[best] == offsets[best - 1] or offsets[best] <= begin):
                    best -= 1  # within a character
                space = best
                while space > at + capacity // 2 and not text[offsets[space]].isspace():
                    space -= 1
                if space > at + capacity // 2:
                    best = space
            end = offsets[best]
            n = len(enc.encode_ordinary(text[begin:end]))
            if n <= capacity or best <= at + 1:
                break
            to = best - (n - capacity)
        out.append((begin, end, n))
        at = best
    return out


def token_sizes(documents: DataFrame, capacity: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, part_no, start_char, end_char, n_tokens. Rows without a doc_id, null texts and texts without a token are no items.

    A doc_id that comes twice counts once, with its longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenizer(vocabulary)
        kind = pa.list_(pa.struct([("start_char", pa.int32()), ("end_char", pa.int32()), ("n_tokens", pa.int32())]))
        for b in batches:
            parts = [[dict(zip(("start_char", "end_char", "n_tokens"), p, strict=True)) for p in parts_of(t, capacity, enc)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(parts, kind)], ["doc_id", "parts"])

    src = documents.select(F.col("doc_id").cast("long"), "text").filter("text <> '' and doc_id is not null")
    sized = src.mapInArrow(run, "doc_id long, parts array<struct<start_char int, end_char int, n_tokens int>>").filter("size(parts) > 0")
    once = sized.groupBy("doc_id").agg(F.max_by("parts", F.struct(F.element_at("parts", -1)["end_char"], F.to_json("parts"))).alias("parts"))
    return once.select("doc_id", F.posexplode("parts").alias("part_no", "p")).select("doc_id", "part_no", "p.*")


class BestFit:
    """Containers by their residue; the smallest that holds an item is found in a bit set."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.by, self.set = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, size: int, members: list) -> None:
        up = self.set >> size
        if up:
            residue = size + (up & -up).bit_length() - 1
            box = self.by[residue].pop()
            if not self.by[residue]:
                self.set &= ~(1 << residue)
            box += members
            residue -= size
        else:
            box, residue = list(members), self.capacity - size
        self.by[residue].append(box)
        self.set |= 1 << residue

    def boxes(self) -> Iterator[tuple[int, list]]:
        for residue, boxes in enumerate(self.by):
            for box in boxes:
                yield self.capacity - residue, box


_MEMBER = pa.struct([("doc_id", pa.int64()), ("part_no", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()), ("n_tokens", pa.int32())])
_BOX = "used int, members array<struct<doc_id long, part_no int, start_char int, end_char int, n_tokens int>>"


def _pack(boxes: DataFrame, capacity: int) -> DataFrame:
    """Packs each partition's boxes (used, members) best-fit, largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, list]] = []

        def packed() -> pa.RecordBatch:
            fit = BestFit(capacity)
            for used, members in sorted(items, key=lambda x: (-x[0], x[1][0]["doc_id"], x[1][0]["part_no"])):
                fit.add(used, members)
            items.clear()
            rows = list(fit.boxes())
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(_MEMBER))], ["used", "members"])

        for b in batches:
            items += zip(b.column("used").to_pylist(), b.column("members").to_pylist(), strict=True)
            if len(items) >= 4 * PER_PARTITION:
                yield packed()
        if items:
            yield packed()

    return boxes.select("used", "members").mapInArrow(run, _BOX)


def containers(items: DataFrame, capacity: int, slack: float = SLACK, per_partition: int = PER_PARTITION) -> DataFrame:
    """container_id, doc_id, part_no, start_char, end_char, n_tokens, used: an item per row, each in one container.

    items: doc_id, part_no, start_char, end_char, n_tokens, each n_tokens from 1 to capacity.
    """
    member = F.struct(*[F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("part_no", "int"), ("start_char", "int"), ("end_char", "int"), ("n_tokens", "int"))])
    boxes = items.select(F.col("n_tokens").cast("int").alias("used"), F.array(member).alias("members"))
    full = F.col("used") >= int(capacity * (1 - slack))
    done: list[DataFrame] = []
    left = None
    while True:
        packed = written(_pack(boxes, capacity), "containers")
        done.append(packed.filter(full))
        rest = packed.filter(~full)
        n = rest.count()
        parts = -(-n // per_partition)
        # further rounds end when all underfull containers have met, or meeting no longer fills them
        if n == 0 or (left is not None and (left[1] == 1 or n > 0.98 * left[0])):
            done.append(rest)
            break
        left = (n, parts)
        boxes = rest.repartition(parts, F.xxhash64(F.col("members")[0]["doc_id"], F.col("members")[0]["part_no"]))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    first = F.col("members")[0]
    return out.select(F.concat_ws(":", first["doc_id"], first["part_no"]).alias("container_id"), "used", F.explode("members").alias("m")).select("container_id", "m.*", "used")


def capacity_of(limits: DataFrame, table: str = "documents") -> int:
    row = limits.filter((F.col("table_name") == table) & (F.col("size_unit") == "tokens") & F.col("max_size").isNotNull()).agg(F.min("max_size")).first()
    if row is None or row[0] is None:
        raise ValueError(f"no capacity in tokens for {table}")
    return row[0]


def packed_documents(documents: DataFrame, limits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The containers of all documents; see containers and token_sizes."""
    capacity = capacity_of(limits)
    return containers(token_sizes(documents, capacity, vocabulary), capacity)
