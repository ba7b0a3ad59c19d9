"""Links and levels from the model's answers onto the blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.runtime import fold_sorted


def distinct_links(links: DataFrame, order: tuple[str, ...] = ("chunk_no", "pos")) -> DataFrame:
    """doc_id, src, tgt, ord: each pair once, at its first place."""
    return links.groupBy("doc_id", "src", "tgt").agg(F.min(F.struct(*order)).alias("ord"))


def synced_levels(levels: DataFrame) -> DataFrame:
    """doc_id, idx, level: levels of overlapping chunks on one scale.

    levels: doc_id, chunk_no, pos, idx, level. Titles known from earlier chunks give the chunk's mean offset, rounded
    half to even, by which its new titles are moved; a level that falls below zero is dropped. The fold streams
    over a document's chunks in order.
    """

    def step(state, r):
        known, chunk = state["known"], state["chunk"]
        if r is None or (chunk and r["chunk_no"] != chunk[0]["chunk_no"]):
            offsets, seen = [], set()
            for x in chunk:
                if (old := known.get(x["idx"])) is not None and x["idx"] not in seen:
                    if old >= 0:
                        offsets.append(x["level"] - old)
                    seen.add(x["idx"])
            shift = round(sum(offsets) / len(offsets)) if offsets else 0
            for x in chunk:
                if x["idx"] not in known:
                    known[x["idx"]] = x["level"] - shift if x["level"] > 0 else x["level"]
            state["chunk"] = chunk = []
        if r is None:
            return [(state["doc"], i, v) for i, v in known.items() if v >= 0]
        state["doc"] = r["doc_id"]
        chunk.append(r)
        return None

    return fold_sorted(levels, ["doc_id"], ["chunk_no", "pos"], lambda: {"known": {}, "chunk": [], "doc": None}, step, ["idx", "level"], "doc_id long, idx int, level int")


def linked_blocks(blocks: DataFrame, contd: DataFrame | None = None, levels: DataFrame | None = None, images: DataFrame | None = None, contained: DataFrame | None = None, model_first: bool = False) -> DataFrame:
    """blocks with contd, level and image from the given links; -1 where there is none.

    Of several links of a block the last counts; a block inside an image block links to that in any case, or with
    model_first only where the model has no link. A target becomes its id, idx + 1. Links of blocks that do not
    exist are without effect.
    """
    out = blocks.drop("contd", "level", "image").withColumn("idx", F.col("id") - 1)

    def last(df: DataFrame | None, name: str) -> None:
        nonlocal out
        if df is None:
            out = out.withColumn(name, F.lit(-1))
            return
        pick = F.max_by(F.col("tgt") + 1, F.struct("ord", "tgt")).alias(name)
        out = out.join(df.groupBy("doc_id", F.col("src").alias("idx")).agg(pick), ["doc_id", "idx"], "left").withColumn(name, F.coalesce(name, F.lit(-1)))

    last(contd, "contd")
    last(images, "image")
    if contained is not None:
        out = out.join(contained.select("doc_id", "idx", (F.col("large_idx") + 1).alias("__in")), ["doc_id", "idx"], "left").withColumn("image", F.when(F.lit(model_first) & (F.col("image") >= 0), F.col("image")).otherwise(F.coalesce("__in", "image"))).drop("__in")
    if levels is None:
        out = out.withColumn("level", F.lit(-1))
    else:
        out = out.join(levels.select("doc_id", "idx", "level"), ["doc_id", "idx"], "left").withColumn("level", F.coalesce("level", F.lit(-1)))
    return out.drop("idx")


def merged_pairs(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """blocks with table_merge and cell_list from pairs (doc_id, upper_idx, lower_idx, cells); both sides point to each other,
    of several pairs the later counts; pairs without cells are none."""
    good = pairs.filter("size(cells) > 0")
    sides = good.select("doc_id", (F.col("upper_idx") + 1).alias("id"), (F.col("lower_idx") + 1).alias("other"), "cells", F.col("upper_idx").alias("ord")).unionByName(good.select("doc_id", (F.col("lower_idx") + 1).alias("id"), (F.col("upper_idx") + 1).alias("other"), "cells", F.col("upper_idx").alias("ord")))
    one = sides.groupBy("doc_id", "id").agg(F.max_by(F.struct("other", "cells"), "ord").alias("m"))
    return blocks.join(one, ["doc_id", "id"], "left").withColumns({"table_merge": F.coalesce("m.other", F.lit(-1)), "cell_list": F.coalesce("m.cells", F.array().cast("array<int>"))}).drop("m")


def title_links(blocks: DataFrame) -> DataFrame:
    """doc_id, idx, to_idx: each title to the nearest earlier one of a smaller level, every other block to the nearest
    earlier title. The block at idx 0 is never a target; 0 is the default."""
    from leafwright.operators.tree import parents
    from leafwright.runtime import fill

    b = blocks.select("doc_id", "id", F.when(F.col("type") == "title", F.coalesce("level", F.lit(0))).otherwise(0).alias("level"))
    titles = b.filter("level > 0 and id > 1").select("doc_id", F.col("id").alias("comp_id"), "level")
    up = parents(titles).select("doc_id", (F.col("comp_id") - 1).alias("idx"), F.when(F.col("parent_id") > 0, F.col("parent_id") - 1).otherwise(0).alias("to_idx"))
    others = fill(b, "doc_id", "id", {"t": F.when((F.col("level") > 0) & (F.col("id") > 1), F.col("id"))}, forward=True).filter("level <= 0 or id = 1")
    return up.unionByName(others.select("doc_id", (F.col("id") - 1).alias("idx"), F.coalesce(F.col("t") - 1, F.lit(0)).alias("to_idx")))
