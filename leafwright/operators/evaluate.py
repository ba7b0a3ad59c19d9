"""Evaluation of title trees against ground truth."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.functions import bbox as B
from leafwright.functions import similarity as S
from leafwright.functions import text as X
from leafwright.runtime import fold_sorted

MODES = ("id_aware", "structure_only", "content_aware")


def truth_titles(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    """doc_id, gt_id, page, bbox, content, ord from requests: entries <|id|>..<|page|>..<|box|>top left bottom right<|content|>.."""
    text = F.concat(F.lit("\n"), F.regexp_replace(prompt, r"^[^<\n]*(?=<\|id\|>)", ""))
    entry = df.select("doc_id", F.posexplode(F.split(text, r"\n<\|id\|>")).alias("ord", "e")).filter("ord > 0")
    m = r"(?s)^([^<]+)<\|page\|>([0-9]+)<\|box\|>([^<]+)<\|content\|>(.*)$"
    box = F.transform(F.slice(F.split(F.trim(F.regexp_extract("e", m, 3)), r"\s+"), 1, 4), lambda v: v.try_cast("double"))
    turned = F.when(F.size(box) == 4, F.array(box[1], box[0], box[3], box[2])).otherwise(F.array(*[F.lit(0.0)] * 4))
    return entry.filter(F.col("e").rlike(m)).select("doc_id", F.trim(F.regexp_extract("e", m, 1)).alias("gt_id"), F.regexp_extract("e", m, 2).cast("int").alias("page"), turned.alias("bbox"), X.normalize_text(F.regexp_extract("e", m, 4)).alias("content"), (F.col("ord") - 1).alias("ord"))


def truth_levels(df: DataFrame, label: str = "label") -> DataFrame:
    """doc_id, gt_id, level, ord from answers: lines <|id|>x<|level|>n with n from 0 on."""
    m = r"^\s*<\|id\|>([^<]+)<\|level\|>(-?[0-9]+)"
    lines = df.select("doc_id", F.posexplode(F.split(F.coalesce(label, F.lit("")), "\n")).alias("ord", "line"))
    return lines.withColumn("level", F.regexp_extract("line", m, 2).try_cast("int")).filter("level >= 0").select("doc_id", F.trim(F.regexp_extract("line", m, 1)).alias("gt_id"), "level", "ord")


def box_score(a: Column, b: Column) -> Column:
    return F.greatest(B.iou(a, b), B.overlap_smaller(a, b))


def alignment(truth: DataFrame, blocks: DataFrame, least: float = 0.35) -> DataFrame:
    """doc_id, page, gt_id, block_id, score, box, text of pairs on one page whose score is at least `least`.

    score: 0.45 box + 0.35 text + 0.20 type, the type being 1 for titles and 0.4 for others.
    """
    t = truth.select("doc_id", "page", "gt_id", F.col("bbox").alias("tb"), S.compact(F.col("content")).alias("tt"))
    m = blocks.select("doc_id", "page", "block_id", F.col("bbox").alias("mb"), S.compact(F.col("content")).alias("mt"), F.when(F.col("type") == "title", 1.0).otherwise(0.4).alias("kind"))
    p = t.join(m, ["doc_id", "page"]).withColumns({"box": box_score(F.col("tb"), F.col("mb")), "text": S.text_similarity("tt", "mt")})
    return p.withColumn("score", 0.45 * F.col("box") + 0.35 * F.col("text") + 0.20 * F.col("kind")).filter(F.col("score") >= least).select("doc_id", "page", "gt_id", "block_id", "score", "box", "text")


def matched(pairs: DataFrame) -> DataFrame:
    """doc_id, gt_id, block_id, score: one to one, best scores first, ties by greater ids; pairs weak in text and box are none.

    Pairs share a page, so every page is matched by itself; no task gets a whole document.
    """

    def step(rows: list[dict], r: dict | None) -> list[tuple] | None:
        if r is not None:
            rows.append(r)
            return None
        left, right, keep = set(), set(), []
        for x in sorted(rows, key=lambda x: (x["score"], x["gt_id"], x["block_id"]), reverse=True):
            if x["gt_id"] in left or x["block_id"] in right or (x["text"] < 0.45 and x["box"] < 0.8):
                continue
            left.add(x["gt_id"])
            right.add(x["block_id"])
            keep.append((x["doc_id"], x["gt_id"], x["block_id"], round(x["score"], 4)))
        return keep

    return fold_sorted(pairs, ["doc_id", "page"], ["gt_id"], list, step, ["block_id", "score", "box", "text"], "doc_id long, gt_id string, block_id string, score double")


def predicted_titles(matches: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, gt_id, level, ord: matched blocks in reading order under their truth's id; without a level 1."""
    level = F.when(F.col("title_level") > 0, F.col("title_level")).otherwise(1)
    return matches.join(blocks.select("doc_id", "block_id", "title_level", F.col("id").alias("ord")), ["doc_id", "block_id"]).select("doc_id", "gt_id", level.cast("int").alias("level"), "ord")


def labelled(titles: DataFrame, truth: DataFrame, mode: str) -> DataFrame:
    """titles with label: the id, a constant, or the truth's compact text, by mode."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if mode == "id_aware":
        return titles.withColumn("label", F.col("gt_id"))
    if mode == "structure_only":
        return titles.withColumn("label", F.lit("NODE"))
    texts = truth.select("doc_id", "gt_id", S.compact(F.col("content")).alias("label")).dropDuplicates(["doc_id", "gt_id"])
    return titles.join(texts, ["doc_id", "gt_id"], "left").withColumn("label", F.coalesce("label", F.lit("")))


def tree_scores(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """doc_id, score of title trees (doc_id, label, level, ord); a document without predictions is compared with an empty tree."""
    nodes = lambda df, name: df.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "label", "level"))), lambda x: F.struct(x["label"].alias("label"), x["level"].alias("level"))).alias(name))
    both = nodes(truth, "a").join(nodes(predicted, "b"), "doc_id", "left")

    @F.pandas_udf(T.DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = lambda v: [] if v is None else [(x["label"], x["level"]) for x in v]
        return pd.Series([S.tree_score(pairs(x), pairs(y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return both.select("doc_id", score("a", "b").alias("score"))


def details(truth: DataFrame, blocks: DataFrame, mode: str = "content_aware", least: float = 0.35) -> DataFrame:
    """doc_id, score, n_truth, n_predicted, n_matched of every document of truth (doc_id, prompt, label); blocks carry
    boxes in thousandths. Without a match the predicted tree is empty."""
    titles = truth_titles(truth)
    matches = matched(alignment(titles, blocks, least))
    predicted = predicted_titles(matches, blocks)
    scores = tree_scores(labelled(truth_levels(truth), titles, mode), labelled(predicted, titles, mode))
    n = lambda df, name: df.groupBy("doc_id").agg(F.count("*").alias(name))
    out = scores.join(n(titles, "n_truth"), "doc_id", "left").join(n(blocks.filter("type = 'title'"), "n_predicted"), "doc_id", "left").join(n(matches, "n_matched"), "doc_id", "left")
    return out.fillna(0, ["n_truth", "n_predicted", "n_matched"])


def summary(scores: DataFrame, status: DataFrame) -> DataFrame:
    """model, n_docs, n_ok, mean_ok, mean_all: the mean over documents that could be read, and with the others as 0."""
    s = status.join(scores, "doc_id", "left")
    ok = F.col("status") == "ok"
    return s.groupBy("model").agg(F.count("*").alias("n_docs"), F.count_if(ok).alias("n_ok"), F.round(F.avg(F.when(ok, F.coalesce("score", F.lit(0.0)))), 6).alias("mean_ok"), F.round(F.avg(F.when(ok, F.coalesce("score", F.lit(0.0))).otherwise(0.0)), 6).alias("mean_all"))
