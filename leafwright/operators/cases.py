"""Training cases and relation records from labelled blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.operators.prompts import prompts


def level_marks(blocks: DataFrame) -> DataFrame:
    """doc_id, id, type, marked: titles with a # per level before them; a title without a level becomes text."""
    level = F.coalesce("level", F.lit(0))
    title = F.col("type") == "title"
    return blocks.select("doc_id", "id", F.when(title & (level <= 0), "text").otherwise(F.col("type")).alias("type"), F.when(title & (level > 0), F.concat(F.expr("repeat('#', coalesce(level, 0))"), F.lit(" "), F.coalesce("content", F.lit("")))).otherwise(F.coalesce("content", F.lit(""))).alias("marked"))


def continued_marks(blocks: DataFrame, pairs: DataFrame, mark: str = "<|txt_contd|>") -> DataFrame:
    """doc_id, id, marked: texts that go on in a later block (idx of pairs) get the mark at their end."""
    goes_on = pairs.select("doc_id", (F.col("idx") + 1).alias("id"), F.lit(mark).alias("__m")).distinct()
    return blocks.join(goes_on, ["doc_id", "id"], "left").select("doc_id", "id", F.concat(F.coalesce("content", F.lit("")), F.coalesce("__m", F.lit(""))).alias("marked"))


def answer_lines(labels: DataFrame, task: str) -> DataFrame:
    """doc_id, answer: a line per label; links (src, tgt) or levels (idx, level)."""
    line = F.concat(F.lit("<|id|>"), "idx", F.lit("<|level|>"), "level") if task == "title" else F.concat(F.lit("<|src_id|>"), "src", F.lit("<|tgt_id|>"), "tgt")
    first, second = ("idx", "level") if task == "title" else ("src", "tgt")
    g = labels.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(first, second, line.alias("line")))).alias("x"))
    return g.select("doc_id", F.array_join(F.transform("x", lambda v: v["line"]), "\n").alias("answer"))


def cases(rows: DataFrame, labels: DataFrame, task: str) -> DataFrame:
    """doc_id, task, case: JSON of a question and its answer; documents without labels have an empty answer."""
    asked = prompts(rows, task, ("doc_id",))
    both = asked.join(answer_lines(labels, task), "doc_id", "left")
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    talk = F.array(turn("human", F.concat(F.lit("<image>\n"), F.col("prompt"))), turn("gpt", F.coalesce("answer", F.lit(""))))
    return both.select("doc_id", F.lit(task).alias("task"), F.to_json(F.struct(F.lit("").alias("image"), talk.alias("conversations"), F.lit("grounding").alias("type"))).alias("case"))




def table_cases(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """doc_id, upper_idx, lower_idx, case: JSON of the question about a table pair (prompt) and its answer, the cells'
    flags as a list; a pair without an answer is no continuation and gets an empty list."""
    both = requests.join(answers.select("doc_id", "upper_idx", "lower_idx", "cells"), ["doc_id", "upper_idx", "lower_idx"], "left")
    flags = F.concat(F.lit("["), F.array_join(F.coalesce("cells", F.array().cast("array<int>")).cast("array<string>"), ", "), F.lit("]"))
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    case = F.to_json(F.struct(F.lit("").alias("image"), F.array(turn("human", F.col("prompt")), turn("gpt", flags)).alias("conversations"), F.lit("grounding").alias("type")))
    return both.select("doc_id", "upper_idx", "lower_idx", case.alias("case"))


def relations(blocks: DataFrame) -> DataFrame:
    """doc_id, kind, src, tgt of annotated blocks: a row per link (contd, image, table_merge) and per title (its level as tgt)."""

    def of(kind: str, target: str, where: str) -> DataFrame:
        return blocks.filter(where).select("doc_id", F.lit(kind).alias("kind"), F.col("id").alias("src"), F.col(target).cast("int").alias("tgt"))

    out = of("contd", "contd", "contd >= 0").unionByName(of("image", "image", "image >= 0")).unionByName(of("title", "level", "type = 'title' and level >= 0"))
    return out.unionByName(of("table_merge", "table_merge", "table_merge >= 0")) if "table_merge" in blocks.columns else out


def relation_records(links: DataFrame) -> DataFrame:
    """doc_id, record: JSON of a document's relations by kind, each a sorted list of pairs."""
    per = links.groupBy("doc_id", "kind").agg(F.array_sort(F.collect_list(F.array("src", "tgt"))).alias("pairs"))
    return per.groupBy("doc_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "pairs"))))).alias("record"))
