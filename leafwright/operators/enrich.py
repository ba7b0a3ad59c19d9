"""Large text nodes into sub-nodes, and metadata for nodes by a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.operators.tree import COMPONENTS, DEFAULT_TITLE

_MARK = r"<\|txt_split\|>|<\|txt_contd\|>"


def subnodes(nodes: DataFrame, keys: tuple[str, ...] = ("doc_id", "node"), most: int = 500) -> DataFrame:
    """keys, sub_no, title, content, block_ids, and locations if nodes have them: text nodes over `most` characters as sub-nodes.

    Segments are added until a sub-node has more than `most`; a node that stays whole has none. The title's block
    goes with every sub-node; under the default title block ids belong to the segments only. Empty segments are left
    out, and do not count for the block ids.
    """
    n = nodes.filter((F.col("type") == "text") & (F.length("content") > most))
    segments = F.filter(F.split("content", _MARK), lambda s: s != "")
    part = "struct<text string, ids array<int>>"
    start = F.struct(F.array().cast(f"array<{part}>").alias("done"), F.lit("").alias("text"), F.array().cast("array<int>").alias("at"))

    def add(acc: Column, seg: Column) -> Column:
        text = F.concat(acc["text"], seg["text"])
        at = F.concat(acc["at"], F.array(seg["no"]))
        full = F.length(text) > most
        done = F.when(full, F.concat(acc["done"], F.array(F.struct(text.alias("text"), at.alias("ids"))))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(full, "").otherwise(text).alias("text"), F.when(full, F.array().cast("array<int>")).otherwise(at).alias("at"))

    def finish(acc: Column) -> Column:
        return F.when(acc["text"] != "", F.concat(acc["done"], F.array(F.struct(acc["text"].alias("text"), acc["at"].alias("ids"))))).otherwise(acc["done"])

    numbered = F.transform(segments, lambda s, i: F.struct(s.alias("text"), (i + 1).cast("int").alias("no")))
    subs = n.withColumn("subs", F.aggregate(numbered, start, add, finish)).filter(F.size("subs") > 1)
    default = F.col("title") == DEFAULT_TITLE
    own = ["block_ids", *(["locations"] if "locations" in nodes.columns else [])]
    of = lambda c: F.when(default, F.transform("s.ids", lambda i: F.get(c, i - 1))).otherwise(F.concat(F.array(F.get(c, 0)), F.transform("s.ids", lambda i: F.get(c, i))))
    kept = [F.filter(of(c), lambda x: x.isNotNull()).alias(c) for c in own]
    return subs.select(*keys, "title", *own, F.posexplode("subs").alias("no", "s")).select(*keys, (F.col("no") + 1).alias("sub_no"), F.concat("title", F.lit("_"), F.col("no") + 1).alias("title"), F.col("s.text").alias("content"), *kept)


def child_relation(nodes: DataFrame) -> DataFrame:
    """nodes with relation: children of visual nodes are their sub-nodes, all others children."""
    up = nodes.select("doc_id", F.col("node").alias("parent"), F.col("type").alias("__up"))
    return nodes.join(up, ["doc_id", "parent"], "left").withColumn("relation", F.when(F.col("__up").isin(*COMPONENTS), "subnode").otherwise("children")).drop("__up")


def annotation(response: Column) -> Column:
    """title, metadata and content of an answer [T].. [M].. [C]..; defaults where a part is missing."""
    part = lambda tag, default: F.coalesce(F.nullif(F.trim(F.regexp_extract(response, rf"(?s)\[{tag}\](.*?)(?:\[[TMC]\]|$)", 1)), F.lit("")), F.lit(default))
    return F.struct(part("T", "Default Title").alias("title"), part("M", "Default Metadata").alias("metadata"), part("C", "Default Content").alias("content"))


def filled(nodes: DataFrame, answers: DataFrame, keys: tuple[str, ...] = ("doc_id", "node")) -> DataFrame:
    """nodes whose empty title, metadata or content is filled from answers (keys, response); what is there stays."""
    a = answers.select(*keys, annotation(F.col("response")).alias("__a"))
    out = nodes.join(a, list(keys), "left")
    for c in ("title", "metadata", "content"):
        out = out.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.col("__a")[c], F.col(c)))
    return out.drop("__a")


def keyword_requests(nodes: DataFrame) -> DataFrame:
    """doc_id, node, prompt for text nodes that have content and no metadata."""
    need = F.col("type").isin("text", "sub_text") & (F.coalesce("content", F.lit("")) != "") & (F.coalesce("metadata", F.lit("")) == "")
    return nodes.filter(need).select("doc_id", "node", F.concat(F.lit("Give a few keywords for this section.\n"), F.col("content")).alias("prompt"))
