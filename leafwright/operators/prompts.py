"""Requests to the model as text, its answers as rows, and the model clients."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Heads of the three requests.
HEADS = {"contd": "Truncation Detection", "title": "Title Level Analysis", "image": "Image-Text Correlation Analysis"}
#: Characters of a request that are sent at most.
PROMPT_LIMIT = 100_000


def row_line(with_type: bool = False) -> Column:
    kind = F.concat(F.lit("<|type|>"), F.col("type")) if with_type else F.lit("")
    return F.concat(F.lit("<|id|>"), F.col("idx"), kind, F.lit("<|page|>"), F.col("page"), F.lit("<|box|>"), F.array_join(F.col("box").cast("array<string>"), " "), F.lit("<|content|>"), F.col("content"))


def prompts(rows: DataFrame, task: str, keys: tuple[str, ...] = ("doc_id", "chunk_no")) -> DataFrame:
    """keys, task, prompt: head and a line per row, by page and order. Chunks bound the lines of a prompt."""
    lines = F.array_sort(F.collect_list(F.struct("page", "ord", row_line(task == "image").alias("line"))))
    return rows.groupBy(*keys).agg(lines.alias("lines")).select(*keys, F.lit(task).alias("task"), F.concat(F.lit(HEADS[task] + ": "), F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("prompt"))


def parsed_prompt(df: DataFrame, prompt: str) -> DataFrame:
    """df with a row per line of a request: idx, kind, page, box, content."""
    lines = df.withColumn("line", F.explode(F.split(F.regexp_replace(prompt, r"^[^<\n]*(?=<\|id\|>)", ""), "\n"))).filter(F.col("line").startswith("<|id|>"))
    pick = lambda tag, stop: F.regexp_extract("line", rf"<\|{tag}\|>(.*?)(?:<\|(?:{stop})\|>|$)", 1)
    box = F.transform(F.split(pick("box", "content"), " "), lambda v: v.try_cast("int"))
    return lines.select(*[c for c in df.columns if c != prompt], pick("id", "type|page").try_cast("int").alias("idx"), F.nullif(F.when(F.col("line").contains("<|type|>"), pick("type", "page")), F.lit("")).alias("kind"), pick("page", "box").try_cast("int").alias("page"), box.alias("box"), F.regexp_extract("line", r"(?s)<\|content\|>(.*)$", 1).alias("content"))


def _lines(df: DataFrame, response: str) -> DataFrame:
    return df.select("*", F.posexplode(F.split(F.coalesce(response, F.lit("")), "\n")).alias("pos", "line"))


def parsed_links(df: DataFrame, response: str = "response") -> DataFrame:
    """df with a row per valid line <|src_id|>a<|tgt_id|>b: pos, src, tgt; from/to are taken as well. Other lines are dropped."""
    line = F.regexp_replace(F.regexp_replace("line", r"<\|from\|>", "<|src_id|>"), r"<\|to\|>", "<|tgt_id|>")
    parts = F.split(line, r"<\|tgt_id\|>")
    src = F.trim(F.regexp_replace(parts[0], r"<\|src_id\|>", "")).try_cast("int")
    out = _lines(df, response).filter(F.size(parts) == 2).withColumns({"src": src, "tgt": F.trim(parts[1]).try_cast("int")})
    return out.filter("src >= 0 and tgt >= 0").drop("line", response)


def parsed_levels(df: DataFrame, response: str = "response") -> DataFrame:
    """df with a row per valid line <|id|>a<|level|>n, n from 0 on: pos, idx, level."""
    m = r"<\|id\|>\s*([0-9]+)\s*<\|level\|>\s*(-?[0-9]+)\s*$"
    out = _lines(df, response).withColumns({"idx": F.regexp_extract("line", m, 1).try_cast("int"), "level": F.regexp_extract("line", m, 2).try_cast("int")})
    return out.filter("idx is not null and level >= 0").drop("line", response)


def last_flags(response: Column) -> Column:
    """The last flat list of whole numbers in a text, such as [1, 0, 1]; null without one."""
    lists = F.regexp_extract_all(response, F.lit(r"(\[\s*(?:-?[0-9]+\s*(?:,\s*-?[0-9]+\s*)*)?\])"), F.lit(1))
    return F.from_json(F.try_element_at(lists, F.lit(-1)), "array<int>")


def fenced_json(response: Column) -> Column:
    """JSON between ```json fences, else from the first [ to the last ]; null if neither is there."""
    fenced = F.regexp_extract(response, r"(?s)```json\s*(.*?)```", 1)
    plain = F.regexp_extract(response, r"(?s)(\[.*\])", 1)
    return F.nullif(F.when(fenced != "", fenced).otherwise(plain), F.lit(""))


class ModelClient(Protocol):
    """Anything that answers prompts; it is made once per Python worker."""

    def generate(self, prompts: list[str]) -> list[str]: ...


class RuleModel:
    """A model of fixed rules, so that everything runs without a network.

    Titles: level 1 + idx mod 4, every seventh none. Texts: each links to the next line. Visual blocks: each to the last title before it.
    """

    def generate(self, prompts: list[str]) -> list[str]:
        return [self.one(p) for p in prompts]

    def one(self, prompt: str) -> str:
        rows = [(int(x.split("<|page|>")[0].split("<|type|>")[0][6:]), x) for x in prompt[max(0, prompt.find("<|id|>")) :].split("\n") if x.startswith("<|id|>") and "<|page|>" in x]
        if prompt.startswith(HEADS["title"]):
            return "\n".join(f"<|id|>{i}<|level|>{-1 if i % 7 == 0 else 1 + i % 4}" for i, _ in rows)
        if prompt.startswith(HEADS["contd"]):
            return "\n".join(f"<|src_id|>{a}<|tgt_id|>{b}" for (a, _), (b, _) in zip(rows, rows[1:], strict=False) if (a + b) % 3 == 0)
        out, title = [], None
        for i, line in rows:
            if "<|type|>title<" in line:
                title = i
            elif title is not None:
                out.append(f"<|src_id|>{i}<|tgt_id|>{title}")
        return "\n".join(out)


class HttpModel:
    """A chat endpoint; an answer is empty after `tries` failures."""

    def __init__(self, url: str, model: str, key: str = "", tries: int = 5, timeout: float = 120.0) -> None:
        self.url, self.model, self.key, self.tries, self.timeout = url, model, key, tries, timeout

    def generate(self, prompts: list[str]) -> list[str]:
        return [self.one(p) for p in prompts]

    def one(self, prompt: str) -> str:
        body = json.dumps({"model": self.model, "messages": [{"role": "user", "content": prompt}]}).encode()
        for n in range(self.tries):
            try:
                request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    return json.load(r)["choices"][0]["message"]["content"] or ""
            except (OSError, KeyError, IndexError, TypeError, ValueError):
                time.sleep(min(2**n, 30))
        return ""


def answered(requests: DataFrame, make_client, tasks: int | None = None) -> DataFrame:
    """requests (.., prompt) with request_id, lost and response. Write the result before using it twice: a model may answer differently.

    request_id is a hash of the whole request, lost the number of its characters beyond PROMPT_LIMIT, which are not sent; smaller
    chunks avoid such requests.
    """
    whole = requests.withColumns({"request_id": F.sha2("prompt", 256), "lost": F.greatest(F.length("prompt") - PROMPT_LIMIT, F.lit(0)), "prompt": F.substring("prompt", 1, PROMPT_LIMIT)})
    keep = [f for f in whole.schema.fields if f.name != "prompt"]
    src = whole
    if tasks:
        src = src.repartition(tasks, F.xxhash64("prompt"))
    schema = T.StructType([*keep, T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType())])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for b in batches:
            said = client.generate(b.column("prompt").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(said, pa.string())], [*names, "response"])

    return src.select(*names).mapInArrow(run, schema)


def unanswered(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Requests that have no answer in the log, by the hash of the whole request (of the logged prompt in logs without one)."""
    known = F.col("request_id") if "request_id" in log.columns else F.sha2("prompt", 256)
    return requests.withColumn("__h", F.sha2("prompt", 256)).join(log.filter("response <> ''").select(known.alias("__h")).distinct(), "__h", "left_anti").drop("__h")
