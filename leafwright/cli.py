"""Command line: normalize, requests, annotate, tree, preview, evaluate and cases of Parquet or vendor folders."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from leafwright.operators import annotate, candidates, cases, chunking, evaluate, normalize, prompts, tree
from leafwright.runtime import session
from leafwright.sources import sinks, vendors


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="leafwright", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)
    n = sub.add_parser("normalize", help="a vendor's folder to blocks")
    n.add_argument("--input", required=True)
    n.add_argument("--vendor", required=True, choices=sorted(vendors.FILES))
    n.add_argument("--output", required=True)
    n.add_argument("--format", choices=("parquet", *sinks.FORMATS), default="parquet")
    n.add_argument("--limit", type=int, default=0, help="so many documents in order; 0: all")
    for name, text in (("requests", "requests to the model of annotated blocks"), ("tree", "node tables of annotated blocks"), ("preview", "previews of annotated blocks"), ("annotate", "links, levels and table merges onto normalized blocks, by a model"), ("evaluate", "scores of title trees against ground truth"), ("cases", "training cases of labelled titles, and relation records")):
        s = sub.add_parser(name, help=text)
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
        if name == "requests":
            s.add_argument("--task", choices=("contd", "title", "image"), required=True)
            s.add_argument("--resume", help="log of answers; requests that it answers are left out")
            s.add_argument("--dry-run", action="store_true", help="only validate the blocks")
        elif name == "annotate":
            s.add_argument("--url", help="a chat endpoint; without one fixed rules answer")
            s.add_argument("--model", default="", help="the endpoint's model")
            s.add_argument("--json", action="store_true", help="a JSON object per document instead of Parquet")
        elif name == "evaluate":
            s.add_argument("--truth", required=True, help="Parquet of doc_id, prompt, label")
            s.add_argument("--status", required=True, help="Parquet of doc_id, model, status")
            s.add_argument("--mode", choices=evaluate.MODES, default="content_aware")
    a = p.parse_args(args)
    spark = session("leafwright")
    if a.stage == "normalize":
        blocks, status = vendors.read_vendor(spark, a.input, a.vendor)
        if a.limit > 0:
            blocks = blocks.join(normalize.doc_ids(status.select("doc_id"), limit=a.limit), "doc_id", "left_semi")
        if a.format == "parquet":
            blocks.write.mode("overwrite").parquet(f"{a.output}/blocks")
        else:
            sinks.write_documents(sinks.document_json(blocks, a.format), f"{a.output}/documents")
        status.write.mode("overwrite").parquet(f"{a.output}/status")
        return
    blocks = spark.read.parquet(a.input)
    if a.stage == "requests":
        if a.dry_run:
            normalize.checked(blocks).write.format("noop").mode("overwrite").save()
            return
        rows = {"contd": candidates.truncation_rows, "title": candidates.title_rows, "image": candidates.visual_rows}[a.task](blocks)
        asked = prompts.prompts(chunking.chunk_items(rows, chunking.chunk_ranges(rows)), a.task)
        if a.resume:
            asked = prompts.unanswered(asked, spark.read.parquet(a.resume))
        asked.write.mode("overwrite").parquet(a.output)
    elif a.stage == "annotate":
        out = annotate.annotated(blocks, (lambda: prompts.HttpModel(a.url, a.model)) if a.url else prompts.RuleModel)
        if a.json:
            sinks.write_documents(sinks.annotated_json(out), a.output)
        else:
            out.write.mode("overwrite").parquet(a.output)
    elif a.stage == "evaluate":
        details = evaluate.details(spark.read.parquet(a.truth), blocks, a.mode)
        sinks.write_evaluation(details, evaluate.summary(details.select("doc_id", "score"), spark.read.parquet(a.status)), a.output)
    elif a.stage == "cases":
        titles = blocks.filter("type = 'title'")
        labels = titles.filter("level >= 0").select("doc_id", (F.col("id") - 1).alias("idx"), "level")
        sinks.write_cases(cases.cases(candidates.title_rows(titles), labels, "title"), f"{a.output}/titles")
        sinks.write_cases(cases.relation_records(cases.relations(blocks)), f"{a.output}/relations")
    elif a.stage == "tree":
        tree.tree(blocks).write.mode("overwrite").parquet(a.output)
    else:
        lines = tree.preview(tree.tree(blocks))
        # files of many documents, the lines of each together and in order; a folder per document would not scale
        lines.repartition("doc_id").sortWithinPartitions("doc_id", "path").select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.regexp_replace("line", r"[\r\n]", " ")).alias("value")).write.mode("overwrite").text(a.output)


if __name__ == "__main__":
    main()
