import json

from pyspark.sql import functions as F

from leafwright import cli
from leafwright.operators import prompts as P


def test_stages_from_the_command_line(spark, tmp_path):
    """annotate, cases and evaluate of one small document, with tables that go on over two pages."""
    t = "<table><tr><td>a</td></tr><tr><td>1</td></tr></table>"
    rows = [(1, 1, 1, "title", "One"), (1, 2, 1, "text", "some text that is long enough and"), (1, 3, 1, "text", "goes on here."), (1, 4, 1, "table", t), (1, 5, 2, "table", t), (1, 6, 2, "title", "Two")]
    b = spark.createDataFrame([(*r, [0.1, 0.1, 0.9, 0.2]) for r in rows], "doc_id long, id int, page int, type string, content string, bbox array<double>")
    b.write.parquet(f"{tmp_path}/in")
    cli.main(["annotate", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"])
    got = {r.id: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert set(got) == set(range(1, 7)) and got[6].level == 2 and got[4].image == 1 and got[4].table_merge == -1
    cli.main(["annotate", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/json", "--json"])
    pages = json.loads(spark.read.text(f"{tmp_path}/json").first()[0])
    assert [x["id"] for x in pages["1"]] == [1, 2, 3, 4] and pages["2"][1]["level"] == 2 and pages["1"][3]["table_merge"] == -1
    cli.main(["cases", "--input", f"{tmp_path}/out", "--output", f"{tmp_path}/cases"])
    assert "<|id|>5<|level|>2" in spark.read.text(f"{tmp_path}/cases/titles").first()[0]
    ask = P.HEADS["title"] + ": <|id|>0<|page|>1<|box|>100 100 200 900<|content|>One\n<|id|>5<|page|>2<|box|>100 100 200 900<|content|>Two"
    spark.createDataFrame([(1, ask, "<|id|>0<|level|>1\n<|id|>5<|level|>1")], "doc_id long, prompt string, label string").write.parquet(f"{tmp_path}/truth")
    spark.createDataFrame([(1, "m", "ok"), (2, "m", "missing")], "doc_id long, model string, status string").write.parquet(f"{tmp_path}/status")
    b.withColumns({"bbox": F.transform("bbox", lambda v: v * 1000), "block_id": F.col("id").cast("string"), "title_level": F.lit(1)}).write.parquet(f"{tmp_path}/mine")
    cli.main(["evaluate", "--input", f"{tmp_path}/mine", "--output", f"{tmp_path}/eval", "--truth", f"{tmp_path}/truth", "--status", f"{tmp_path}/status"])
    d, s = spark.read.json(f"{tmp_path}/eval/details").first(), spark.read.json(f"{tmp_path}/eval/summary").first()
    assert (d.score, d.n_truth, d.n_predicted, d.n_matched) == (1.0, 2, 2, 2) and (s.n_docs, s.n_ok, s.mean_ok, s.mean_all) == (2, 1, 1.0, 0.5)
