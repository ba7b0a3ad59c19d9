import random

from leafwright.llm import packing


def test_waste_over_many_items_and_partitions(spark):
    """Forty thousand items in forty partitions, most of them small with a few large ones, stay within two hundredths of the lower bound."""
    rng = random.Random(8)
    sizes = [min(2048, int(rng.lognormvariate(5.5, 1.1)) + 1) for _ in range(40_000)]
    rows = [(i, 0, 0, n, n) for i, n in enumerate(sizes)]
    items = spark.createDataFrame(rows, "doc_id long, part_no int, start_char int, end_char int, n_tokens int").repartition(40)
    got = packing.containers(items, 2048, per_partition=2000).groupBy("container_id").agg({"n_tokens": "sum", "doc_id": "count"}).collect()
    assert sum(r["count(doc_id)"] for r in got) == len(sizes) and sum(r["sum(n_tokens)"] for r in got) == sum(sizes)
    assert max(r["sum(n_tokens)"] for r in got) <= 2048 and len(got) <= 1.02 * -(-sum(sizes) // 2048)
