import glob
import os

import pytest

import __spark_entry__ as entry
from leafwright.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test data here")


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.core_queries()))
def test_query(spark, name):
    df = registry.core_queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = registry.core_sql().get(name)
    if sql:
        import duckdb

        con = duckdb.connect()
        for f in glob.glob(f"{FOLDER}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        assert sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()) == rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "path", "line"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_are_pruned(spark):
    plan = registry.core_queries()["title_candidates"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(block_type,title)" in plan
    read = {c.split("#")[0] for c in plan.split("FileScan parquet [")[1].split("]")[0].split(",")}
    assert read == {"block_key", "doc_id", "id", "page", "bbox", "block_type", "content", "loaded_at"}
