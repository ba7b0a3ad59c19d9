"""Session, shared folder and skew helpers used by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: list[str] = []


def session(app: str = "leafwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; keys given as a__b become a.b."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session may leave it unset (tests): it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a folder that all executors share")
    own = tempfile.mkdtemp(prefix="leafwright_")
    _own_folders.append(own)
    sc.setCheckpointDir(own)
    return f"file://{own}"


@atexit.register
def _remove_own_folders() -> None:
    for p in _own_folders:
        shutil.rmtree(p, ignore_errors=True)


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder; for small results that are used again."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_written: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: cuts lineage and keeps column pruning.

    The tables stay for results that are still to be read; remove_written takes them away.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/leafwright/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> int:
    """Deletes the tables that `written` made in this process; to be called when their results have been stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest `order` (nulls lowest, ties by the whole row).

    Partial aggregation combines copies before the shuffle, so a key repeated very often stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(order).alias("__o"), F.struct(*rest).alias("__r"))).alias("__b")
    return df.groupBy(*keys).agg(best).select(*keys, "__b.__r.*").select(*df.columns)


def hot_keys(df: DataFrame, key: str, parts: int = 256) -> list:
    """Keys that hold more than 1/parts of all rows: at most parts - 1 of them, whatever the size of df."""
    counts = df.groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r[0] for r in counts.filter((F.col("count") > total / parts) & F.col(key).isNotNull()).select(key).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", salts: int = 64, parts: int = 256, hot: list | None = None) -> DataFrame:
    """Equi join whose hot keys (over 1/parts of big) are spread over `salts` tasks.

    Rows of small with a hot key are copied once per salt, all others once; so the copies stay below
    salts x (rows of at most parts - 1 keys).
    """
    hot = hot_keys(big, key, parts) if hot is None else hot
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    b = big.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(*[c for c in big.columns if c != key][:4]), F.lit(salts)).cast("int")).otherwise(0))
    s = small.withColumn("__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return b.join(s, [key, "__salt"], how).drop("__salt")


#: Rows of one key are cut into runs of so many positions for the two-level window functions below.
RUN_LENGTH = 4096


def fill(df: DataFrame, key: str, order: str, columns: dict[str, object], forward: bool, own_row: bool = False, run_length: int = RUN_LENGTH) -> DataFrame:
    """Adds columns with the nearest non-null value at an earlier (forward) or later row of the same key.

    columns: new name to Column. order must be a whole number. The rows of a key are cut into runs of positions;
    a window works within a run, a second one over one row per run, so no task gets all rows of a large key.
    own_row: whether the row itself counts.
    """
    from pyspark.sql import Window

    run = F.floor(F.col(order) / run_length)
    src = df.withColumns({f"__v_{n}": c for n, c in columns.items()} | {"__run": run})
    first, last = (F.first, F.last)
    inside = Window.partitionBy(key, "__run").orderBy(order)
    if forward:
        inside = inside.rowsBetween(Window.unboundedPreceding, 0 if own_row else -1)
    else:
        inside = inside.rowsBetween(0 if own_row else 1, Window.unboundedFollowing)
    nearest = last if forward else first
    near = src.withColumns({f"__n_{n}": nearest(f"__v_{n}", ignorenulls=True).over(inside) for n in columns})
    pick = F.max_by if forward else F.min_by
    runs = src.groupBy(key, "__run").agg(*[pick(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col(order))).alias(f"__r_{n}") for n in columns])
    over = Window.partitionBy(key).orderBy("__run").rowsBetween(*((Window.unboundedPreceding, -1) if forward else (1, Window.unboundedFollowing)))
    far = runs.select(key, "__run", *[nearest(f"__r_{n}", ignorenulls=True).over(over).alias(f"__f_{n}") for n in columns])
    out = near.join(far, [key, "__run"], "left")
    return out.withColumns({n: F.coalesce(f"__n_{n}", f"__f_{n}") for n in columns}).drop("__run", *[f"__{p}_{n}" for n in columns for p in ("v", "n", "f")])


def fold_sorted(df: DataFrame, keys: list[str], order: list[str], start, step, columns: list[str], schema: str) -> DataFrame:
    """A fold over the rows of each key in order, streamed: rows are never gathered per key.

    start() gives a key's state; step(state, row) changes it and yields output tuples; row is a dict of `columns`.
    A step that is given None ends the key.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out_type = _parse_datatype_string(schema)
    ordered = df.select(*dict.fromkeys([*keys, *order, *columns])).repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        out_schema = to_arrow_schema(out_type)
        key, state, seen = None, None, False

        def record(rows):
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(out_schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out_schema, strict=True)], schema=out_schema)

        for b in batches:
            rows = []
            for r in b.to_pylist():
                k = tuple(r[c] for c in keys)
                if not seen or k != key:
                    if seen:
                        rows += step(state, None) or ()
                    key, state, seen = k, start(), True
                rows += step(state, r) or ()
            yield record(rows)
        if seen:
            yield record(list(step(state, None) or ()))

    return ordered.mapInArrow(run, schema)
