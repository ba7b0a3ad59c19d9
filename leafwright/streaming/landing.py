"""Documents that arrive in a landing folder, processed as they come; a document is one unit, so no watermark is needed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def process_landing(spark: SparkSession, folder: str, schema: str, stage: Callable[[DataFrame], DataFrame], out: str, state: str, once: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Runs `stage` over each batch of new Parquet files and appends its result to `out`.

    state: the checkpoint folder; a run after a failure goes on where it stopped. A batch writes to a folder of its
    own number, so a batch that runs twice replaces its result. once: ends when all files that are there are done.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def batch(df: DataFrame, number: int) -> None:
        stage(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    w = reader.parquet(folder).writeStream.foreachBatch(batch).option("checkpointLocation", state)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()
