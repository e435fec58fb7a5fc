"""Words that arrive as files: a stream of finished pages, and blocks of each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, max_files: int = 100) -> DataFrame:
    """Rows of parquet files as they come into a folder, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def deduplicated(stream: DataFrame, keys: tuple[str, ...] = ("fileid", "page", "word_idx"), time: str = "loaded_at", late: str = "7 days") -> DataFrame:
    """Each delivery of a word once; a delivery later than late after the newest one is dropped with its state."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def label_counts(stream: DataFrame, label: str = "segment", time: str = "loaded_at", window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts of labels by the window of delivery; a window is given out when it can change no more."""
    rows = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return rows.groupBy(F.window(time, window).alias("w"), F.col(label).alias("label")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "label", "n")


def run_batches(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Start a query that writes operator's result of each batch as parquet into out, a folder for each batch.

    A batch that runs again after a failure replaces its own folder, so results are neither lost nor doubled. The operator
    sees whole files: one that works on pages or files needs their words to come in one file.
    """

    def one(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
