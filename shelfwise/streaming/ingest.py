"""Incremental ingestion with Structured Streaming: each new file once, through the same steps, with a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.sources.ingest import apply_steps


def stream_files(spark: SparkSession, folder: str, columns: list[str], sep: str = ",", header: bool = True, files_per_batch: int = 100) -> DataFrame:
    """New delimited files of a folder as string columns and ``_source_file``."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    reader = spark.readStream.schema(schema).option("sep", sep).option("header", header).option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).withColumn("_source_file", F.col("_metadata.file_name"))


def ingest_stream(stream: DataFrame, steps: str, target: str, log_path: str, checkpoint: str, extra: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append transformed batches to ``target`` partitioned by ``batch_id``; a batch that runs again overwrites its own partition.

    Processes what is there and stops; run again to go on from the checkpoint.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        out = apply_steps(batch, steps)
        out = extra(out) if extra else out
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        done = batch.sparkSession.read.parquet(f"{target}/batch_id={batch_id}").groupBy("_source_file").agg(F.count("*").alias("n_rows"))
        done.withColumns({"status": F.lit("SUCCESS"), "at": F.current_timestamp()}).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per window and key of a stream, with late rows accepted up to a bound."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
