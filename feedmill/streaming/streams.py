"""Streams: intake, cleaning, windows, dedup and the per-batch flow."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedmill.functions import keys
from feedmill.functions import text as tx
from feedmill.operators.metrics import DASHBOARD
from feedmill.operators.routing import split_dead_letters, with_data_type
from feedmill.operators.validation import validate
from feedmill.sources.readers import key_from_path


def stream_objects(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """New objects under the four prefixes, each exactly once per checkpoint. [STR1]"""
    folders = ",".join(p.rstrip("/") for p in keys.DATA_TYPES)
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(f"{root.rstrip('/')}/{{{folders}}}")
    )
    return with_data_type(
        files.select(
            key_from_path(F.col("path"), root).alias("source_key"), F.col("modificationTime").alias("ts"), "length", "content"
        )
    )


def stream_loads(spark: SparkSession, folder: str, schema: StructType, loads: int) -> DataFrame:
    """The files that lie in a Parquet folder as a stream of at most ``loads`` micro-batches.

    Each batch has a fixed cost, and one file is one task for what follows: a
    batch therefore takes its share of the files, however many there are.
    """
    files = len(spark.read.schema(schema).parquet(folder).inputFiles())
    share = max(1, -(-files // loads))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", share).parquet(folder)


def stream_clean(rows: DataFrame, col: str = "review_content", normalize: bool = True) -> DataFrame:
    """Validated (and normalised) rows with their type; stateless. [STR2]"""
    checked = validate(with_data_type(rows), col)
    return checked.withColumn(f"{col}_normalized", tx.normalize_text(F.col(col))) if normalize else checked


def stream_dashboard(
    points: DataFrame,
    period: str = "5 minutes",
    delay: str = "10 minutes",
    metrics: Sequence[str] = tuple(DASHBOARD),
) -> DataFrame:
    """Windowed sums and averages; points later than ``delay`` are dropped. [STR3]"""
    return (
        points.filter(F.col("metric").isin(*metrics))
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", period).alias("_w"), "metric")
        .agg(F.count("value").alias("points"), F.sum(F.col("value").cast("decimal(28,8)")).cast("double").alias("total"))
        .select(
            F.col("_w.start").alias("window_start"), "metric", "points", "total", (F.col("total") / F.col("points")).alias("average")
        )
    )


def stream_dedup(rows: DataFrame, by: Sequence[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """First row per key among rows at most ``delay`` apart. [STR4]"""
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(list(by))


def start_batches(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    dead_letters: str | None = None,
    error_col: str = "error",
    once: bool = True,
) -> StreamingQuery:
    """Run ``process`` on every micro-batch. [STR5, STR6]

    Rows with an error go to the ``dead_letters`` table and the others go on. A
    batch may be repeated after a failure, so each batch overwrites the dead
    letters stored under its own number.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        good = batch
        if dead_letters and error_col in batch.columns:
            good, bad = split_dead_letters(batch, error_col)
            bad.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
        process(good, batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there, append it to a Parquet table, and read that back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
