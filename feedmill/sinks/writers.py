"""Sinks: CSV, text, JSON and Parquet, laid out by type and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a task, as a power of two, that may go to one partition value's file together.
BLOCK_BITS = 19


def _block() -> Column:
    """Number of the block of rows inside the task that brings them."""
    return F.shiftright(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)), BLOCK_BITS)


def _by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """One file per partition value, more for large ones, instead of one per task and value.

    Spark splits a large value by the tasks that bring its rows. One task can
    bring them all, so it brings them in blocks: the task that writes them, and
    sorts them for it, holds a few blocks whatever the number of rows.
    """
    return df.withColumn("_block", _block()).hint("rebalance", *columns, "_block").drop("_block")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Normalised table as CSV. [SNK1]"""
    # Spark's CSV writer trims cells unless told not to.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, quote='"', escape='"', **kept).csv(path)


def write_texts(
    df: DataFrame, path: str, text: str = "normalized_text", skip_empty: bool = True, by: str = "output_key",
    mode: str = "overwrite",
) -> None:
    """Texts with their output key, stored by data type. [SNK2]

    Empty OCR and call texts are not written, empty survey texts are
    (``skip_empty=False``). A lake table holds many texts per file: the key is
    kept as a column instead of a path, so a million texts are not a million files.
    """
    rows = df.filter(F.coalesce(F.length(text), F.lit(0)) > 0) if skip_empty else df
    kept = rows.select("data_type", by, F.col(text).alias("text"))
    _by_partition(kept, "data_type").write.mode(mode).partitionBy("data_type").json(path)


def write_insights(df: DataFrame, path: str, mode: str = "append") -> None:
    """Insight records by type and day. [SNK3]"""
    day = F.date_format("timestamp", "yyyy-MM-dd")
    _by_partition(df.withColumn("dt", day), "data_type", "dt").write.mode(mode).partitionBy("data_type", "dt").json(path)


def write_reports(df: DataFrame, path: str, mode: str = "append") -> None:
    """Quality reports by type. [SNK4]"""
    _by_partition(df, "data_type").write.mode(mode).partitionBy("data_type").json(path)


def write_clean(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Cleaned reviews as Parquet by top category, if there is one. [ETL11, SNK5]

    The table is replaced as a whole. With ``dynamic`` only the categories
    present are, so that one feed leaves the categories of others alone.
    """
    parted = "top_category" in df.columns
    rows = _by_partition(df, "top_category") if parted else df
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    (writer.partitionBy("top_category") if parted else writer).parquet(path)


def append_points(df: DataFrame, path: str, mode: str = "append") -> None:
    """Metric points, by metric name. [SNK6]"""
    _by_partition(df, "metric").write.mode(mode).partitionBy("metric").parquet(path)
