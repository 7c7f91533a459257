"""Cutting file texts into the segments that annotators see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.operators.ordering import number_rows

BATCH_SIZE = 25


def segment(df: DataFrame, text: str = "normalized_text", max_bytes: int | None = None) -> DataFrame:
    """One row per ``---``-separated part: ``seg_no`` from 0 and ``segment``. [NLP1]

    Blank parts go; a text of separators only is its own single segment; blank
    texts give no rows. ``max_bytes`` cuts segments for size-limited scorers.
    """
    parts = F.filter(
        F.transform(F.split(text, "---"), lambda p: tx.strip(p)), lambda p: p != ""
    )
    # A text of separators only has no parts but is not blank.
    whole = F.filter(F.array(F.col(text)), lambda t: tx.strip(t) != "")
    chosen = F.when(F.size(parts) > 0, parts).otherwise(whole)
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, F.posexplode_outer(chosen).alias("seg_no", "segment"))
    rows = rows.filter("segment is not null")
    rows = rows.withColumn("seg_no", F.col("seg_no").cast("bigint"))
    return rows if max_bytes is None else cut_segments(rows, max_bytes)


def segments_from_rows(
    df: DataFrame, text: str = "review_content_normalized", order: str = "row_no"
) -> DataFrame:
    """Every non-blank row as one segment, numbered by its place in the file.

    Normalised rows hold no separator, so this equals joining all rows of a file
    and splitting them again, without ever building the joined text.
    """
    rest = [c for c in df.columns if c not in (text, order)]
    rows = df.select(
        *rest,
        F.col(order).cast("bigint").alias("seg_no"),
        F.explode_outer(tx.one_if_filled(F.col(text))).alias("segment"),
    )
    return rows.filter("segment is not null")


def cut_segments(df: DataFrame, max_bytes: int = 5000) -> DataFrame:
    """Apply the byte limit of a hosted scorer. [NLP2]"""
    return df.withColumn("segment", tx.truncate_bytes(F.col("segment"), max_bytes))


def batch_of(seg_no: Column, size: int = BATCH_SIZE) -> Column:
    return F.floor(seg_no / size).cast("bigint")


def with_batch_id(
    df: DataFrame, by: str = "source_key", order: str = "seg_no", size: int = BATCH_SIZE, dense: bool = True
) -> DataFrame:
    """Number batches of ``size`` segments in order. [NLP3]

    ``segment`` numbers densely, so the batch is arithmetic. ``dense=False``
    first numbers the rows of each file, block by block.
    """
    if dense:
        return df.withColumn("batch_id", batch_of(F.col(order), size))
    numbered = number_rows(df, by, order, "_n")
    return numbered.withColumn("batch_id", batch_of(F.col("_n") - 1, size)).drop("_n")
