"""Table-level text normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.operators.ordering import first_k, keys

SEPARATOR = "\n\n---\n\n"


def normalize_column(df: DataFrame, col: str = "review_content", out: str | None = None) -> DataFrame:
    """Add the normalised column; a table without ``col`` passes unchanged. [NRM10]"""
    if col not in df.columns:
        return df
    return df.withColumn(out or f"{col}_normalized", tx.normalize_text(F.col(col)))


def sample_text(
    df: DataFrame,
    text: str = "review_content_normalized",
    by: str = "source_key",
    order: str = "row_no",
    n: int = 50,
) -> DataFrame:
    """First ``n`` rows of each file, blanks dropped after the cut, joined. [NRM11]

    To clean only what is sampled, cut the raw table with ``first_rows`` first.
    """
    by = keys(by)
    kept = first_k(df.select(*by, order, text), by, [F.col(order)], n, "_rank")
    row = F.when(~tx.is_blank(F.col(text)), F.struct(F.col(order), F.col(text)))
    rows = F.array_sort(F.collect_list(row))
    return kept.groupBy(*by).agg(
        F.array_join(F.transform(rows, lambda r: r[text]), SEPARATOR).alias("normalized_text")
    )


def pick_raw_text(df: DataFrame, out: str = "raw_input") -> DataFrame:
    """The text to normalise: audio takes transcript then raw text, other types
    raw text then extracted text; an empty text counts as missing. [NRM12]"""
    audio = F.coalesce(F.nullif("transcript", F.lit("")), F.nullif("raw_text", F.lit("")), F.lit(""))
    other = F.coalesce(F.nullif("raw_text", F.lit("")), F.nullif("extracted_text", F.lit("")), F.lit(""))
    return df.withColumn(out, F.when(F.col("data_type") == "audio", audio).otherwise(other))
