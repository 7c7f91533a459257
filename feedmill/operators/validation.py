"""Row checks for free text and the quality summary built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.operators.ordering import keys

# Limits and issue names.
MIN_LENGTH = 10
MAX_LENGTH = 10_000
MIN_DIVERSITY = 0.20
ISSUES = (
    "empty_review",
    "too_short",
    "too_long",
    "content_is_urls_or_html_only",
    "low_vocabulary_diversity",
    "invalid_encoding",
)
NO_CONTENT = "no_content_found"


def validate(df: DataFrame, col: str, null_issue: str = "empty_review") -> DataFrame:
    """Add ``issues`` (array of names) and ``is_valid`` (no issue). [VAL1-VAL7]

    A blank text has the single issue ``empty_review``. ``null_issue`` names the
    issue of a missing cell, which some table readers report as ``too_short``.
    """
    # Trimmed and cleaned text are used by several checks: one projection each.
    staged = df.withColumn("_text", tx.strip(F.col(col)))
    cleaned = tx.strip(tx.strip_urls(tx.strip_html(F.col("_text"))))
    staged = staged.withColumn("_clean", cleaned)
    staged = staged.withColumn("_words", tx.words(F.lower("_clean"), stripped=True))
    total = F.size("_words")
    distinct = F.size(F.array_distinct("_words"))
    checks = F.array_compact(
        F.array(
            F.when(F.length("_text") < MIN_LENGTH, "too_short"),
            F.when(F.length("_text") > MAX_LENGTH, "too_long"),
            F.when(F.col("_clean") == "", "content_is_urls_or_html_only"),
            F.when((total > 0) & (distinct / total < MIN_DIVERSITY), "low_vocabulary_diversity"),
            F.when(~F.is_valid_utf8(F.col(col)), "invalid_encoding"),
        )
    )
    issues = (
        F.when(F.col(col).isNull(), F.array(F.lit(null_issue)))
        .when(F.col("_text") == "", F.array(F.lit("empty_review")))
        .otherwise(checks)
    )
    return (
        staged.withColumn("issues", issues)
        .withColumn("is_valid", F.size("issues") == 0)
        .drop("_text", "_clean", "_words")
    )


def _issue_counts() -> dict[str, Column]:
    return {name: F.count_if(F.array_contains("issues", name)) for name in ISSUES}


def issue_histogram(df: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Rows per issue, over all rows or per group. [VAL8]

    Counted side by side and turned into rows afterwards, so no row is
    multiplied before the shuffle.
    """
    by = keys(by)
    counted = df.groupBy(*by).agg(*[count.alias(f"_{name}") for name, count in _issue_counts().items()])
    rows = F.array(*[F.struct(F.lit(n).alias("issue"), F.col(f"_{n}").alias("cnt")) for n in ISSUES])
    return counted.select(*by, F.explode(rows).alias("_i")).select(*by, "_i.*").filter("cnt > 0")


def validation_summary(
    df: DataFrame, by: str | Sequence[str] = "source_key", files: DataFrame | None = None
) -> DataFrame:
    """Counts, score and issue map per group (``by=()``: one row for all). [VAL9]

    ``files`` lists every group that must appear; one without rows scores 0
    with the single issue ``no_content_found``.
    """
    by = keys(by)
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        *[count.alias(f"_{name}") for name, count in _issue_counts().items()],
    )
    if files is not None:
        counted = files.select(*by).distinct().join(counted, by, "left")
    counted = counted.fillna(0, ["total_rows", "valid_rows", *[f"_{name}" for name in ISSUES]])
    entries = F.filter(
        F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"_{n}").alias("value")) for n in ISSUES]),
        lambda e: e["value"] > 0,
    )
    summary = summary_of(F.col("total_rows"), F.col("valid_rows"), F.map_from_entries(entries))
    return counted.select(*by, summary.alias("_s")).select(*by, "_s.*")


def summary_of(total: Column, valid: Column, issues: Column) -> Column:
    """The summary as a struct, from the number of rows, of valid rows, and of rows per issue. [VAL9]"""
    none_found = F.create_map(F.lit(NO_CONTENT), F.lit(1).cast("bigint"))
    score = F.round(F.try_divide(valid, total) * 100, 2)
    return F.struct(
        total.alias("total_rows"),
        valid.alias("valid_rows"),
        (total - valid).alias("invalid_rows"),
        F.coalesce(score, F.lit(0.0)).alias("quality_score"),
        F.when(total == 0, none_found).otherwise(issues).alias("validation_issues"),
    )


def issue_total(issues: Column) -> Column:
    """All issues of a summary's issue map."""
    return F.aggregate(F.map_values(issues), F.lit(0).cast("bigint"), lambda a, b: a + b)
