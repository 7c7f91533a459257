"""Cleaning of review tables into an analysis-ready table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedmill.functions import numbers
from feedmill.operators.ordering import first_k

MIN_CONTENT = 10
FILE_ORDER = ("source_key", "row_no")
PRICES = ("discounted_price", "actual_price")


def clean_numbers(df: DataFrame) -> DataFrame:
    """Rating, percentage, prices and count as numbers, where present. [ETL1-ETL4]"""
    plan = {
        "rating": numbers.digits_to_double,
        "discount_percentage": numbers.percent_to_double,
        **{c: numbers.digits_to_double for c in PRICES},
        "rating_count": numbers.grouped_to_int,
    }
    return df.withColumns({c: f(F.col(c)) for c, f in plan.items() if c in df.columns})


def keep_condition() -> Column:
    """Content longer than ten characters, product known, rating within 1..5."""
    return F.coalesce(
        (F.length("review_content") > MIN_CONTENT)
        & F.col("product_id").isNotNull()
        & F.col("rating").between(1, 5),
        F.lit(False),
    )


def quality_filter(df: DataFrame) -> DataFrame:
    """[ETL5]"""
    return df.filter(keep_condition())


def dedup_reviews(df: DataFrame, key: str = "review_id", order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """First row per key by ``order``; rows without a key count as one key. [ETL6]

    Files go in the order of their keys and rows in the order of their file, so
    the survivor is the same however the files are read; order columns the table
    lacks are left out.
    """
    if key not in df.columns:
        return df
    order = [c for c in order if c in df.columns]
    return first_k(df, key, [F.col(c) for c in order], 1, "_rank").drop("_rank")


def add_features(df: DataFrame) -> DataFrame:
    """Length, image flag, top category and rating-based sentiment. [ETL7-ETL10]"""
    features = {
        "review_length": F.length("review_content"),
        "sentiment_proxy": F.when(F.col("rating") >= 4, "POSITIVE")
        .when(F.col("rating") <= 2, "NEGATIVE")
        .otherwise("NEUTRAL"),
    }
    if "img_link" in df.columns:
        features["has_image_url"] = F.coalesce(F.length("img_link") > 10, F.lit(False))
    if "category" in df.columns:
        features["top_category"] = F.split("category", r"\|")[0]
    return df.withColumns(features)


def clean_reviews(df: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """The whole job as one plan. [ETL13]"""
    return add_features(dedup_reviews(quality_filter(clean_numbers(df)), order=order))


def stage_counters(df: DataFrame, key: str = "review_id") -> DataFrame:
    """Rows loaded, kept by the filter and left after dedup, in one pass. [ETL12]

    Counting per key first gives the number of distinct kept keys (null being
    one of them) without sorting or comparing whole rows.
    """
    rows = clean_numbers(df).select(
        *([key] if key in df.columns else []), keep_condition().alias("_keep")
    )
    kept = F.count_if("_keep")
    if key not in df.columns:
        return rows.agg(F.count(F.lit(1)).alias("loaded"), kept.alias("filtered"), kept.alias("deduped"))
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), kept.alias("_k"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum("_k"), F.lit(0)).alias("filtered"),
        F.count_if(F.col("_k") > 0).alias("deduped"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with a row counter that the next write fills in for free.

    A stage that is run again after a lost executor may count twice; use
    ``stage_counters`` where the numbers must be exact.
    """
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def run_etl(df: DataFrame, order: Sequence[str] = FILE_ORDER) -> tuple[DataFrame, DataFrame]:
    """Cleaned table and its stage counters. [ETL13]"""
    return clean_reviews(df, order), stage_counters(df)
