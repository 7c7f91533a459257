"""Final quality score, report and review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import signals

THRESHOLD = 70.0


def entity_count(nlp: Column) -> Column:
    total = F.aggregate(
        F.map_values(nlp["entities"]["counts_by_type"]), F.lit(0).cast("bigint"), lambda a, b: a + b
    )
    return F.coalesce(total, F.lit(0))


def phrase_count(nlp: Column) -> Column:
    phrases = nlp["key_phrases"]
    return F.when(phrases.isNull(), 0).otherwise(F.size(phrases))


def score_quality(
    df: DataFrame,
    insights: str = "insights",
    base: str = "base_score",
    entities: str = "entity_count",
    phrases: str = "phrase_count",
    profile: str = "current",
) -> DataFrame:
    """Add hits, boost, adjustment, concerns and the final score. [QLT1-QLT5]"""
    text = F.col(insights)
    staged = df.withColumns(
        {
            "positive_hits": signals.positive_hits(text),
            "concern_hits": signals.concern_hits(text, profile),
            "concerns": signals.concern_signals(text, profile),
            "comprehension_boost": signals.richness_boost(F.col(entities), F.col(phrases)),
        }
    )
    adjust = signals.adjustment(F.col("positive_hits"), F.col("concern_hits"), profile)
    return staged.withColumn("model_adjustment", adjust.cast("double")).withColumn(
        "final_score",
        signals.final_score(F.col(base), F.col("comprehension_boost"), F.col("model_adjustment")),
    )


def quality_status(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``needs_reprocessing`` (score below the threshold) and ``quality_status``."""
    low = F.col("final_score") < threshold
    return df.withColumns(
        {"needs_reprocessing": low, "quality_status": F.when(low, "needs_review").otherwise("passed")}
    )


def quality_report(df: DataFrame, threshold: float = THRESHOLD, base: str = "base_score") -> DataFrame:
    """One report per file. [QLT6]"""
    # The field names of a report.
    return quality_status(df, threshold).select(
        "data_type",
        "source_key",
        F.col("ts").alias("timestamp"),
        "quality_status",
        F.struct(
            F.coalesce(base, F.lit(50.0)).alias("base_score_from_validation"),
            F.round("comprehension_boost", 2).alias("comprehend_boost"),
            F.round("model_adjustment", 2).alias("model_adjustment"),
            F.col("final_score"),
            F.col("concerns").alias("model_concerns_identified"),
        ).alias("score_breakdown"),
        "needs_reprocessing",
        F.lit(threshold).alias("threshold"),
    )


def review_queue(reports: DataFrame) -> DataFrame:
    """One row per file that needs review, with its tags. [QLT7]"""
    return reports.filter("needs_reprocessing").select(
        "source_key",
        "data_type",
        F.create_map(
            F.lit("quality_status"),
            F.col("quality_status"),
            F.lit("quality_score"),
            F.col("score_breakdown.final_score").cast("string"),
            F.lit("reviewed_at"),
            F.col("timestamp").cast("string"),
        ).alias("tags"),
    )
