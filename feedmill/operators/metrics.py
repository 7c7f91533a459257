"""Metric points, dashboard series, alarms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.numbers import safe_double
from feedmill.operators.quality import entity_count, phrase_count
from feedmill.operators.validation import issue_total

# Metric names and units.
STARTED = "PipelineExecutionsStarted"
SUCCEEDED = "PipelineExecutionsSucceeded"
FAILED = "PipelineExecutionsFailed"
FINAL_SCORE = "FinalDataQualityScore"
VALIDATION_SCORE = "ValidationQualityScore"
VALIDATION_FAILURES = "ValidationFailures"
SENTIMENT_COUNT = "SentimentCount"
ENTITIES = "EntitiesExtracted"
PHRASES = "KeyPhrasesExtracted"
INPUT_TOKENS = "BedrockInputTokens"
STAGE_SCORE = "DataQualityScore"
STAGE_ISSUES = "ValidationIssues"
ENTITIES_FOUND = "EntitiesFound"
DOMINANT_COUNT = "SentimentDistribution"
OCR_CHARACTERS = "TextractCharactersExtracted"
TRANSCRIPTION_JOBS = "TranscriptionJobsCompleted"
TRANSCRIPTION_CHARACTERS = "TranscriptionCharacters"
INSIGHTS = "InsightsGenerated"
REVIEWS_NEEDED = "RecordsNeedingReview"

#: Dashboard series: metric -> statistic.
DASHBOARD = {
    STARTED: "sum",
    SUCCEEDED: "sum",
    FAILED: "sum",
    VALIDATION_FAILURES: "sum",
    FINAL_SCORE: "avg",
}


def _dims(**dims: Column) -> Column:
    parts = [x for name, value in dims.items() for x in (F.lit(name), value)]
    return F.create_map(*parts) if parts else F.expr("cast(map() as map<string,string>)")


def _point(metric: str, value: Column, unit: str, dims: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        F.lit(unit).alias("unit"),
        dims.alias("dims"),
    )


def _emit(df: DataFrame, points: Column, ts: str = "ts") -> DataFrame:
    # Outer, so that the optimizer does not build the array once more to test its size.
    rows = df.select(ts, F.explode_outer(points).alias("_p")).select(ts, "_p.*")
    return rows.filter("metric is not null")


def metric_points(state: DataFrame) -> DataFrame:
    """Points of finished and failed files. [MET1, MET2]

    Reads ``ts, data_type, pipeline_status, final_quality_score, validation, nlp,
    input_tokens``. A file whose status is not SUCCEEDED gives a failure point
    and nothing else; a table without the column holds finished files only. Each
    metric is emitted once, with its dimensions; ``metric_rollup`` adds the
    totals without dimensions.
    """
    kind = F.coalesce("data_type", F.lit("unknown"))
    dims = _dims(DataType=kind)
    c = F.col
    invalid = safe_double(c("validation.invalid_rows"))
    tokens = safe_double(c("input_tokens"))
    has_validation = c("validation").isNotNull()
    done = F.lit(True)
    if "pipeline_status" in state.columns:
        done = F.coalesce(c("pipeline_status") == "SUCCEEDED", F.lit(False))
    single = F.array(
        _point(SUCCEEDED, F.lit(1.0), "Count", dims),
        F.when(
            c("final_quality_score").isNotNull(),
            _point(FINAL_SCORE, safe_double(c("final_quality_score")), "None", dims),
        ),
        F.when(has_validation, _point(VALIDATION_SCORE, safe_double(c("validation.quality_score")), "None", dims)),
        F.when(has_validation & (invalid > 0), _point(VALIDATION_FAILURES, invalid, "Count", dims)),
        F.when(entity_count(c("nlp")) > 0, _point(ENTITIES, entity_count(c("nlp")), "Count", dims)),
        F.when(phrase_count(c("nlp")) > 0, _point(PHRASES, phrase_count(c("nlp")), "Count", dims)),
        F.when(tokens > 0, _point(INPUT_TOKENS, tokens, "Count", dims)),
    )
    labels = F.transform(
        F.map_entries(F.coalesce("nlp.sentiment.counts", F.expr("cast(map() as map<string,bigint>)"))),
        lambda e: _point(
            SENTIMENT_COUNT, e["value"], "Count", _dims(DataType=kind, Sentiment=e["key"])
        ),
    )
    failed = F.array(_point(FAILED, F.lit(1.0), "Count", dims))
    return _emit(state, F.when(done, F.concat(F.array_compact(single), labels)).otherwise(failed))


def notification_points(notices: DataFrame) -> DataFrame:
    """A start per object that enters the flow, a failure per bad record. [MET3]

    Reads ``ts, data_type, status`` as ``parse_notifications`` gives them;
    skipped objects and records of unknown shape give no point.
    """
    dims = _dims(DataType=F.coalesce("data_type", F.lit("unknown")))
    point = F.when(F.col("status") == "started", _point(STARTED, F.lit(1.0), "Count", dims)).when(
        F.col("status") == "failed", _point(FAILED, F.lit(1.0), "Count", dims)
    )
    return _emit(notices.filter(F.col("status").isin("started", "failed")), F.array(point))


def _exact_sum(value: str) -> Column:
    """Sum that does not depend on the order of rows."""
    return F.sum(F.col(value).cast("decimal(28,8)"))


def validation_points(summary: DataFrame) -> DataFrame:
    """Score and number of issues per validated file. [MET7]"""
    dims = _dims(Stage=F.lit("Validation"))
    return _emit(
        summary,
        F.array(
            _point(STAGE_SCORE, F.col("quality_score"), "None", dims),
            _point(STAGE_ISSUES, issue_total(F.col("validation_issues")), "Count", dims),
        ),
    )


def nlp_points(state: DataFrame) -> DataFrame:
    """Entities found and the count of the dominant sentiment, per analysed file. [MET8]"""
    kind = F.coalesce("data_type", F.lit("unknown"))
    dominant = F.col("nlp.sentiment.dominant_sentiment")
    count = F.coalesce(F.try_element_at(F.col("nlp.sentiment.counts"), dominant), F.lit(0))
    return _emit(
        state.filter(~F.col("nlp.skipped")),
        F.array(
            _point(ENTITIES_FOUND, entity_count(F.col("nlp")), "Count", _dims(DataType=kind)),
            _point(DOMINANT_COUNT, count, "Count", _dims(Sentiment=dominant, DataType=kind)),
        ),
    )


def extraction_points(state: DataFrame) -> DataFrame:
    """Characters read from images and calls, tokens and insights of model calls. [MET10]"""
    dims = _dims(DataType=F.col("data_type"))
    images = F.lit("images")
    audio = F.lit("audio")
    done = F.col("data_type") == audio
    points = F.array(
        F.when(
            F.col("data_type") == images,
            _point(OCR_CHARACTERS, F.length(F.coalesce("extracted_text", F.lit(""))), "Count", dims),
        ),
        F.when(done & F.col("transcript").isNotNull(), _point(TRANSCRIPTION_JOBS, F.lit(1.0), "Count", dims)),
        F.when(
            done & F.col("transcript").isNotNull(),
            _point(TRANSCRIPTION_CHARACTERS, F.length("transcript"), "Count", dims),
        ),
        F.when(F.col("insights").isNotNull(), _point(INSIGHTS, F.lit(1.0), "Count", dims)),
    )
    return _emit(state, F.array_compact(points))


def quality_points(reports: DataFrame, ts: str = "timestamp") -> DataFrame:
    """1 per file that needs review, else 0. [QLT6]"""
    value = F.col("needs_reprocessing").cast("int")
    point = _point(REVIEWS_NEEDED, value, "Count", _dims(DataType=F.col("data_type")))
    return reports.select(F.col(ts).alias("ts"), point.alias("_p")).select("ts", "_p.*")


def metric_rollup(points: DataFrame) -> DataFrame:
    """Count, sum and average per metric and data type, and per metric alone. [MET3]

    One pass with grouping sets; ``data_type`` is null in the totals.
    """
    flat = points.select("metric", F.col("dims")["DataType"].alias("data_type"), "value")
    cols = [F.col("metric"), F.col("data_type")]
    return (
        flat.groupingSets([[cols[0], cols[1]], [cols[0]]], *cols)
        .agg(
            F.grouping("data_type").alias("is_total"),
            F.count("value").alias("points"),
            _exact_sum("value").cast("double").alias("total"),
            (_exact_sum("value").cast("double") / F.count("value")).alias("average"),
        )
        .filter("is_total = 1 or data_type is not null")
        .select("metric", "data_type", "is_total", "points", "total", "average")
    )


def dashboard_series(
    points: DataFrame, period: str = "5 minutes", metrics: Sequence[str] = tuple(DASHBOARD)
) -> DataFrame:
    """Points, sum and average per metric and period. [MET4]"""
    return (
        points.filter(F.col("metric").isin(*metrics))
        .groupBy(F.window("ts", period).alias("_w"), "metric")
        .agg(F.count("value").alias("points"), _exact_sum("value").cast("double").alias("total"))
        .withColumn("average", F.col("total") / F.col("points"))
        .select(F.col("_w.start").alias("window_start"), "metric", "points", "total", "average")
    )


def alarm(
    series: DataFrame, breach: Column, periods: int = 1, period: str = "5 minutes", by: Sequence[str] = ("metric",)
) -> DataFrame:
    """Windows at which ``breach`` has held for ``periods`` windows in a row.

    Missing windows do not breach. Each breaching window is counted at itself
    and the following windows it can contribute to; a window with a full count
    fires. That is one grouped count, with no ordered pass over a series.
    """
    low = series.filter(breach)
    if periods == 1:
        return low.select(*by, "window_start")
    step = F.expr(f"interval {period}")
    last = F.expr(f"window_start + {periods - 1} * interval {period}")
    return (
        low.select(*by, F.explode(F.sequence(F.col("window_start"), last, step)).alias("window_start"))
        .groupBy(*by, "window_start")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == periods)
        .drop("_n")
    )


def alarm_low_quality(
    series: DataFrame, threshold: float = 70.0, periods: int = 3, period: str = "5 minutes"
) -> DataFrame:
    """Average final score below the threshold, three windows in a row. [MET5]"""
    scores = series.filter(F.col("metric") == FINAL_SCORE)
    return alarm(scores, F.col("average") < threshold, periods, period)


def alarm_failures(series: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Sum of failures at or above the threshold in one window. [MET6]"""
    failures = series.filter(F.col("metric") == FAILED)
    return failures.filter(F.col("total") >= threshold).select("metric", "window_start", "total")


def sentiment_over_time(rows: DataFrame, period: str = "1 day", ts: str = "ts") -> DataFrame:
    """Share of each sentiment label per period. [MET9]"""
    counts = (
        rows.groupBy(F.window(ts, period).alias("_w"), "label")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("_w.start").alias("window_start"), "label", "cnt")
    )
    # A handful of labels per period is all the window sees.
    total = F.sum("cnt").over(Window.partitionBy("window_start"))
    return counts.withColumn("share", F.round(F.col("cnt") / total, 4))


def run_summary(state: DataFrame, points: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Files per type and outcome with the points they published. [MET11]

    Files without a type count as ``unknown``, as their points do. ``notices``
    (``data_type, status``) adds rows for objects that were started and skipped.
    """
    kind = F.coalesce("data_type", F.lit("unknown"))
    files = state.groupBy(kind.alias("data_type"), "pipeline_status").agg(
        F.count(F.lit(1)).alias("files"), F.max("ts").alias("completed_at")
    )
    if notices is not None:
        seen = notices.filter(F.col("status").isin("started", "skipped"))
        files = files.unionByName(
            seen.groupBy(kind.alias("data_type"), F.upper("status").alias("pipeline_status")).agg(
                F.count(F.lit(1)).alias("files"), F.lit(None).cast("timestamp").alias("completed_at")
            )
        )
    # A failed file's only point is its failure.
    outcome = F.when(F.col("metric") == FAILED, F.lit("FAILED")).otherwise(F.lit("SUCCEEDED"))
    published = points.groupBy(F.col("dims")["DataType"].alias("_kind"), outcome.alias("_outcome")).agg(
        F.count(F.lit(1)).alias("metrics_published")
    )
    same = (F.col("data_type") == F.col("_kind")) & (F.col("pipeline_status") == F.col("_outcome"))
    return files.join(published, same, "left").select(
        "data_type",
        "pipeline_status",
        "files",
        F.coalesce("metrics_published", F.lit(0)).alias("metrics_published"),
        "completed_at",
    )
