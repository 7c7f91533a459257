"""The whole feedback flow over many files at once.

Inputs are tables keyed by ``source_key``; every per-file step is a grouped
aggregate. The file state is written once before it is used several times, so
neither the annotation nor a model call runs again for each output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions import prompts
from feedmill.functions.keys import IMAGE_BYTE_LIMIT, fits_inline
from feedmill.functions.text import normalize_text
from feedmill.operators import aggregation, answers, dialogs, metrics, normalization, quality, routing, segments, validation
from feedmill.operators.ordering import first_rows
from feedmill.schemas import NLP_TYPE, VALIDATION_TYPE
from feedmill.sinks import commits, writers
from feedmill.sources import payloads
from feedmill.streaming import filestate

#: Rows of a file that a prompt quotes; all rows are annotated.
PROMPT_ROWS = 50
ANALYSED = ("text_reviews", "audio")
# Columns every branch contributes to the file state.
STATE = {
    "bucket": "string",
    "source_key": "string",
    "data_type": "string",
    "ts": "timestamp",
    "length": "bigint",
    "transcript": "string",
    "extracted_text": "string",
    "survey_summary": "string",
    "normalized_text": "string",
    "validation": VALIDATION_TYPE,
    "nlp": NLP_TYPE,
    "rows_left_out": "bigint",
}


def _conform(df: DataFrame) -> DataFrame:
    """Branch columns in state order, absent ones as null."""
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in STATE.items()]
    )


def review_files(
    rows: DataFrame, files: DataFrame, sample_n: int | None = None, prompt_rows: int = PROMPT_ROWS
) -> DataFrame:
    """Validation, sample text and NLP of every review file.

    All rows reach the annotators, or the first ``sample_n`` of a file if the
    caller says so. A prompt has to fit a model, so it quotes the first
    ``prompt_rows``; ``rows_left_out`` counts the others.
    """
    rows = rows.select("source_key", "row_no", "review_content")
    # Cut to the sample before the costly cleaning.
    sample = first_rows(rows, "source_key", "row_no", prompt_rows)
    if sample_n is None:
        return review_state(files, aggregation.review_counts(rows), sample, prompt_rows)
    # Validation sees all rows, the annotators a part.
    checked = validation.validate(rows, "review_content")
    summary = validation.validation_summary(checked, "source_key", files)
    summary = summary.select("source_key", F.struct(*summary.columns[1:]).alias("validation"), F.col("total_rows").alias("rows"))
    read = first_rows(rows, "source_key", "row_no", sample_n)
    parts = segments.segments_from_rows(normalization.normalize_column(read).drop("review_content"))
    return _review_state(files, summary.join(aggregation.nlp_results(files, parts), "source_key", "left"), sample, prompt_rows)


def review_state(files: DataFrame, counts: DataFrame, sample: DataFrame, prompt_rows: int = PROMPT_ROWS) -> DataFrame:
    """The state of review files from their counts (``review_counts``) and the raw rows that a prompt quotes."""
    return _review_state(files, aggregation.file_results(files, counts), sample, prompt_rows)


def _review_state(files: DataFrame, results: DataFrame, sample: DataFrame, prompt_rows: int) -> DataFrame:
    texts = normalization.sample_text(normalization.normalize_column(sample), n=prompt_rows)
    left_out = F.greatest(F.col("rows") - prompt_rows, F.lit(0)).cast("bigint")
    results = results.withColumn("rows_left_out", left_out).drop("rows")
    state = files.join(results, "source_key", "left").join(texts, "source_key", "left")
    return _conform(state.withColumn("data_type", F.lit("text_reviews")))


def text_files(files: DataFrame, data_type: str, text: str) -> DataFrame:
    """One text per file: calls are normalised and analysed, others pass as they are."""
    typed = files.withColumn("data_type", F.lit(data_type))
    if data_type not in ANALYSED:
        return _conform(typed.withColumn("normalized_text", F.col(text)))
    normal = typed.withColumn("normalized_text", normalize_text(F.col(text)))
    parts = segments.segment(normal.select("source_key", "normalized_text"))
    nlp = aggregation.nlp_results(normal.select("source_key"), parts)
    return _conform(normal.join(nlp, "source_key", "left"))


def branches(
    reviews: DataFrame | None = None,
    review_list: DataFrame | None = None,
    ocr: DataFrame | None = None,
    calls: DataFrame | None = None,
    surveys: DataFrame | None = None,
    sample_n: int | None = None,
) -> list[DataFrame]:
    """Branch states of whatever kinds of input there are. [RT2]

    ``reviews`` are rows of review files, ``review_list`` their files (``source_key,
    ts``); ``ocr`` holds ``source_key, ts, length, ocr_json``, ``calls``
    ``source_key, ts, transcript_json``, ``surveys`` ``source_key, ts,
    survey_summary``. A failed reading is a null payload: its text is empty and
    the file goes on.
    """
    out = []
    if reviews is not None:
        files = review_list
        if files is None:
            files = reviews.select("source_key").distinct().withColumn("ts", F.lit(None).cast("timestamp"))
        out.append(review_files(reviews, files, sample_n))
    if ocr is not None:
        out.append(text_files(payloads.ocr_text(ocr).drop("ocr_json"), "images", "extracted_text"))
    if calls is not None:
        out.append(text_files(payloads.transcript_text(calls).drop("transcript_json"), "audio", "transcript"))
    if surveys is not None:
        out.append(text_files(surveys, "surveys", "survey_summary"))
    return out


def _keep(df: DataFrame, path: str) -> DataFrame:
    """Write the table and go on from its stored form."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_feedback(
    states: list[DataFrame],
    work_dir: str,
    model: Callable[[list[str]], list] | None = None,
    model_id: str = "none",
    profile: str = "current",
    threshold: float = quality.THRESHOLD,
    images: DataFrame | None = None,
    notices: DataFrame | None = None,
    frames: prompts.Frames = prompts.Frames(),
    limits: prompts.Limits = prompts.Limits(),
    inline_bytes: int = IMAGE_BYTE_LIMIT,
    answer_store: str | None = None,
) -> dict[str, DataFrame]:
    """From branch states to insights, reports, review queue and metric points.

    ``states`` come from ``branches``. Without a model the files are scored on
    validation and annotations alone. ``images`` (``source_key, length,
    content``) puts images of up to ``inline_bytes`` into their prompts; the
    bytes are not stored, ``image_inline`` tells which were. ``notices`` (``ts,
    data_type, status``, from ``parse_notifications``) adds starts, failures and
    skipped objects to points and summary. Files of an unknown type become
    ``dead_letters``; only the others go on. With an ``answer_store`` only
    requests are sent that this table does not answer.
    """
    state = states[0]
    for branch in states[1:]:
        state = state.unionByName(branch)
    state = _keep(state, f"{work_dir}/state")
    known = F.coalesce("data_type", F.lit("unknown")) != "unknown"
    dead = state.filter(~known).withColumn("error", F.lit("unknown data type"))
    state = state.filter(known)
    asked = state
    if images is not None and model is not None:
        small = images.filter(fits_inline(F.col("length"), inline_bytes)).select("source_key", "content")
        asked = state.join(small, "source_key", "left")
    answered = dialogs.build_messages(asked, frames, limits, inline_bytes)
    if model is None:
        none = {c: F.lit(None).cast("string") for c in ("insights", "top_priority_action", "error")}
        answered = answered.withColumns({**none, "input_tokens": F.lit(0).cast("bigint")})
    else:
        answered = dialogs.run_dialog(answered, model, call=answers.stored_caller(answer_store) if answer_store else None)
    answered = answered.drop("messages", "content")
    if model is not None:
        # A model call is not repeated for each output; without one there is nothing to keep.
        answered = _keep(answered, f"{work_dir}/answers")
    scored = quality.score_quality(
        answered.withColumns(
            {
                "base_score": F.col("validation.quality_score"),
                "entity_count": quality.entity_count(F.col("nlp")),
                "phrase_count": quality.phrase_count(F.col("nlp")),
            }
        ),
        profile=profile,
    )
    finished = scored.withColumn("final_quality_score", F.col("final_score"))
    finished = finished.withColumn("pipeline_status", F.lit("SUCCEEDED"))
    reports = quality.quality_report(scored, threshold)
    points = metrics.metric_points(finished)
    if notices is not None:
        points = points.unionByName(metrics.notification_points(notices))
    return {
        "state": finished,
        "insights": dialogs.insight_records(answered, model_id),
        "reports": reports,
        "review_queue": quality.review_queue(reports),
        "points": points,
        "stage_points": metrics.validation_points(
            state.filter("validation is not null").select("ts", "validation.*")
        )
        .unionByName(metrics.nlp_points(state.filter("nlp is not null")))
        .unionByName(metrics.extraction_points(finished))
        .unionByName(metrics.quality_points(reports)),
        "summary": metrics.run_summary(finished, metrics.metric_points(finished), notices),
        "dead_letters": dead,
    }


def write_outputs(out: dict[str, DataFrame], path: str, run: str, rows: DataFrame | None = None) -> None:
    """All sinks of one run; repeating the run replaces its own output only.

    ``rows`` are the review rows; with them the normalised table is stored too.
    """
    state = out["state"]
    writers.write_insights(out["insights"], f"{path}/insights/run={run}", "overwrite")
    writers.write_reports(out["reports"], f"{path}/quality-reports/run={run}", "overwrite")
    out["review_queue"].write.mode("overwrite").parquet(f"{path}/review-queue/run={run}")
    points = out["points"].unionByName(out["stage_points"])
    writers.append_points(points, f"{path}/metrics/run={run}", "overwrite")
    out["summary"].write.mode("overwrite").json(f"{path}/summary/run={run}")
    out["dead_letters"].write.mode("overwrite").parquet(f"{path}/dead-letters/run={run}")
    kept = {"images": ("extracted_text", "ocr", True), "audio": ("transcript", "transcript", True), "surveys": ("survey_summary", "survey", False)}
    for kind, (text, key, skip_empty) in kept.items():
        texts = routing.with_output_key(state.filter(F.col("data_type") == kind), key)
        writers.write_texts(texts, f"{path}/texts/{kind}/run={run}", text, skip_empty, mode="overwrite")
    if rows is not None:
        normal = normalization.normalize_column(rows)
        writers.write_csv(normal, f"{path}/normalized/run={run}")


def commit_outputs(out: dict[str, DataFrame], path: str, run: str, rows: DataFrame | None = None) -> str:
    """``write_outputs`` as one commit: readers (``commits.read_sink``) see all sinks of a run or none."""
    spark = out["state"].sparkSession
    return commits.commit_run(spark, path, run, lambda folder: write_outputs(out, folder, run, rows))


def remove_work(spark: SparkSession, work_dir: str) -> None:
    """Delete the work tables of a run, once its outputs are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def batch_flow(
    work_dir: str,
    out_dir: str,
    build: Callable[[DataFrame], list[DataFrame]],
    model: Callable[[list[str]], list] | None = None,
    model_id: str = "none",
) -> Callable[[DataFrame, int], None]:
    """The flow as a function of one micro-batch, for ``start_batches``. [STR5]

    ``build`` turns the batch's good rows into branch states.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        folder = f"{work_dir}/batch={batch_id}"
        write_outputs(run_feedback(build(batch), folder, model, model_id), out_dir, str(batch_id))
        remove_work(batch.sparkSession, folder)

    return process


def file_flow(
    state_dir: str,
    work_dir: str,
    out_dir: str,
    model: Callable[[list[str]], list] | None = None,
    model_id: str = "none",
    prompt_rows: int = PROMPT_ROWS,
) -> Callable[[DataFrame, int], None]:
    """The flow over review rows as they come, for ``start_batches``. [STR5]

    A file's rows may be spread over any number of micro-batches. Each batch
    renews the results of the files it touches under its own run; ``latest``
    picks the last result of each file.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        run = f"{batch_id:012d}"
        folder = f"{work_dir}/batch={batch_id}"
        touched = filestate.add_rows(batch, state_dir, run, prompt_rows)
        state = review_state(touched.files, touched.counts, touched.rows, prompt_rows)
        write_outputs(run_feedback([state], folder, model, model_id), out_dir, run)
        remove_work(batch.sparkSession, folder)

    return process
