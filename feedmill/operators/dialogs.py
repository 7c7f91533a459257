"""From file state to model requests, answers and insight records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import keys, prompts
from feedmill.operators.annotation import score_batches
from feedmill.schemas import NLP_TYPE, VALIDATION_TYPE

RESPONSE_TYPE = (
    "output struct<message:struct<content:array<struct<text:string>>>>,"
    "usage struct<inputTokens:bigint>"
)


def _with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    )


def build_messages(
    df: DataFrame,
    frames: prompts.Frames = prompts.Frames(),
    limits: prompts.Limits = prompts.Limits(),
    inline_bytes: int = keys.IMAGE_BYTE_LIMIT,
) -> DataFrame:
    """Add ``messages`` by ``data_type``, ``left_out_chars`` and ``image_inline``. [PRM1-PRM6]

    Reads ``source_key, data_type, nlp, normalized_text, extracted_text,
    transcript, survey_summary, content, length``; missing columns count as null.
    ``left_out_chars`` is what the caller's limits keep from the prompt;
    ``image_inline`` says whether the image itself is in it.
    """
    texts = ("normalized_text", "extracted_text", "transcript", "survey_summary")
    given = df.columns
    full = _with_missing(
        df, {**{t: "string" for t in texts}, "content": "binary", "length": "bigint", "nlp": NLP_TYPE}
    )
    c = F.col
    kind = c("data_type")
    body = (
        F.when(kind == "text_reviews", F.coalesce("normalized_text", F.lit("")))
        .when(kind == "images", prompts.first_text(c("extracted_text"), c("normalized_text")))
        .when(kind == "audio", prompts.first_text(c("transcript"), c("normalized_text")))
        .when(kind == "surveys", prompts.first_text(c("survey_summary"), c("normalized_text")))
        .otherwise(prompts.first_text(c("normalized_text")))
    )
    inline = (kind == "images") & keys.fits_inline(c("length"), inline_bytes) & c("content").isNotNull()
    images = prompts.image_messages(body, c("content"), keys.image_format(c("source_key")), inline, frames, limits)
    text = F.when(kind == "text_reviews", prompts.review_prompt(c("source_key"), c("nlp"), body, frames, limits))
    for name, frame in (("audio", frames.audio), ("surveys", frames.survey)):
        text = text.when(kind == name, prompts.text_prompt(frame, body, limits))
    text = text.otherwise(prompts.text_prompt(frames.generic, body, limits))
    messages = F.when(kind == "images", images).otherwise(prompts.text_messages(text))
    return full.withColumns(
        {
            "messages": messages,
            "left_out_chars": prompts.left_out(body, limits).cast("bigint"),
            "image_inline": F.coalesce(inline, F.lit(False)),
        }
    ).select(*given, "messages", "left_out_chars", "image_inline")


def call_model(df: DataFrame, fn: Callable[[list[str]], list], batch: int = 25) -> DataFrame:
    """Send ``request`` bodies to the user's ``fn`` and add ``response`` and ``error``. [PRM8]

    A request that fails keeps its row with an ``error`` and no response; the
    others of its batch are sent again one by one.
    """
    return score_batches(df, fn, "response string", text="request", batch=batch, retry_rows=True)


def parse_model_response(df: DataFrame, json_col: str = "response") -> DataFrame:
    """Add ``insights`` (content texts joined by newline) and ``input_tokens``. [PRM9]"""
    parsed = df.withColumn("_r", F.from_json(json_col, RESPONSE_TYPE))
    blocks = F.transform("_r.output.message.content", lambda b: F.coalesce(b["text"], F.lit("")))
    return parsed.withColumns(
        {
            "insights": F.coalesce(F.array_join(blocks, "\n"), F.lit("")),
            "input_tokens": F.coalesce("_r.usage.inputTokens", F.lit(0)),
        }
    ).drop("_r")


def run_dialog(
    df: DataFrame, fn: Callable[[list[str]], list], batch: int = 25, call: Callable[..., DataFrame] | None = None
) -> DataFrame:
    """Both model calls: the analysis, then the follow-up on its answer. [PRM6-PRM9]

    A failed analysis leaves ``error`` set; a failed follow-up only leaves
    ``top_priority_action`` empty. ``input_tokens`` counts the first call.
    ``call`` stands in for ``call_model``, such as ``answers.stored_caller``.
    """
    given = df.columns
    call = call or call_model
    asked = call(df.withColumn("request", prompts.request_body(F.col("messages"))), fn, batch)
    answered = parse_model_response(asked).withColumnRenamed("error", "_error").drop("request", "response")
    dialog = prompts.followup_messages(F.col("messages"), F.col("_insights"))
    # A failed analysis has nothing to follow up on: its request stays null.
    body = F.when(F.col("_error").isNull(), prompts.request_body(dialog))
    again = answered.withColumnsRenamed({"insights": "_insights", "input_tokens": "_input_tokens"})
    again = call(again.withColumn("request", body), _skip_null(fn), batch)
    parsed = parse_model_response(again)
    return parsed.select(
        *given,
        F.when(F.col("_error").isNull(), F.col("_insights")).alias("insights"),
        F.when(F.col("_error").isNull(), F.col("insights")).alias("top_priority_action"),
        F.when(F.col("_error").isNull(), F.col("_input_tokens")).otherwise(F.lit(0)).alias("input_tokens"),
        F.col("_error").alias("error"),
    )


def _skip_null(fn: Callable[[list[str]], list]) -> Callable[[list], list]:
    def run(bodies: list) -> list:
        answers = iter(fn([b for b in bodies if b is not None]))
        return [None if b is None else next(answers) for b in bodies]

    return run


def insight_records(df: DataFrame, model_id: str) -> DataFrame:
    """Records of answered files; failed calls give none. [PRM10]"""
    full = _with_missing(
        df,
        {"bucket": "string", "top_priority_action": "string", "nlp": NLP_TYPE, "validation": VALIDATION_TYPE, "error": "string"},
    )
    return full.filter(F.col("error").isNull() & F.col("insights").isNotNull()).select(
        F.col("bucket").alias("source_bucket"),
        "source_key",
        "data_type",
        F.col("ts").alias("timestamp"),
        F.lit(model_id).alias("model_id"),
        "insights",
        F.coalesce("top_priority_action", F.lit("")).alias("top_priority_action"),
        "nlp",
        "validation",
    )
