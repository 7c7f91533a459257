"""Registered queries: payloads, prompts, model calls, quality, routing."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from feedmill.functions import keys, prompts, signals
from feedmill.operators import dialogs, quality, routing
from feedmill.plans import feedback
from feedmill.plans.nlp_queries import NLP_SQL
from feedmill.plans.registry import query
from feedmill.plans.table_queries import CHECKED
from feedmill.plans.views import NL, normalize_sql, quote, reviews, table
from feedmill.session import shared_dir
from feedmill.sources import payloads
from feedmill.streaming import filestate, streams

CALL_KEY = "'audio/call_' || conv_id || '_' || turn || '.mp3'"


def calls(spark, sf_dir):
    """Every conversation turn as the transcript of one call."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{CALL_KEY} as source_key", "'audio' as data_type", "text as transcript"
    )


# --- payloads ---------------------------------------------------------------


@query(
    "ocr_text",
    f"""WITH l AS (SELECT doc_id, string_split(text, {NL}) AS lines FROM documents)
SELECT doc_id, array_to_string(list_filter(lines, lambda t, i: i % 3 <> 0), {NL}) AS extracted_text,
  CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END AS pages, len(lines) + 1 AS block_count FROM l""",
)
def ocr_text(spark, sf_dir):
    """Lines become blocks, every third one a WORD block, behind one PAGE block."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda t, i: F.struct(F.when(i % 3 == 2, "WORD").otherwise("LINE").alias("BlockType"), t.alias("Text")),
    )
    page = F.array(F.struct(F.lit("PAGE").alias("BlockType"), F.lit(None).cast("string").alias("Text")))
    pages = F.when(F.col("doc_id") % 2 == 0, F.struct(F.lit(2).alias("Pages")))
    body = F.to_json(F.struct(F.concat(page, lines).alias("Blocks"), pages.alias("DocumentMetadata")))
    return payloads.ocr_text(table(spark, sf_dir, "documents").select("doc_id", body.alias("ocr_json"))).drop("ocr_json")


@query(
    "transcript_text",
    "SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN '' ELSE text END AS transcript FROM conversations",
)
def transcript_text(spark, sf_dir):
    found = F.array(F.struct(F.col("text").alias("transcript")))
    body = F.when(
        F.col("turn") % 5 == 4, F.to_json(F.struct(F.struct(F.slice(found, 1, 0).alias("transcripts")).alias("results")))
    ).otherwise(F.to_json(F.struct(F.struct(found.alias("transcripts")).alias("results"))))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", body.alias("transcript_json"))
    return payloads.transcript_text(rows).drop("transcript_json")


_BUCKET = "'in-' || page_id % 3"
_KEYS = "CASE page_id % 4 WHEN 0 THEN 'text-reviews/' WHEN 1 THEN 'images/' WHEN 2 THEN 'other/' ELSE 'surveys/' END || page_id"


@query(
    "parse_notifications",
    f"""WITH k AS (SELECT page_id, {_BUCKET} AS b, {_KEYS} AS k FROM pages),
r AS (SELECT page_id, b AS bucket, k AS source_key, true AS known FROM k WHERE page_id % 5 IN (0, 1, 2)
  UNION ALL SELECT page_id, b, 'audio/' || page_id || '.wav', true FROM k WHERE page_id % 5 = 1
  UNION ALL SELECT page_id, NULL, k, true FROM k WHERE page_id % 5 = 3
  UNION ALL SELECT page_id, NULL, NULL, false FROM k WHERE page_id % 5 = 4)
SELECT page_id, bucket, source_key,
  CASE WHEN source_key LIKE 'text-reviews/%' THEN 'text_reviews' WHEN source_key LIKE 'images/%' THEN 'images'
    WHEN source_key LIKE 'audio/%' THEN 'audio' WHEN source_key LIKE 'surveys/%' THEN 'surveys'
    WHEN source_key IS NOT NULL THEN 'unknown' END AS data_type,
  CASE WHEN NOT known THEN 'unrecognised' WHEN bucket IS NULL THEN 'failed'
    WHEN source_key LIKE 'other/%' THEN 'skipped' ELSE 'started' END AS status FROM r""",
)
def parse_notifications(spark, sf_dir):
    """Bodies in every known shape, one without a bucket and one of unknown shape."""
    rows = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_BUCKET} as b", f"{_KEYS} as k")
    kind = F.col("page_id") % 5

    def named(key, bucket=F.col("b")):
        return F.struct(F.struct(bucket.alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object"))

    second = F.concat(F.lit("audio/"), "page_id", F.lit(".wav"))
    two = F.array(F.struct(named(F.col("k")).alias("s3")), F.struct(named(second).alias("s3")))
    body = (
        F.when(kind == 0, F.to_json(F.struct(named(F.col("k")).alias("detail"))))
        .when(kind == 1, F.to_json(F.struct(two.alias("Records"))))
        .when(kind == 2, F.to_json(F.struct(F.array(F.struct(named(F.col("k")).alias("detail"))).alias("Records"))))
        .when(kind == 3, F.to_json(F.struct(named(F.col("k"), F.lit(None).cast("string")).alias("detail"))))
        .otherwise(F.to_json(F.struct(F.array(F.struct(F.col("k").alias("path"))).alias("Records"))))
    )
    parsed = payloads.parse_notifications(rows.select("page_id", body.alias("body")))
    return parsed.select("page_id", "bucket", "source_key", "data_type", "status")


# --- routing ----------------------------------------------------------------

_OBJECT_KEY = (
    "CASE page_id % 6 WHEN 0 THEN 'text-reviews/' WHEN 1 THEN 'images/' WHEN 2 THEN 'audio/' WHEN 3 THEN 'surveys/' "
    "WHEN 4 THEN 'Audio/' ELSE 'x/text-reviews/' END || 'f' || page_id || "
    "CASE page_id % 8 WHEN 0 THEN '.csv' WHEN 1 THEN '.JPG' WHEN 2 THEN '.mp3' WHEN 3 THEN '.txt' WHEN 4 THEN '' "
    "WHEN 5 THEN '.m4a' WHEN 6 THEN '.WAV' ELSE '.png' END"
)
_TYPE_SQL = (
    "CASE WHEN starts_with(k, 'text-reviews/') THEN 'text_reviews' WHEN starts_with(k, 'images/') THEN 'images' "
    "WHEN starts_with(k, 'audio/') THEN 'audio' WHEN starts_with(k, 'surveys/') THEN 'surveys' ELSE 'unknown' END"
)
_OBJECTS_SQL = f"""o AS (SELECT page_id, length(html) * (1 + page_id % 3 * 2000) AS size, k, {_TYPE_SQL} AS data_type,
    CASE WHEN contains(k, '.') THEN lower(split_part(k, '.', -1)) END AS ext, split_part(k, '/', -1) AS base
  FROM (SELECT *, {_OBJECT_KEY} AS k FROM pages))"""


def objects(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.selectExpr(
        "page_id", f"{_OBJECT_KEY} as source_key", "length(html) * (1 + page_id % 3 * 2000) as length"
    )


@query(
    "route_objects",
    f"""WITH {_OBJECTS_SQL} SELECT page_id, k AS source_key, data_type,
  CASE WHEN data_type = 'unknown' THEN 'unknown data type' END AS error FROM o""",
)
def route_objects(spark, sf_dir):
    return routing.route(objects(spark, sf_dir)).select("page_id", "source_key", "data_type", "error")


@query(
    "route_uploads",
    f"""WITH {_OBJECTS_SQL}, u AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'survey_' || base ELSE base END AS f FROM o)
SELECT page_id, f AS filename, CASE WHEN starts_with(f, 'survey_') AND ends_with(f, '.txt') THEN 'surveys/'
    WHEN ends_with(f, '.csv') THEN 'text-reviews/' WHEN ends_with(f, '.json') THEN 'surveys/'
    WHEN regexp_matches(f, '\\.(mp3|wav|flac)$') THEN 'audio/' WHEN regexp_matches(f, '\\.(jpg|jpeg|png)$') THEN 'images/'
  END || f AS target_key,
  CASE lower(regexp_extract(f, '\\.[^.]+$')) WHEN '.csv' THEN 'text/csv' WHEN '.txt' THEN 'text/plain'
    WHEN '.mp3' THEN 'audio/mpeg' WHEN '.wav' THEN 'audio/wav' WHEN '.jpg' THEN 'image/jpeg'
    WHEN '.png' THEN 'image/png' ELSE 'application/octet-stream' END AS content_type FROM u""",
)
def route_uploads(spark, sf_dir):
    base = keys.basename(F.col("source_key"))
    name = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("survey_"), base)).otherwise(base)
    return routing.route_upload(objects(spark, sf_dir).select("page_id", name.alias("filename")))


@query(
    "audio_formats",
    f"""WITH {_OBJECTS_SQL} SELECT page_id,
  CASE WHEN ext IN ('mp3', 'mp4', 'wav', 'flac', 'ogg', 'amr', 'webm') THEN ext END AS media_format,
  coalesce(ext IN ('mp3', 'mp4', 'wav', 'flac', 'ogg', 'amr', 'webm'), false) AS supported FROM o""",
)
def audio_formats(spark, sf_dir):
    rows = routing.with_audio_format(objects(spark, sf_dir))
    return rows.select("page_id", "media_format", F.col("error").isNull().alias("supported"))


@query(
    "image_routes",
    f"""WITH {_OBJECTS_SQL} SELECT page_id, CASE ext WHEN 'png' THEN 'png' WHEN 'gif' THEN 'gif' WHEN 'webp' THEN 'webp'
    ELSE 'jpeg' END AS image_format, CASE WHEN size <= 5242880 THEN 'sync' ELSE 'async' END AS method,
  CASE WHEN size <= 5242880 THEN 'multimodal' ELSE 'text' END AS prompt_kind FROM o""",
)
def image_routes(spark, sf_dir):
    return routing.with_image_route(objects(spark, sf_dir)).select("page_id", "image_format", "method", "prompt_kind")


_OUTPUT_KINDS = ("normalized", "transcript", "ocr", "survey", "quality", "insights")


@query(
    "output_keys",
    f"""WITH {_OBJECTS_SQL}, d AS (SELECT *, TIMESTAMP '2024-01-01' + to_days((page_id % 400)::INTEGER) AS ts FROM o)
SELECT page_id, CASE WHEN starts_with(k, 'text-reviews/') THEN 'normalized/' || substr(k, 14)
    WHEN contains(k, 'text-reviews/') THEN 'normalized/' || replace(k, 'text-reviews/', 'normalized/')
    ELSE 'normalized/' || k END AS normalized,
  'normalized/' || base || '.txt' AS transcript, 'textract-output/' || base || '.txt' AS ocr,
  'survey-summaries/' || base || '.summary.txt' AS survey,
  'quality-reports/' || data_type || '/' || base || '.quality.json' AS quality,
  'insights/' || data_type || '/' || strftime(ts, '%Y/%m/%d') || '/' || base || '.insights.json' AS insights FROM d""",
)
def output_keys(spark, sf_dir):
    rows = routing.with_data_type(objects(spark, sf_dir)).withColumn(
        "ts", F.expr("timestamp '2024-01-01' + make_dt_interval(cast(page_id % 400 as int))")
    )
    for kind in _OUTPUT_KINDS:
        rows = routing.with_output_key(rows, kind, out=kind)
    return rows.select("page_id", *_OUTPUT_KINDS)


# --- prompts and model calls ------------------------------------------------

_A, _B = prompts.AUDIO_FRAME.split("%s")


@query(
    "audio_prompt",
    f"SELECT {CALL_KEY} AS source_key, {quote(_A)} || text || {quote(_B)} AS prompt FROM conversations",
)
def audio_prompt(spark, sf_dir):
    built = dialogs.build_messages(calls(spark, sf_dir))
    return built.select("source_key", F.col("messages")[0]["content"][0]["text"].alias("prompt"))


@query(
    "audio_prompt_cut",
    f"""SELECT {CALL_KEY} AS source_key, {quote(_A)} || left(text, 200) || {quote(_B)} AS prompt,
  greatest(length(text) - 200, 0) AS left_out_chars FROM conversations""",
)
def audio_prompt_cut(spark, sf_dir):
    """A caller's own limit, and what it leaves out."""
    built = dialogs.build_messages(calls(spark, sf_dir), limits=prompts.Limits(text_chars=200))
    return built.select("source_key", F.col("messages")[0]["content"][0]["text"].alias("prompt"), "left_out_chars")


def _cut(frame: str, limit: str = "text") -> str:
    before, after = frame.split("%s")
    return f"{quote(before)} || {limit} || {quote(after)}"


@query(
    "prompts_by_type",
    f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN {_cut(prompts.IMAGE_FRAME)}
  WHEN 1 THEN {_cut(prompts.IMAGE_AND_TEXT_FRAME)} WHEN 2 THEN {_cut(prompts.SURVEY_FRAME)}
  ELSE {_cut(prompts.GENERIC_FRAME)} END AS prompt,
  CASE WHEN doc_id % 4 = 1 THEN 'jpeg' END AS image_format,
  CASE WHEN doc_id % 4 = 1 THEN to_base64(encode('img' || doc_id)) END AS image_b64 FROM documents""",
)
def prompts_by_type(spark, sf_dir):
    """Large image, small image, survey and a type without a prompt of its own."""
    kind = F.col("doc_id") % 4
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("images/i"), "doc_id", F.lit(".jpg")).alias("source_key"),
        F.when(kind <= 1, "images").when(kind == 2, "surveys").otherwise("other").alias("data_type"),
        F.col("text").alias("normalized_text"),
        F.encode(F.concat(F.lit("img"), "doc_id"), "UTF-8").alias("content"),
        F.when(kind == 0, 6_000_000).otherwise(1000).alias("length"),
    )
    content = F.col("messages")[0]["content"]
    return dialogs.build_messages(rows).select(
        "doc_id",
        F.array_max(F.transform(content, lambda c: c["text"])).alias("prompt"),
        F.array_max(F.transform(content, lambda c: c["image_format"])).alias("image_format"),
        F.array_max(F.transform(content, lambda c: c["image_b64"])).alias("image_b64"),
    )


@query(
    "followup",
    f"""SELECT {CALL_KEY} AS source_key, 'user,assistant,user' AS roles, 'chars=' || length(text) AS answer,
  {quote(prompts.FOLLOWUP_TEXT)} AS question FROM conversations""",
)
def followup(spark, sf_dir):
    built = dialogs.build_messages(calls(spark, sf_dir))
    answer = F.concat(F.lit("chars="), F.length("transcript"))
    dialog = built.withColumn("d", prompts.followup_messages(F.col("messages"), answer))
    return dialog.select(
        "source_key",
        F.array_join(F.transform("d", lambda m: m["role"]), ",").alias("roles"),
        F.col("d")[1]["content"][0]["text"].alias("answer"),
        F.col("d")[2]["content"][0]["text"].alias("question"),
    )


def echo_model(bad: str | None = None):
    """A stand-in model: answers with the size of the last message; a call that holds ``bad`` fails as a whole."""

    def answer(bodies: list[str]) -> list[str]:
        out = []
        for body in bodies:
            messages = json.loads(body)["messages"]
            text = messages[-1]["content"][-1]["text"]
            if bad is not None and bad in text:
                raise ValueError("bad request")
            reply = {
                "output": {"message": {"content": [{"text": f"turns={len(messages)}"}, {"text": f"chars={len(text)}"}]}},
                "usage": {"inputTokens": len(text)},
            }
            out.append(json.dumps(reply))
        return out

    return answer


PROMPT_SIZE = f"(length(text) + {len(_A) + len(_B)})"


@query(
    "model_batch_failing",
    f"""SELECT {CALL_KEY} AS source_key, contains(text, 'Th') AS failed,
  CASE WHEN NOT contains(text, 'Th') THEN 'turns=1' || {NL} || 'chars=' || {PROMPT_SIZE} END AS insights FROM conversations""",
)
def model_batch_failing(spark, sf_dir):
    """Requests that fail cost only themselves, whatever else is in their batch."""
    answered = dialogs.run_dialog(dialogs.build_messages(calls(spark, sf_dir)), echo_model("Th"))
    return answered.select("source_key", F.col("error").isNotNull().alias("failed"), "insights")


@query(
    "model_batch",
    f"""SELECT {CALL_KEY} AS source_key, 'turns=1' || {NL} || 'chars=' || {PROMPT_SIZE} AS insights,
  'turns=3' || {NL} || 'chars={len(prompts.FOLLOWUP_TEXT)}' AS top_priority_action,
  {PROMPT_SIZE} AS input_tokens, 'demo' AS model_id FROM conversations""",
)
def model_batch(spark, sf_dir):
    answered = dialogs.run_dialog(dialogs.build_messages(calls(spark, sf_dir)), echo_model())
    records = dialogs.insight_records(answered.withColumn("ts", F.lit(None).cast("timestamp")), "demo")
    return records.select(
        "source_key",
        "insights",
        "top_priority_action",
        F.regexp_extract("insights", "chars=([0-9]+)", 1).cast("bigint").alias("input_tokens"),
        "model_id",
    )


# --- quality ----------------------------------------------------------------

_PHRASES = (
    "",
    " The analysis is detailed, clear and SPECIFIC.",
    " No data was found and we were unable to analyze it; insufficient data.",
    " A comprehensive and reliable report, rich and actionable, though data quality is low.",
    " Spam, unclear and incomplete; no information.",
)
_TEXT_SQL = "text || CASE conv_id % 5 " + " ".join(f"WHEN {i} THEN {quote(p)}" for i, p in enumerate(_PHRASES)) + " END"
_BASE = "CASE WHEN conv_id % 4 = 0 THEN NULL ELSE CAST(conv_id * 7 % 101 AS DOUBLE) END"


def answers(spark, sf_dir):
    """Conversation turns as model answers, with scores to start from."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        f"{CALL_KEY} as source_key",
        "'audio' as data_type",
        "timestamp '2024-01-01' as ts",
        f"{_TEXT_SQL} as insights",
        f"{_BASE} as base_score",
        "length(text) % 13 as entity_count",
        "length(text) % 31 as phrase_count",
    )


def _hits_sql(patterns) -> str:
    return " + ".join(f"len(regexp_extract_all(insights, {quote('(?i)' + p)}))" for p in patterns)


def _answers_sql(profile: str) -> str:
    p = signals.PROFILES[profile]
    bounded = f"pos * {p.positive_weight}::DOUBLE - con * {p.concern_weight}::DOUBLE"
    if p.bound is not None:
        bounded = f"greatest(-{p.bound}::DOUBLE, least({p.bound}::DOUBLE, {bounded}))"
    concerns = ", ".join(
        f"CASE WHEN regexp_extract(insights, {quote('(?i)' + c)}) <> '' THEN 'Model identified: ' || "
        f"regexp_extract(insights, {quote('(?i)' + c)}) END"
        for c in p.concern_patterns
    )
    return f"""a AS (SELECT conv_id, turn, {CALL_KEY} AS source_key, {_TEXT_SQL} AS insights, {_BASE} AS base_score,
    length(text) % 13 AS ents, length(text) % 31 AS phrases FROM conversations),
h AS (SELECT *, {_hits_sql(signals.POSITIVE_PATTERNS)} AS pos, {_hits_sql(p.concern_patterns)} AS con,
    array_to_string(list_filter([{concerns}], lambda c: c IS NOT NULL), '; ') AS concerns FROM a),
q AS (SELECT *, {bounded} AS adj, least(10.0::DOUBLE, ents * 0.5::DOUBLE + phrases * 0.3::DOUBLE) AS boost FROM h),
f AS (SELECT *, round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, coalesce(base_score, 50.0::DOUBLE) + boost + adj)), 2)
    AS final_score FROM q)"""


for _profile in signals.PROFILES:

    def _signals(spark, sf_dir, profile=_profile):
        scored = quality.score_quality(answers(spark, sf_dir), profile=profile)
        return scored.select(
            "conv_id",
            "turn",
            "positive_hits",
            "concern_hits",
            F.array_join("concerns", "; ").alias("concerns"),
            "model_adjustment",
            F.round("comprehension_boost", 4).alias("boost"),
            "final_score",
        )

    query(
        f"quality_signals_{_profile}",
        f"WITH {_answers_sql(_profile)} SELECT conv_id, turn, pos AS positive_hits, con AS concern_hits, concerns, "
        "adj AS model_adjustment, round(boost, 4) AS boost, final_score FROM f",
    )(_signals)


@query(
    "quality_scores",
    f"""WITH {_answers_sql('current')} SELECT source_key, CASE WHEN final_score < 70 THEN 'needs_review' ELSE 'passed' END
    AS quality_status, final_score < 70 AS needs_reprocessing, coalesce(base_score, 50.0::DOUBLE) AS base,
  round(boost, 2) AS boost, round(adj, 2) AS adjustment, final_score, 70.0::DOUBLE AS threshold FROM f""",
)
def quality_scores(spark, sf_dir):
    reports = quality.quality_report(quality.score_quality(answers(spark, sf_dir)))
    b = F.col("score_breakdown")
    return reports.select(
        "source_key",
        "quality_status",
        "needs_reprocessing",
        b["base_score_from_validation"].alias("base"),
        b["comprehend_boost"].alias("boost"),
        b["model_adjustment"].alias("adjustment"),
        b["final_score"].alias("final_score"),
        "threshold",
    )


@query(
    "review_queue",
    f"""WITH {_answers_sql('current')} SELECT source_key, 'needs_review' AS quality_status, final_score AS quality_score
FROM f WHERE final_score < 70""",
)
def review_queue(spark, sf_dir):
    queue = quality.review_queue(quality.quality_report(quality.score_quality(answers(spark, sf_dir))))
    return queue.select(
        "source_key",
        F.col("tags")["quality_status"].alias("quality_status"),
        F.col("tags")["quality_score"].cast("double").alias("quality_score"),
    )


# --- the whole flow ---------------------------------------------------------

_FLOW_SQL = (
    CHECKED
    + f""", score AS (SELECT source_key, round(count(*) FILTER (WHERE len(issues) = 0) / count(*)::DOUBLE * 100, 2) AS base
  FROM v GROUP BY 1),
{NLP_SQL}
SELECT source_key, 'text_reviews' AS data_type, base,
  least(10.0::DOUBLE, entity_count * 0.5::DOUBLE + phrase_count * 0.3::DOUBLE) AS boost,
  round(least(100.0::DOUBLE, base + least(10.0::DOUBLE, entity_count * 0.5::DOUBLE + phrase_count * 0.3::DOUBLE)), 2)
    AS final_score FROM nlp JOIN score USING (source_key)"""
)


@query("feedback_reports", _FLOW_SQL)
def feedback_reports(spark, sf_dir):
    """Review files from raw rows to quality reports, all rows annotated."""
    rows = reviews(spark, sf_dir)
    files = rows.select("source_key").distinct().withColumn("ts", F.lit(None).cast("timestamp"))
    state = feedback.review_files(rows, files, sample_n=None)
    out = feedback.run_feedback([state], shared_dir(spark, "flow"))
    b = F.col("score_breakdown")
    return out["reports"].select(
        "source_key",
        "data_type",
        b["base_score_from_validation"].alias("base"),
        b["comprehend_boost"].alias("boost"),
        b["final_score"].alias("final_score"),
    )


@query("stream_file_reports", _FLOW_SQL)
def stream_file_reports(spark, sf_dir):
    """The same reports from a stream that brings the rows of every file in several micro-batches."""
    folder = shared_dir(spark, "file-reports")
    rows = reviews(spark, sf_dir).select("source_key", "row_no", "review_content", (F.col("row_no") % 3).alias("load"))
    rows.hint("rebalance", "load").write.partitionBy("load").parquet(f"{folder}/in")
    stream = streams.stream_loads(spark, f"{folder}/in", rows.schema, 3).drop("load")
    process = feedback.file_flow(f"{folder}/files", f"{folder}/work", f"{folder}/out")
    streams.start_batches(stream, process, f"{folder}/state").awaitTermination()
    stored = spark.read.json(f"{folder}/out/quality-reports")
    b = F.col("score_breakdown")
    return filestate.latest(stored).select(
        "source_key",
        "data_type",
        b["base_score_from_validation"].alias("base"),
        b["comprehend_boost"].alias("boost"),
        b["final_score"].cast("double").alias("final_score"),
    )


@query(
    "call_reports",
    f"""WITH n AS (SELECT {CALL_KEY} AS source_key, text, {normalize_sql('text')} AS t FROM conversations)
SELECT source_key, 'audio' AS data_type, length(t) AS chars FROM n""",
)
def call_reports(spark, sf_dir):
    """Calls and reviews through the flow with a model; the calls' state is shown."""
    files = calls(spark, sf_dir).select("source_key", "transcript").withColumn("ts", F.lit(None).cast("timestamp"))
    state = feedback.text_files(files, "audio", "transcript")
    out = feedback.run_feedback([state], shared_dir(spark, "calls"), echo_model(), "demo")
    return out["state"].select("source_key", "data_type", F.length("normalized_text").alias("chars"))



@query(
    "stream_feedback",
    """WITH k AS (SELECT CASE WHEN turn % 5 = 4 THEN 'lost/' ELSE 'audio/' END || 'call_' || conv_id || '_' || turn || '.mp3'
    AS source_key FROM conversations)
SELECT source_key, CASE WHEN starts_with(source_key, 'audio/') THEN 'report' ELSE 'dead letter' END AS outcome FROM k""",
)
def stream_feedback(spark, sf_dir):
    """The whole flow per micro-batch, over several input files; unknown types become dead letters."""
    folder = shared_dir(spark, "stream-feedback")
    name = "case when turn % 5 = 4 then 'lost/' else 'audio/' end || 'call_' || conv_id || '_' || turn || '.mp3'"
    rows = table(spark, sf_dir, "conversations").selectExpr(
        f"{name} as source_key", "timestamp '2024-01-01' as ts", "text as transcript", "turn % 2 as half"
    )
    rows.write.partitionBy("half").parquet(f"{folder}/in")
    files = streams.stream_loads(spark, f"{folder}/in", rows.schema, 2)
    routed = routing.route(files.drop("half"))

    def build(batch):
        return [feedback.text_files(batch.select("source_key", "ts", "transcript"), "audio", "transcript")]

    process = feedback.batch_flow(f"{folder}/work", f"{folder}/out", build)
    streams.start_batches(routed, process, f"{folder}/state", f"{folder}/dead").awaitTermination()
    reports = spark.read.schema("source_key string").json(f"{folder}/out/quality-reports")
    dead = spark.read.parquet(f"{folder}/dead")
    return reports.select("source_key", F.lit("report").alias("outcome")).unionByName(
        dead.select("source_key", F.lit("dead letter").alias("outcome"))
    )
