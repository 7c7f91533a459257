"""Prompts, model calls, quality scores, the whole flow."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from feedmill.functions import prompts, signals
from feedmill.operators import dialogs, quality
from feedmill.plans import feedback
from feedmill.schemas import NLP_TYPE

EMPTY_NLP = f"cast(null as {NLP_TYPE})"


def test_review_prompt_fallbacks(spark):
    df = spark.range(1).selectExpr("'k' as source_key", "'text_reviews' as data_type", f"{EMPTY_NLP} as nlp", "repeat('x', 4000) as normalized_text")
    text = dialogs.build_messages(df).collect()[0].messages[0].content[0].text
    for part in ("key=k", "UNKNOWN", "  (no entities detected)", "(none)"):
        assert part in text
    assert "x" * 4000 in text
    short = dialogs.build_messages(df, limits=prompts.Limits(text_chars=3000)).collect()[0]
    assert "x" * 3000 in short.messages[0].content[0].text and "x" * 3001 not in short.messages[0].content[0].text
    assert short.left_out_chars == 1000


def test_review_prompt_limits(spark):
    entry = "struct('{0}' || i as text, cast(1 as bigint) as cnt)"
    types = ", ".join(f"'T{n}', transform(sequence(1, 7), i -> {entry.format('e')})" for n in range(7))
    df = spark.range(1).selectExpr(
        "'k' as source_key",
        "named_struct('language', 'en', 'total_documents', 1L, 'skipped', false, 'sentiment', named_struct("
        "'counts', map('POSITIVE', 2L, 'MIXED', 1L), 'average_scores', cast(map() as map<string,double>), "
        "'dominant_sentiment', 'POSITIVE', 'total_analyzed', 3L), 'entities', named_struct("
        f"'counts_by_type', cast(map() as map<string,bigint>), 'top_entities_by_type', map({types})), "
        f"'key_phrases', transform(sequence(1, 20), i -> {entry.format('p')})) as nlp",
    )
    whole = df.select(prompts.review_prompt(F.col("source_key"), F.col("nlp"), F.lit("s"))).collect()[0][0]
    assert '"e7"' in whole and "T6" in whole and '"p20"' in whole
    limits = prompts.Limits(types=5, entities=5, phrases=15)
    text = df.select(prompts.review_prompt(F.col("source_key"), F.col("nlp"), F.lit("s"), limits=limits)).collect()[0][0]
    assert "POSITIVE: 2, MIXED: 1" in text
    assert '  - T4: "e1", "e2", "e3", "e4", "e5"\n' in text and "T5" not in text and '"e6"' not in text
    assert '"p15"' in text and '"p16"' not in text


def test_image_messages(spark):
    df = spark.createDataFrame(
        [("images/a.png", 10, bytearray(b"img"), ""), ("images/b.jpg", 6_000_000, bytearray(b"big"), "seen"), ("images/c", None, None, "t")],
        "source_key string, length bigint, content binary, extracted_text string",
    ).withColumn("data_type", F.lit("images"))
    rows = {r.source_key: r.messages[0].content for r in dialogs.build_messages(df).collect()}
    assert rows["images/a.png"][0].image_format == "png" and rows["images/a.png"][0].image_b64 == "aW1n"
    assert len(rows["images/b.jpg"]) == 1 and "seen" in rows["images/b.jpg"][0].text
    assert len(rows["images/c"]) == 1


def test_request_body_shape(spark):
    df = spark.range(1).select(prompts.request_body(prompts.text_messages(F.lit("hi"))).alias("b"))
    body = json.loads(df.collect()[0].b)
    assert body["messages"] == [{"role": "user", "content": [{"text": "hi"}]}]
    assert body["inferenceConfig"] == {"maxTokens": 4096} and body["system"][0]["text"]


def test_parse_response(spark):
    full = json.dumps({"output": {"message": {"content": [{"text": "a"}, {"x": 1}, {"text": "b"}]}}, "usage": {"inputTokens": 7}})
    df = spark.createDataFrame([(full,), ("{}",), ("broken",), (None,)], "response string")
    got = [(r.insights, r.input_tokens) for r in dialogs.parse_model_response(df).collect()]
    assert got == [("a\n\nb", 7), ("", 0), ("", 0), ("", 0)]


def make_model(fail_on: str, fail_followup: bool = False):
    def model(bodies):
        out = []
        for body in bodies:
            messages = json.loads(body)["messages"]
            if fail_on in messages[0]["content"][0]["text"] or (fail_followup and len(messages) > 1):
                raise RuntimeError("model down")
            out.append(json.dumps({"output": {"message": {"content": [{"text": f"detailed answer {len(messages)}"}]}}, "usage": {"inputTokens": 3}}))
        return out

    return model


def test_failed_calls_leave_no_insight(spark):
    df = spark.createDataFrame([("audio/a.mp3", "fine"), ("audio/b.mp3", "poison")], "source_key string, transcript string")
    df = df.withColumn("data_type", F.lit("audio")).withColumn("ts", F.lit(None).cast("timestamp"))
    answered = dialogs.run_dialog(dialogs.build_messages(df), make_model("poison"), batch=1)
    got = {r.source_key: r for r in answered.collect()}
    assert got["audio/a.mp3"].insights == "detailed answer 1" and got["audio/a.mp3"].top_priority_action == "detailed answer 3"
    assert got["audio/b.mp3"].insights is None and "model down" in got["audio/b.mp3"].error
    assert got["audio/b.mp3"].input_tokens == 0
    assert [r.source_key for r in dialogs.insight_records(answered, "m").collect()] == ["audio/a.mp3"]


def test_failed_followup_keeps_the_insight(spark):
    df = spark.createDataFrame([("audio/a.mp3", "fine")], "source_key string, transcript string")
    df = df.withColumn("data_type", F.lit("audio"))
    got = dialogs.run_dialog(dialogs.build_messages(df), make_model("none", fail_followup=True)).collect()[0]
    assert got.insights == "detailed answer 1" and got.top_priority_action == "" and got.error is None


# Counts of positive and concern hits in the shipped sample texts, with the
# scores the two scorer versions give.
GOLDEN = [
    (63.55, 0, 0, 9, 0, 1, 76.55, 72.55),
    (None, 0, 0, 6, 0, 4, 42.0, 56.0),
    (None, 0, 0, 11, 0, 1, 67.0, 60.0),
    (None, 5, 30, 1, 0, 0, 62.0, 61.0),
]


@pytest.mark.parametrize(("base", "entities", "phrases", "pos", "concern", "old", "golden", "current"), GOLDEN)
def test_golden_arithmetic(spark, base, entities, phrases, pos, concern, old, golden, current):
    boost = signals.richness_boost(F.lit(entities), F.lit(phrases))
    row = spark.range(1).select(
        signals.final_score(F.lit(base), boost, signals.adjustment(F.lit(pos), F.lit(old), "golden")),
        signals.final_score(F.lit(base), boost, signals.adjustment(F.lit(pos), F.lit(concern), "current")),
    )
    assert tuple(row.collect()[0]) == (golden, current)


def test_concern_messages(spark):
    df = spark.createDataFrame([("There is No Data and no data; Unable to analyze.",), (None,)], "t string")
    rows = df.select(
        signals.concern_signals(F.col("t")).alias("c"), signals.concern_hits(F.col("t")).alias("n"),
        signals.concern_hits(F.col("t"), "golden").alias("g"),
    ).collect()
    assert rows[0].c == ["Model identified: No Data", "Model identified: Unable to analyze"]
    assert (rows[0].n, rows[0].g) == (3, 2) and rows[1].c == [] and rows[1].n == 0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([("a", 70.0), ("b", 69.99)], "source_key string, final_score double")
    got = {r.source_key: r.quality_status for r in quality.quality_status(df).collect()}
    assert got == {"a": "passed", "b": "needs_review"}


def test_flow(spark, tmp_path):
    rows = spark.createDataFrame(
        [("text-reviews/a.csv", i, t) for i, t in enumerate(["A good and reliable product", "bad", None, "works well enough for me"])],
        "source_key string, row_no bigint, review_content string",
    )
    stamp = F.lit("2024-03-05 10:00:00").cast("timestamp")
    files = spark.createDataFrame([("text-reviews/a.csv",), ("text-reviews/empty.csv",)], "source_key string").withColumn("ts", stamp)
    call = spark.createDataFrame([("audio/c.mp3", "hello <b>there</b> http://x.y z")], "source_key string, transcript string").withColumn("ts", stamp)
    survey = spark.createDataFrame([("surveys/s.txt", "I like it")], "source_key string, survey_summary string").withColumn("ts", stamp)
    image = spark.createDataFrame([("images/i.png", "LABEL", 10)], "source_key string, extracted_text string, length bigint").withColumn("ts", stamp)
    for sample in (50, None):
        out = feedback.run_feedback(
            [
                feedback.review_files(rows, files, sample_n=sample),
                feedback.text_files(call, "audio", "transcript"),
                feedback.text_files(survey, "surveys", "survey_summary"),
                feedback.text_files(image, "images", "extracted_text"),
            ],
            str(tmp_path / f"work{sample}"),
            make_model("poison"),
            "m1",
        )
        reports = {r.source_key: r for r in out["reports"].collect()}
        assert set(reports) == {"text-reviews/a.csv", "text-reviews/empty.csv", "audio/c.mp3", "surveys/s.txt", "images/i.png"}
        assert reports["text-reviews/a.csv"].score_breakdown.base_score_from_validation == 50.0
        assert reports["surveys/s.txt"].score_breakdown.final_score == 51.0  # default base, one positive word
        empty = {r.source_key: r for r in out["state"].collect()}["text-reviews/empty.csv"]
        assert empty.nlp.skipped and empty.validation.validation_issues == {"no_content_found": 1}
        call_row = {r.source_key: r for r in out["state"].collect()}["audio/c.mp3"]
        assert call_row.normalized_text == "hello there z" and call_row.nlp.total_documents == 1
        assert out["insights"].count() == 5
        queue = {r.source_key for r in out["review_queue"].collect()}
        assert queue == {k for k, r in reports.items() if r.score_breakdown.final_score < 70}
        assert {r.metric for r in out["stage_points"].collect()} >= {"DataQualityScore", "EntitiesFound", "InsightsGenerated"}
        assert sum(r.files for r in out["summary"].collect()) == 5
        for _ in range(2):  # a repeated run replaces its output
            feedback.write_outputs(out, str(tmp_path / f"out{sample}"), "1")
        stored = spark.read.json(str(tmp_path / f"out{sample}" / "insights"))
        assert stored.filter("data_type = 'audio' and dt = '2024-03-05'").count() == 1


def test_flow_on_a_stream(spark, tmp_path):
    """Files land in two rounds; a record of unknown type goes to the dead letters."""
    from feedmill.operators.routing import with_data_type
    from feedmill.streaming import streams

    src = str(tmp_path / "src")
    schema = "source_key string, transcript string"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def build(batch):
        files = batch.select("source_key", "transcript").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
        return [feedback.text_files(files, "audio", "transcript")]

    def run():
        rows = with_data_type(spark.readStream.schema(schema).parquet(src))
        rows = rows.withColumn("error", F.when(F.col("data_type") == "unknown", "unknown data type"))
        process = feedback.batch_flow(str(tmp_path / "work"), str(tmp_path / "out"), build)
        streams.start_batches(rows, process, str(tmp_path / "state"), str(tmp_path / "dead")).awaitTermination()

    land([("audio/a.mp3", "a good call"), ("lost/b", "x")])
    run()
    land([("audio/c.mp3", "a bad call")])
    run()
    reports = spark.read.json(str(tmp_path / "out" / "quality-reports"))
    assert {(r.source_key, r.run) for r in reports.collect()} == {("audio/a.mp3", 0), ("audio/c.mp3", 1)}
    assert [r.source_key for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["lost/b"]


def test_flow_from_payloads_with_images(spark, tmp_path):
    """Small images are part of the prompt; failed readings go on with an empty text."""
    stamp = F.lit("2024-03-05").cast("timestamp")
    ocr = spark.createDataFrame(
        [("images/a.png", 3, '{"Blocks":[{"BlockType":"LINE","Text":"good label"}]}'), ("images/b.png", 9_000_000, None)],
        "source_key string, length bigint, ocr_json string",
    ).withColumn("ts", stamp)
    calls = spark.createDataFrame([("audio/x.mp3", None)], "source_key string, transcript_json string").withColumn("ts", stamp)
    images = spark.createDataFrame(
        [("images/a.png", 3, bytearray(b"img")), ("images/b.png", 9_000_000, bytearray(b"big"))],
        "source_key string, length bigint, content binary",
    )

    def model(bodies):
        out = []
        for body in bodies:
            content = json.loads(body)["messages"][0]["content"]
            kinds = ",".join(sorted(k for c in content for k in c))
            out.append(json.dumps({"output": {"message": {"content": [{"text": kinds}]}}}))
        return out

    out = feedback.run_feedback(
        feedback.branches(ocr=ocr, calls=calls), str(tmp_path / "w"), model, "m", images=images
    )
    got = {r.source_key: r for r in out["state"].collect()}
    assert {k: r.insights for k, r in got.items()} == {"images/a.png": "image,text", "images/b.png": "text", "audio/x.mp3": "text"}
    assert got["images/a.png"].extracted_text == "good label" and got["images/b.png"].extracted_text == ""
    assert got["audio/x.mp3"].nlp.skipped and got["audio/x.mp3"].final_score == 50.0


def test_flow_from_files(spark, tmp_path):
    """CSV and text files on disk to stored reports."""
    from feedmill.schemas import REVIEW_COLUMNS
    from feedmill.sources import readers

    for folder in ("text-reviews", "surveys"):
        (tmp_path / folder).mkdir()
    cells = {"review_content": '"A good, solid product\nthat lasts"', "rating": "5"}
    line = ",".join(cells.get(c, "") for c in REVIEW_COLUMNS)
    (tmp_path / "text-reviews" / "r.csv").write_text(",".join(REVIEW_COLUMNS) + "\n" + line + "\n")
    (tmp_path / "surveys" / "s.txt").write_text("I love it")
    rows = readers.read_reviews(spark, str(tmp_path / "text-reviews"), multi_line=True)
    surveys = readers.read_text_documents(spark, str(tmp_path / "surveys"))
    out = feedback.run_feedback(feedback.branches(rows, surveys=surveys), str(tmp_path / "w"))
    got = {r.source_key: r.score_breakdown.final_score for r in out["reports"].collect()}
    assert set(got) == {"text-reviews/r.csv", "surveys/s.txt"} and got["text-reviews/r.csv"] == 100.0
    assert got["surveys/s.txt"] == 50.0
