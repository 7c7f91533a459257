"""Readers, routing, payloads, metrics and streams on small files."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedmill.functions import keys
from feedmill.operators import metrics, routing
from feedmill.schemas import NLP_TYPE, REVIEW_SCHEMA, VALIDATION_TYPE
from feedmill.sources import payloads, readers
from feedmill.streaming import streams


def col_of(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, k string")
    return [r[1] for r in sorted(df.select("i", make(F.col("k"))).collect())]


def test_keys(spark):
    assert col_of(spark, ["text-reviews/a.csv", "images/a.JPG", "Audio/x.mp3", "x/text-reviews/a", "surveys/"], keys.data_type) == [
        "text_reviews", "images", "unknown", "unknown", "surveys",
    ]
    names = ["survey_1.txt", "notes.txt", "a.json", "b.CSV", "b.csv", ".csv", "survey_.txt", "survey_.tx"]
    assert col_of(spark, names, keys.upload_prefix) == [
        "surveys/", None, "surveys/", None, "text-reviews/", "text-reviews/", "surveys/", None,
    ]
    assert col_of(spark, ["a.CSV", ".csv", "x", "a.b.jpeg", "a.zip"], keys.content_type) == [
        "text/csv", "application/octet-stream", "application/octet-stream", "image/jpeg", "application/octet-stream",
    ]
    assert col_of(spark, ["a.MP3", "noext", "a.m4a", "mp3", "a.b/webm.webm"], keys.audio_format) == ["mp3", None, None, None, "webm"]
    assert col_of(spark, ["a.jpg", "a", "a.WEBP", "a.bmp"], keys.image_format) == ["jpeg", "jpeg", "webp", "jpeg"]
    assert col_of(spark, ["text-reviews/a/text-reviews/b", "x/text-reviews/b", "q", "normalized/z"], keys.normalized_key) == [
        "normalized/a/text-reviews/b", "normalized/x/normalized/b", "normalized/q", "normalized/z",
    ]


def test_image_routes(spark):
    df = spark.createDataFrame([("a.jpg", 5242880), ("b.jpg", 5242881), ("c.jpg", None)], "source_key string, length bigint")
    assert [r.method for r in routing.with_image_route(df).orderBy("source_key").collect()] == ["sync", "async", "async"]


def test_read_reviews(spark, tmp_path):
    folder = tmp_path / "text-reviews"
    folder.mkdir()
    header = ",".join(f.name for f in REVIEW_SCHEMA.fields)
    blank = [""] * len(REVIEW_SCHEMA.fields)
    place = [f.name for f in REVIEW_SCHEMA.fields].index("review_content")

    def line(text):
        cells = list(blank)
        cells[place] = text
        return ",".join(cells)

    body = [line('"one, with ""quotes"" and\na second line"'), line("two"), line("")]
    (folder / "a b+c.csv").write_text("\n".join([header, *body]) + "\n")
    (folder / "only_header.csv").write_text(header + "\n")
    rows = readers.read_reviews(spark, str(folder), multi_line=True).orderBy("row_no").collect()
    assert [r.review_content for r in rows] == ['one, with "quotes" and\na second line', "two", None]
    assert {r.source_key for r in rows} == {"text-reviews/a b+c.csv"}
    files = {r.source_key for r in readers.read_objects(spark, str(folder)).collect()}
    assert files == {"text-reviews/a b+c.csv", "text-reviews/only_header.csv"}


def test_row_numbers_follow_a_split_file(spark, tmp_path):
    folder = tmp_path / "text-reviews"
    folder.mkdir()
    (folder / "big.csv").write_text("review_content\n" + "".join(f"row {i}\n" for i in range(20000)))
    (folder / "small.csv").write_text("review_content\nrow 0\nrow 1\n")
    from pyspark.sql import types as T

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        schema = T.StructType([T.StructField("review_content", T.StringType())])
        df = readers.read_reviews(spark, str(folder), schema, multi_line=False)
        assert df.rdd.getNumPartitions() > 4
        rows = df.filter("source_key like '%big%'").orderBy("row_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.review_content for r in rows] == [f"row {i}" for i in range(20000)]
    assert len({r.row_no for r in rows}) == 20000


def plain_salvage(data: bytes, column="review_content"):
    lines = data.decode("utf-8", errors="replace").splitlines()
    if len(lines) < 2:
        return []
    heads = [h.strip('"').lower() for h in lines[0].split(",")]
    at = next((i for i, h in enumerate(heads) if column in h), None)
    if at is None:
        return []
    return [cells[at] if at < len(cells) else None for cells in (row.split(",") for row in lines[1:])]


def test_salvage(spark, tmp_path):
    folder = tmp_path / "text-reviews"
    folder.mkdir()
    files = {
        "a.csv": b'id,"My_Review_Content",x\n1,good text,3\n2\n\n3,"cut, here",9\nid,"My_Review_Content",x\n',
        "b.csv": b"review_content\nbad \xff byte\x0bnext\nlast",
        "none.csv": b"id,text\n1,2\n",
        "head.csv": b"review_content\n",
        "crlf.csv": b"id,review_content\r\n1,a\r\n2,b\r\n",
    }
    for name, data in files.items():
        (folder / name).write_bytes(data)
    got: dict = {}
    for r in readers.read_reviews_salvage(spark, str(folder)).collect():
        got.setdefault(r.source_key.split("/")[-1], Counter())[r.review_content] += 1
    assert got == {n: Counter(plain_salvage(d)) for n, d in files.items() if plain_salvage(d)}


def test_text_documents(spark, tmp_path):
    folder = tmp_path / "surveys"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b" \xc2\xa0hello\n\xff end \n")
    (folder / "b.txt").write_bytes(b" ")
    rows = {r.source_key: r for r in readers.read_text_documents(spark, str(folder)).collect()}
    assert rows["surveys/a.txt"].survey_summary == "hello\n� end" and rows["surveys/a.txt"].had_bad_bytes
    assert rows["surveys/b.txt"].survey_summary == "" and not rows["surveys/b.txt"].had_bad_bytes


def test_pick_text_column(spark):
    df = spark.createDataFrame([("aa", "bbbb", None), ("a", "bb", "c")], "x string, y string, z string")
    assert readers.pick_text_column(df) == "y"
    assert readers.pick_text_column(df.withColumn("review_content", F.lit("q"))) == "review_content"
    assert readers.pick_text_column(spark.range(1)) is None


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "rating int, extra string")
    got = {r.column_name: r.change for r in readers.schema_drift(df, REVIEW_SCHEMA).collect()}
    assert got["rating"] == "type_changed" and got["extra"] == "added" and got["user_id"] == "removed"
    assert len(got) == 17


def test_notifications(spark):
    def body(**kw):
        return json.dumps(kw)

    named = {"bucket": {"name": "b"}, "object": {"key": "audio/x.mp3"}}
    bodies = [
        body(detail=named), body(Records=[{"s3": named}, {"detail": named}]), body(Records=[{"x": 1}]),
        body(Records=[]), body(detail={"bucket": {"name": "b"}}), "broken", body(detail={"bucket": {"name": "b"}, "object": {"key": "zzz"}}),
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = Counter((r.i, r.status) for r in payloads.parse_notifications(df).collect())
    assert got == {
        (0, "started"): 1, (1, "started"): 2, (2, "unrecognised"): 1, (3, "unrecognised"): 1, (4, "failed"): 1,
        (5, "unrecognised"): 1, (6, "skipped"): 1,
    }
    good, bad = routing.split_dead_letters(payloads.parse_notifications(df))
    assert good.count() == 4 and bad.count() == 4


def test_payload_texts(spark):
    ocr = json.dumps({"Blocks": [{"BlockType": "PAGE"}, {"BlockType": "LINE", "Text": "b"}, {"BlockType": "WORD", "Text": "w"}, {"BlockType": "LINE"}, {"BlockType": "LINE", "Text": "a"}]})
    df = spark.createDataFrame([(ocr,), ("{}",), (None,)], "ocr_json string")
    got = [(r.extracted_text, r.pages, r.block_count) for r in payloads.ocr_text(df).collect()]
    assert got == [("b\na", 1, 5), ("", 1, 0), ("", 1, 0)]
    calls = spark.createDataFrame([('{"results":{"transcripts":[{"transcript":"hi"},{"transcript":"x"}]}}',), ('{"results":{"transcripts":[]}}',), ("{}",)], "transcript_json string")
    assert [r.transcript for r in payloads.transcript_text(calls).collect()] == ["hi", "", ""]


def test_failed_files_give_a_failure_only(spark):
    rows = [("images", "SUCCEEDED", 80.0), (None, "FAILED", 10.0), (None, "SUCCEEDED", 20.0)]
    state = spark.createDataFrame(rows, "data_type string, pipeline_status string, final_quality_score double")
    state = state.selectExpr("timestamp'2024-01-01' as ts", "*", f"cast(null as {VALIDATION_TYPE}) as validation", f"cast(null as {NLP_TYPE}) as nlp", "0L as input_tokens")
    points = metrics.metric_points(state)
    got = sorted((r.dims["DataType"], r.metric, r.value) for r in points.collect())
    assert got == [
        ("images", metrics.FINAL_SCORE, 80.0), ("images", metrics.SUCCEEDED, 1.0), ("unknown", metrics.FINAL_SCORE, 20.0),
        ("unknown", metrics.FAILED, 1.0), ("unknown", metrics.SUCCEEDED, 1.0),
    ]
    notices = spark.createDataFrame([("audio", "started"), ("unknown", "skipped")], "data_type string, status string")
    summary = {(r.data_type, r.pipeline_status): (r.files, r.metrics_published) for r in metrics.run_summary(state, points, notices).collect()}
    assert summary == {
        ("images", "SUCCEEDED"): (1, 2), ("unknown", "SUCCEEDED"): (1, 2), ("unknown", "FAILED"): (1, 1),
        ("audio", "STARTED"): (1, 0), ("unknown", "SKIPPED"): (1, 0),
    }


def test_keys_are_relative_to_the_root(spark):
    paths = ["s3://b/text-reviews/2024/images/a.csv", "file:///x/y/images/a%20b+c.png", "s3://other/z.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(readers.key_from_path(F.col("p"), ["s3://b", "/x/y"])).collect()]
    assert got == ["text-reviews/2024/images/a.csv", "images/a b+c.png", "z.csv"]
    assert readers.parent_of("/a/b/c/") == "/a/b" and readers.parent_of("s3://b/x/*.csv") == "s3://b/x"


def test_survivor_does_not_depend_on_file_packing(spark, tmp_path):
    from feedmill.operators import etl

    folder = tmp_path / "text-reviews"
    folder.mkdir()
    header = "review_id,review_content,product_id,rating"
    (folder / "zzz.csv").write_text(header + "\n" + "".join(f"{i},from zzz and long enough,p,5\n" for i in range(50)))
    (folder / "aaa.csv").write_text(header + "\n" + "".join(f"{i},from aaa and long enough,p,5\n" for i in range(400)))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in header.split(",")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    kept = []
    for size in ("2000", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = etl.dedup_reviews(readers.read_reviews(spark, str(folder), schema))
        kept.append(sorted((r.review_id, r.review_content) for r in rows.collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert kept[0] == kept[1] and len(kept[0]) == 400 and all("aaa" in c for _, c in kept[0])


def test_mixed_files(spark, tmp_path):
    root = tmp_path / "in"
    (root / "text-reviews" / "b").mkdir(parents=True)
    (root / "text-reviews" / "a.csv").write_text('id,review_content\n1,"one, ""two"""\n2,\n3,"open\n')
    (root / "text-reviews" / "b" / "a.csv").write_text("x,y\nshort,a much longer text\nk,and another one\ntoo,many,cells\n")
    (root / "text-reviews" / "empty.csv").write_text("x,y\n")
    (root / "text-reviews" / "bytes.csv").write_bytes(b"review_content\n\xff\xfe bad\n")
    rows = readers.read_mixed(spark, str(root / "text-reviews")).collect()
    got = sorted((r.source_key, r.review_content, r.error) for r in rows if r.review_content is not None)
    assert got == [
        ("text-reviews/a.csv", 'one, "two"', None), ("text-reviews/b/a.csv", "a much longer text", None),
        ("text-reviews/b/a.csv", "and another one", None), ("text-reviews/bytes.csv", "\ufffd\ufffd bad", None),
    ]
    assert sorted(r.source_key for r in rows if r.error) == ["text-reviews/a.csv", "text-reviews/b/a.csv"]


def series(spark, values):
    rows = [(f"2024-01-01 00:{m:02d}:00", metrics.FINAL_SCORE, v) for m, v in values]
    return spark.createDataFrame(rows, "at string, metric string, average double").withColumn("window_start", F.to_timestamp("at"))


def test_alarm_needs_consecutive_windows(spark):
    fires = series(spark, [(0, 60.0), (5, 69.9), (10, 1.0), (15, 70.0)])
    assert [str(r.window_start)[11:16] for r in metrics.alarm_low_quality(fires).collect()] == ["00:10"]
    gap = series(spark, [(0, 60.0), (10, 60.0), (15, 60.0)])
    assert metrics.alarm_low_quality(gap).count() == 0


def test_stream_objects_and_clean(spark, tmp_path):
    root = tmp_path / "in"
    for folder in ("text-reviews", "audio", "elsewhere"):
        (root / folder).mkdir(parents=True)
        (root / folder / f"{folder}.txt").write_text("a good long text")
    found = streams.stream_objects(spark, str(root))
    rows = found.select("source_key", "data_type", F.decode("content", "UTF-8").alias("review_content"))
    clean = streams.stream_clean(rows)
    table = streams.run_to_table(clean, str(tmp_path / "t"), str(tmp_path / "c"))
    got = {r.source_key: (r.data_type, r.is_valid, r.review_content_normalized) for r in table.collect()}
    assert got == {
        "text-reviews/text-reviews.txt": ("text_reviews", True, "a good long text"),
        "audio/audio.txt": ("audio", True, "a good long text"),
    }
    (root / "audio" / "new.txt").write_text("another good long text")
    again = streams.run_to_table(streams.stream_clean(rows), str(tmp_path / "t"), str(tmp_path / "c"))
    assert again.count() == 3


def test_late_points_are_dropped(spark, tmp_path):
    src = str(tmp_path / "src")
    points = spark.createDataFrame(
        [("2024-01-01 00:00:30", 1.0), ("2024-01-01 01:00:00", 2.0)], "at string, value double"
    ).select(F.to_timestamp("at").alias("ts"), F.lit(metrics.STARTED).alias("metric"), "value")
    points.write.parquet(src)
    stream = spark.readStream.schema(points.schema).parquet(src)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert streams.run_to_table(streams.stream_dashboard(stream), out, state).count() == 1
    late = points.limit(1).withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:01:00")))
    late.write.mode("append").parquet(src)
    rows = streams.run_to_table(streams.stream_dashboard(stream), out, state).collect()
    assert [(r.points, r.total) for r in rows] == [(1, 1.0)]


def test_dead_letters_are_idempotent_per_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = spark.createDataFrame([("a", None), ("b", "bad")], "k string, error string")
    rows.write.parquet(src)
    seen = []
    stream = spark.readStream.schema(rows.schema).parquet(src)
    streams.start_batches(stream, lambda df, i: seen.append((i, df.count())), str(tmp_path / "c"), str(tmp_path / "dead")).awaitTermination()
    assert seen == [(0, 1)] and spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("some_reviews")
    assert readers.read_catalog(spark, "some_reviews").count() == 3


def test_shared_folder_comes_from_the_session(spark):
    """The cluster's folder is used; without one only a local session may go on."""
    from types import SimpleNamespace as Fake

    from feedmill.session import shared_dir

    def session(folder, master):
        context = Fake(master=master, getConf=lambda: Fake(get=lambda name: None))
        return Fake(conf=Fake(get=lambda name, default: folder), sparkContext=context)

    cluster = session("/shared/place/", "yarn")
    one, two = shared_dir(cluster, "x"), shared_dir(cluster, "x")
    assert one.startswith("/shared/place/x-") and one != two
    assert "x-" in shared_dir(session(None, "local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"), "x")
