"""Segments, annotators, aggregates."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedmill.operators import aggregation, annotation, normalization, segments


def texts(spark, rows):
    return spark.createDataFrame(rows, "source_key string, normalized_text string")


def test_segment_edges(spark):
    df = texts(
        spark,
        [("a", "a\n\n---\n\nb"), ("b", "---"), ("c", "  "), ("d", None), ("e", "------x----"), ("f", "one")],
    )
    got = {}
    for r in segments.segment(df).orderBy("seg_no").collect():
        got.setdefault(r.source_key, []).append((r.seg_no, r.segment))
    assert got == {
        "a": [(0, "a"), (1, "b")], "b": [(0, "---")], "e": [(0, "x"), (1, "-")], "f": [(0, "one")],
    }


def test_segment_byte_limit(spark):
    df = texts(spark, [("a", "x" * 4999 + "é---" + "y" * 6000)])
    assert [len(r.segment) for r in segments.segment(df, max_bytes=5000).orderBy("seg_no").collect()] == [4999, 5000]


def test_row_segments_equal_joined_text(spark):
    rows = spark.createDataFrame(
        [("f", i, t) for i, t in enumerate(["good --- day", "  ", None, "x ---- y", "last"])],
        "source_key string, row_no bigint, review_content string",
    )
    normal = normalization.normalize_column(rows)
    direct = [r.segment for r in segments.segments_from_rows(normal).orderBy("seg_no").collect()]
    joined = segments.segment(normalization.sample_text(normal))
    assert direct == [r.segment for r in joined.orderBy("seg_no").collect()] == ["good - day", "x - y", "last"]


def test_sample_cuts_before_dropping_blanks(spark):
    rows = spark.range(100).selectExpr(
        "'f' as source_key", "id as row_no", "if(id % 2 = 0, '', 't' || id) as review_content_normalized"
    )
    text = normalization.sample_text(rows, n=6).collect()[0].normalized_text
    assert text == "t1\n\n---\n\nt3\n\n---\n\nt5"


def test_language(spark):
    df = spark.createDataFrame(
        [("the cat is on the mat",), ("le chat est sur la table",), ("der Hund und die Katze",), ("el perro y los gatos",), ("zzz",), ("",)],
        "t string",
    )
    got = [r[0] for r in df.select(annotation.language_of(F.col("t"))).collect()]
    assert got == ["en", "fr", "de", "es", "en", "en"]
    long = spark.createDataFrame([("the " * 300 + "der " * 900,)], "t string")
    row = long.select(annotation.language_of(F.col("t")).alias("all"), annotation.language_of(F.col("t"), head_chars=1000).alias("head"))
    assert tuple(row.collect()[0]) == ("de", "en")


def test_language_of_first_segment(spark):
    rows = spark.createDataFrame(
        [("f", 0, "der Hund und die Katze"), ("f", 1, "the cat is here"), ("g", 0, "le chat et la table")],
        "source_key string, seg_no bigint, segment string",
    )
    for dense in (True, False):
        got = {r.source_key: r.language for r in annotation.detect_language(rows, dense=dense).collect()}
        assert got == {"f": "de", "g": "fr"}


def test_lexicon_sentiment(spark):
    df = spark.createDataFrame([("Good, GREAT!",), ("bad",), ("good and bad and bad",), ("goodness",)], "t string")
    got = [r[0] for r in df.select(annotation.lexicon_sentiment(F.col("t"))).collect()]
    assert [r.label for r in got] == ["POSITIVE", "NEGATIVE", "MIXED", "NEUTRAL"]
    for r in got:
        assert sum(r.scores) == pytest.approx(1.0)
    assert tuple(got[2].scores) == (0.0, 0.25, 0.25, 0.5)


def scored(spark, rows):
    return spark.createDataFrame(
        rows,
        "source_key string, seg_no bigint, label string, "
        "scores struct<Positive:double,Negative:double,Neutral:double,Mixed:double>, error string",
    )


def test_sentiment_ties_and_failed_rows(spark):
    rows = [
        ("f", 0, "POSITIVE", (0.9, 0.0, 0.1, 0.0), None),
        ("f", 1, "NEGATIVE", (0.1, 0.8, 0.1, 0.0), None),
        ("f", 2, None, None, "boom"),
    ]
    got = aggregation.aggregate_sentiment(scored(spark, rows)).collect()[0].sentiment
    assert got.dominant_sentiment == "POSITIVE" and got.total_analyzed == 2
    assert got.counts == {"POSITIVE": 1, "NEGATIVE": 1} and got.average_scores["Positive"] == 0.5


def test_plug_in_batches_and_failures(spark):
    rows = spark.range(60).coalesce(1).selectExpr("'f' as source_key", "id as seg_no", "cast(id as string) as segment")

    def scorer(batch):
        assert len(batch) <= 25
        if "30" in batch:
            raise RuntimeError("boom")
        return [("NEUTRAL", {"Positive": 0.0, "Negative": 0.0, "Neutral": 1.0, "Mixed": 0.0}) for _ in batch]

    got = annotation.annotate_sentiment(rows, scorer).cache()
    assert got.filter("error is not null").count() == 25
    assert aggregation.aggregate_sentiment(got).collect()[0].sentiment.total_analyzed == 35
    bad = annotation.annotate_key_phrases(rows, lambda batch: batch[:-1]).select("error").distinct().collect()
    assert len(bad) == 2 and all("results for" in r.error for r in bad)


def test_plug_in_results_with_failed_batch(spark):
    """Failed segments are counted as sent but not analysed."""
    rows = spark.range(30).coalesce(1).selectExpr("'f' as source_key", "id as seg_no", "'text ' || id as segment")

    def extractor(batch):
        if len(batch) < 25:
            raise RuntimeError("boom")
        return [[{"type": "T", "text": "x"}] for _ in batch]

    files = spark.createDataFrame([("f",), ("blank",)], "source_key string")
    got = {r.source_key: r.nlp for r in aggregation.nlp_results(files, rows, entity_extractor=extractor).collect()}
    assert got["f"].total_documents == 30 and got["f"].entities.counts_by_type == {"T": 25}
    assert got["blank"].skipped and got["blank"].sentiment is None and got["blank"].key_phrases == []


def test_top_entities_case_and_first_seen(spark):
    rows = [("f", 0, [("NAME", "b"), ("NAME", "a")], None), ("f", 1, [("NAME", "A"), ("NAME", "c"), ("NAME", "c")], None)]
    df = spark.createDataFrame(rows, "source_key string, seg_no bigint, entities array<struct<type:string,text:string>>, error string")
    got = [r.text for r in aggregation.top_entities(df, k=3).orderBy("rank").collect()]
    assert got == ["c", "b", "a"]
    nested = aggregation.aggregate_entities(df).collect()[0].entities
    assert nested.counts_by_type == {"NAME": 5} and nested.top_entities_by_type["NAME"][0] == ("c", 2)


def test_top_lists_match_brute_force_on_a_hot_file(spark):
    """One file holds most phrases; ranks equal a plain count with first-seen ties."""
    rows = spark.range(400).selectExpr(
        "if(id % 4 < 3, 'hot', 'f' || id % 3) as source_key",
        "id as seg_no",
        "transform(sequence(0, 9), i -> ' P' || cast((id * 7 + i * i) % 97 as string) || ' ') as phrases",
        "cast(null as string) as error",
    )
    counts, seen = {}, {}
    for r in rows.orderBy("seg_no").collect():
        for pos, p in enumerate(r.phrases):
            p = p.lower().strip()
            counts.setdefault(r.source_key, Counter())[p] += 1
            seen.setdefault((r.source_key, p), (r.seg_no, pos))
    want = {
        key: [p for p, _ in sorted(c.items(), key=lambda kv: (-kv[1], seen[key, kv[0]]))][:30]
        for key, c in counts.items()
    }
    got: dict = {}
    for r in aggregation.top_key_phrases(rows).orderBy("rank").collect():
        got.setdefault(r.source_key, []).append(r.text)
    assert got == want


def test_joint_results_equal_separate_aggregates(spark):
    rows = spark.createDataFrame(
        [
            ("f", 0, "Good work by Ada Lovelace on 2024-01-02, mail ada@example.com."),
            ("f", 1, "A bad day for Ada Lovelace, and a broken link http://x.example.org/a"),
            ("g", 0, "le chat est sur la table"),
        ],
        "source_key string, seg_no bigint, segment string",
    )
    files = rows.select("source_key").distinct()
    joint = {r.source_key: r.nlp for r in aggregation.nlp_results(files, rows).collect()}
    sentiment = {r[0]: r[1] for r in aggregation.aggregate_sentiment(annotation.annotate_sentiment(rows)).collect()}
    entities = {r[0]: r[1] for r in aggregation.aggregate_entities(annotation.annotate_entities(rows)).collect()}
    phrases = {r[0]: r[1] for r in aggregation.aggregate_key_phrases(annotation.annotate_key_phrases(rows)).collect()}
    for key in ("f", "g"):
        assert joint[key].sentiment == sentiment[key] and joint[key].key_phrases == phrases[key]
        if key in entities:
            assert joint[key].entities == entities[key]
    types = aggregation.nlp_results(files, rows).filter("source_key = 'f'").select(F.map_keys("nlp.entities.counts_by_type"))
    assert types.collect()[0][0] == ["EMAIL", "DATE", "QUANTITY", "NAME", "URL"]
    assert joint["g"].language == "fr"
