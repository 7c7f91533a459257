"""Trained annotators: held-out accuracy, edge texts, stored weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.operators import annotation, etl, trained
from feedmill.plans import catalog


def _auc(pairs):
    """Chance that a positive row scores above a negative one; ties count half."""
    ranked = sorted(pairs)
    total = wins = seen = i = 0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        low, high = sum(1 for _, y in ranked[i:j] if not y), sum(1 for _, y in ranked[i:j] if y)
        wins += high * (seen + low / 2)
        seen += low
        total += high
        i = j
    return wins / (total * seen)


def test_language_of_held_out_documents(spark, sf_dir):
    rows = catalog.QUERIES["language_confusion"](spark, f"{sf_dir}/../sf0.01").collect()
    right = sum(r["n"] for r in rows if r["lang"] == r["language"])
    assert right >= 0.99 * sum(r["n"] for r in rows) and len({r["lang"] for r in rows}) > 2


def test_language_edges(spark):
    known = [("the cat and the dog " * 5, "en"), ("le chat et la souris " * 5, "fr"), ("x", None), (None, "fr")]
    profiles = trained.language_profiles(spark.createDataFrame(known, "text string, lang string"), most=50)
    assert {r["lang"] for r in profiles.select("lang").distinct().collect()} == {"en", "fr"}
    texts = [(1, "the dog"), (2, "la souris"), (3, None), (4, ""), (5, "123 !"), (6, "le chat " * 30_000), (1, "the dog")]
    found = trained.detect_language(spark.createDataFrame(texts, "id long, text string"), profiles, "id", default="en").collect()
    assert {r["id"]: r["language"] for r in found} == {1: "en", 2: "fr", 3: "en", 4: "en", 5: "en", 6: "fr"} and len(found) == 6


def test_runs_are_counted_inside_their_texts(spark, sf_dir):
    """Each half is read through Python once, and no run of a single text is moved."""
    text = catalog.QUERIES["language_confusion"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in text.splitlines() if "hashpartitioning(doc_id" in line and "run#" in line]
    assert text.count("MapInArrow ") == 2 and not shuffled


def test_sentiment_beats_the_word_list(spark, sf_dir, tmp_path):
    folder = f"{sf_dir}/../sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = docs.join(spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "quality as positive").dropna(), "doc_id")
    model = trained.train_sentiment(rows.filter("doc_id % 2 = 0"))
    held = rows.filter("doc_id % 2 = 1")
    own = [(r["p"] - r["n"], r["positive"]) for r in model.annotate(held, "text").selectExpr("scores.Positive as p", "scores.Negative as n", "positive").collect()]
    words = held.select(annotation.lexicon_sentiment(F.col("text")).alias("s"), "positive").selectExpr("s.scores.Positive - s.scores.Negative as p", "positive")
    listed = [(r["p"], r["positive"]) for r in words.collect()]
    assert _auc(own) > 0.65 and _auc(own) > _auc(listed) + 0.1, (_auc(own), _auc(listed))
    model.save(str(tmp_path / "weights"))
    edge = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "some words")], "id long, segment string")
    got = {r["id"]: (r["label"], r["scores"]) for r in trained.Sentiment.load(str(tmp_path / "weights")).annotate(edge).collect()}
    assert [got[i][0] for i in (1, 2, 3)] == ["NEUTRAL"] * 3 and all(abs(sum(s) - 1) < 1e-9 for _, s in got.values())


def test_sentiment_after_an_observed_counter(spark):
    """A model can be sent to tasks whatever else its session has done."""
    seen, watch = etl.observed(spark.range(3), "rows before")
    assert len(seen.collect()) == 3 and watch.get == {"rows": 3}
    rows = spark.createDataFrame([("good fine words", 1), ("bad poor words", 0)] * 8, "text string, positive int")
    got = trained.train_sentiment(rows).annotate(spark.createDataFrame([("good",), ("bad",)], "segment string")).collect()
    assert {r["segment"]: r["label"] for r in got} == {"good": "POSITIVE", "bad": "NEGATIVE"}
