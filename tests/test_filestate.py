"""Files whose rows come in several loads against files that come at once."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from feedmill.operators import aggregation
from feedmill.plans import feedback
from feedmill.streaming import filestate, streams

WORDS = "good great bad awful battery life screen ACME Corp Jane Doe 2024 the a of not delivery www.x.com <b>".split()


def rows_of(seed=2):
    rng = random.Random(seed)
    out = []
    for key, n in (("text-reviews/a.csv", 90), ("text-reviews/b.csv", 7), ("text-reviews/c.csv", 3), ("text-reviews/blank.csv", 2)):
        for i in range(n):
            text = " ".join(rng.choice(WORDS) for _ in range(rng.randrange(14)))
            out.append((key, i * 3, None if i % 11 == 5 else "  " if "blank" in key else text))
    return out


def shown(df):
    cols = ["source_key", "validation", "nlp", "normalized_text", "rows_left_out"]
    return {r["source_key"]: r.asDict(recursive=True) for r in df.select(*cols).collect()}


def test_loads_equal_one(spark, tmp_path):
    rows = rows_of()
    schema = "source_key string, row_no long, review_content string"
    whole = spark.createDataFrame(rows, schema)
    files = whole.select("source_key").distinct().withColumn("ts", F.lit(None).cast("timestamp"))
    want = shown(feedback.review_files(whole, files, prompt_rows=5))
    # Loads in any order: later rows of a file first, a file in one load only, a load without rows, a load that is repeated.
    loads = [rows[60:95], rows[:40], [], rows[40:60] + rows[95:]]
    state, seen = str(tmp_path / "state"), {}
    for i in (0, 1, 1, 2, 3):
        touched = filestate.add_rows(spark.createDataFrame(loads[i], schema), state, f"{i:012d}", prompt_rows=5)
        now = shown(feedback.review_state(touched.files, touched.counts, touched.rows, prompt_rows=5))
        assert set(now) == {r[0] for r in loads[i]}
        seen |= now
    assert seen == want


def test_many_files_are_few_loads(spark, tmp_path):
    """Files come in as many batches as there are loads, however many files there are."""
    folder, seen = str(tmp_path / "in"), []
    rows = spark.range(50).repartition(11)
    rows.write.parquet(folder)
    stream = streams.stream_loads(spark, folder, rows.schema, 3)
    streams.start_batches(stream, lambda batch, i: seen.append([r["id"] for r in batch.collect()]), str(tmp_path / "state")).awaitTermination()
    assert len(seen) == 3 and sorted(x for load in seen for x in load) == list(range(50))


def test_rows_of_one_file_are_dealt_out(spark, tmp_path):
    """Annotation is not left to the one task that reads a file."""
    path = str(tmp_path / "one")
    text = "good words by Jane Doe 2024-01-02 " * 400
    rows = spark.range(200).selectExpr("'a' as source_key", "id as row_no", f"concat(id, '{text}') as review_content")
    rows.coalesce(1).write.parquet(path)
    plan = aggregation.review_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" in plan[plan.index("ArrowEvalPython") :]


def test_score_sums_of_mostly_null_scores(spark):
    """The same exact sums of the same type as by decimals, and no decimal per row."""
    values = [0.333333333333, 1 / 3, 1e-12, -0.000000000001, -2 / 3, 999999.5, 0.0, 12.0005]
    rows = [("a", {s: v for s in aggregation.SCORES}) for v in values] + [("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, scores struct<Positive:double,Negative:double,Neutral:double,Mixed:double>")
    plain, sparse = (df.groupBy("k").agg(*f("scores")) for f in (aggregation._score_sums, aggregation._sparse_score_sums))
    assert plain.schema == sparse.schema and sorted(plain.collect()) == sorted(sparse.collect())


def test_latest(spark):
    df = spark.createDataFrame([("a", "000000000002", 1), ("a", "000000000010", 2), ("b", "000000000001", 3)], "source_key string, run string, v int")
    assert {r["source_key"]: r["v"] for r in filestate.latest(df).collect()} == {"a": 2, "b": 3}


def test_only_touched_buckets_are_read(spark, tmp_path):
    state = str(tmp_path / "state")
    for i, key in enumerate(("a", "b")):
        touched = filestate.add_rows(spark.createDataFrame([(key, 1, "some good words here")], "source_key string, row_no long, review_content string"), state, str(i))
    plan = touched.counts._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and {r["source_key"] for r in touched.files.collect()} == {"b"}
