"""Rules over loads, sinks as one commit, stored answers."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from feedmill.operators import answers, dialogs, rule_history, rules
from feedmill.plans import feedback
from feedmill.sinks import commits, writers


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("run").collect()), key=repr)


@pytest.mark.parametrize("by", [(), ("g",)])
def test_loads_equal_one_evaluation(spark, tmp_path, by):
    rng = random.Random(3)
    schema = "g string, review_id string, rating string, review_content string, n int"
    data = [
        (rng.choice("ab") if rng.random() < 0.9 else None, str(rng.randrange(40)) if rng.random() < 0.9 else None, rng.choice(["1", "9", "x", None]), "w" * rng.randrange(30), rng.randrange(5))
        for _ in range(120)
    ]
    ruleset = [
        rules.Uniqueness("review_id", 0.1), rules.IsUnique("n"), rules.IsComplete("rating"), rules.ColumnValues("rating", 1, 5),
        rules.ColumnLength("review_content", gt=3), rules.ColumnLength("review_content", lt=40), rules.RowCount(gt=50), rules.ColumnCount(gt=2),
        rules.Completeness("absent", 0.5), rules.Uniqueness("absent", 0.5),
    ]
    state, seen = str(tmp_path / "state"), []
    for i, (a, b) in enumerate([(0, 50), (50, 51), (51, 51), (51, 120)]):
        part = spark.createDataFrame(data[a:b], schema)
        for _ in range(1 + (i == 1)):  # one load is repeated
            got = rule_history.evaluate_load(part, ruleset, state, f"{i}", by=by)
        want = rules.evaluate(spark.createDataFrame(data[:b], schema), ruleset, by=by)
        assert rows_of(got) == rows_of(want), i
        seen += [(f"{i}",)] * got.count()
    kept = rule_history.results(spark, state, by)
    assert sorted(tuple(r) for r in kept.select("run").collect()) == seen


def test_old_rows_are_not_read(spark, tmp_path):
    """A second load needs the stored value counts only: the first load's rows may be elsewhere by then."""
    path, state = str(tmp_path / "rows"), str(tmp_path / "state")
    spark.range(100).selectExpr("cast(id as string) as k").write.parquet(path)
    rule_history.evaluate_load(spark.read.parquet(path), [rules.IsUnique("k")], state, "1")
    (tmp_path / "rows").rename(tmp_path / "elsewhere")
    out = rule_history.evaluate_load(spark.createDataFrame([("7",), ("x",)], "k string"), [rules.IsUnique("k")], state, "2")
    assert out.first()["actual"] == round(100 / 102, 6)


def test_a_run_is_seen_whole_or_not(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, data_type string")

    def write(folder, fail=False, add=0):
        rows.withColumn("v", F.col("v") + add).write.parquet(f"{folder}/first")
        if fail:
            raise OSError("lost between two sinks")
        writers.write_csv(rows, f"{folder}/second")

    def seen(sink="first"):
        return sorted((r["run"], r["v"]) for r in commits.read_sink(spark, path, sink, rows.schema, "csv" if sink == "second" else "parquet").collect())

    assert seen() == [] and commits.committed(spark, path) == {}
    with pytest.raises(OSError):
        commits.commit_run(spark, path, "1", lambda f: write(f, fail=True))
    assert seen() == []
    commits.commit_run(spark, path, "1", write)
    assert seen() == [("1", 1), ("1", 2)]
    # A repeated run that breaks off changes nothing; one that ends takes the place of the first.
    with pytest.raises(OSError):
        commits.commit_run(spark, path, "1", lambda f: write(f, fail=True, add=5))
    assert seen() == [("1", 1), ("1", 2)]
    commits.commit_run(spark, path, "1", lambda f: write(f, add=10))
    commits.commit_run(spark, path, "2", write)
    assert seen() == [("1", 11), ("1", 12), ("2", 1), ("2", 2)]
    assert commits.remove_broken(spark, path) == 3 and seen() == [("1", 11), ("1", 12), ("2", 1), ("2", 2)]


def test_all_outputs_as_one_commit(spark, tmp_path):
    files = spark.createDataFrame([("surveys/a.txt", "Fine work, thank you."), ("lost/b", "x")], "source_key string, survey_summary string")
    state = feedback.text_files(files.withColumn("ts", F.lit(None).cast("timestamp")), "surveys", "survey_summary")
    out = feedback.run_feedback([state], str(tmp_path / "work"))
    folder = feedback.commit_outputs(out, str(tmp_path / "out"), "r1")
    assert commits.committed(spark, str(tmp_path / "out")) == {"r1": folder}
    queue = commits.read_sink(spark, str(tmp_path / "out"), "review-queue/run=r1", out["review_queue"].schema)
    assert queue.count() == out["review_queue"].count() and set(queue.select("run").distinct().collect()[0]) == {"r1"}


def test_answers_are_asked_once(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()

    def model(bodies):
        import uuid

        out = []
        for body in bodies:
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write(body)
            if "broken" in body:
                raise RuntimeError("no answer")
            out.append(json.dumps({"output": {"message": {"content": [{"text": f"about {len(body)}"}]}}, "usage": {"inputTokens": len(body)}}))
        return out

    def ask(texts):
        rows = spark.createDataFrame([(f"surveys/{i}.txt", t) for i, t in enumerate(texts)], "source_key string, normalized_text string")
        rows = dialogs.build_messages(rows.withColumn("data_type", F.lit("surveys")))
        before = len(list(log.iterdir()))
        call = answers.stored_caller(store, tries=2)
        got = {r["source_key"]: r for r in dialogs.run_dialog(rows, model, call=call).collect()}
        return got, len(list(log.iterdir())) - before

    texts = ["one text", "another text", "one text", "third"]
    first, calls = ask(texts)
    # Equal requests are asked once: three analyses and three follow-ups.
    assert calls == 6 and all(r["error"] is None and r["insights"] for r in first.values())
    assert first["surveys/0.txt"]["insights"] == first["surveys/2.txt"]["insights"]
    again, calls = ask(texts)
    assert calls == 0 and {k: r["insights"] for k, r in again.items()} == {k: r["insights"] for k, r in first.items()}
    changed, calls = ask([*texts[:3], "third, changed"])
    assert calls == 2 and changed["surveys/0.txt"]["top_priority_action"] == first["surveys/0.txt"]["top_priority_action"]
    # A request that fails is tried in later runs, then rests; the others are not asked again.
    for n in (1, 1, 0):
        got, calls = ask([*texts, "broken"])
        assert calls == n and "no answer" in got["surveys/4.txt"]["error"] and got["surveys/4.txt"]["insights"] is None


def test_one_task_brings_a_large_value_in_blocks(spark, monkeypatch):
    """All points of a metric from one task do not meet in one writing task."""
    from feedmill.sinks import writers

    monkeypatch.setattr(writers, "BLOCK_BITS", 5, raising=False)
    points = spark.range(1000).coalesce(1).selectExpr("'m' as metric", "id as value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = writers._by_partition(points, "metric").select("metric", "value", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["value"] for r in got) == list(range(1000)) and len({r["task"] for r in got}) > 1
