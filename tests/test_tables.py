"""ETL, rules, ordering helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedmill.functions import numbers
from feedmill.operators import etl, ordering, rules, segments


def test_clean_numbers(spark):
    df = spark.createDataFrame(
        [("4.5 stars", "24,269", "$1,099", "50%"), ("n/a", "1.5", "-5", "x%"), ("1.2.3", None, "", None)],
        "rating string, rating_count string, actual_price string, discount_percentage string",
    )
    got = [tuple(r) for r in etl.clean_numbers(df).collect()]
    assert got == [(4.5, 24269, 1099.0, 50.0), (None, None, 5.0, None), (None, None, None, None)]


def test_safe_double(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("0",)], "v string")
    assert [r[0] for r in df.select(numbers.safe_double(F.col("v"))).collect()] == [1.5, 0.0, 0.0, 0.0]


REVIEW = "review_id string, row_no int, product_id string, rating string, review_content string, img_link string, category string"


def test_etl_edges(spark):
    rows = [
        ("r1", 2, "p", "5", "long enough text", "http://x.y/img", "A|B"),
        ("r1", 1, "p", "4", "long enough first", None, "A|B"),
        (None, 3, "p", "3", "long enough null", "short", "C"),
        (None, 4, "p", "2", "long enough null too", None, None),
        ("r2", 5, "p", "1", "exactly 10", None, "A"),
        ("r3", 6, None, "5", "no product at all", None, "A"),
        ("r4", 7, "p", "6", "rating too high", None, "A"),
        ("r5", 8, "p", "1", "a low rating here", None, "|x"),
    ]
    df = spark.createDataFrame(rows, REVIEW)
    clean, counters = etl.run_etl(df)
    got = {r.review_id: r for r in clean.collect()}
    assert set(got) == {"r1", None, "r5"}
    assert got["r1"].row_no == 1 and got["r1"].sentiment_proxy == "POSITIVE" and got["r1"].top_category == "A"
    assert got[None].row_no == 3 and got[None].sentiment_proxy == "NEUTRAL" and not got[None].has_image_url
    assert got["r5"].sentiment_proxy == "NEGATIVE" and got["r5"].top_category == ""
    assert tuple(counters.collect()[0]) == (8, 5, 3)


def test_etl_without_optional_columns(spark, tmp_path):
    from feedmill.sinks import writers

    df = spark.createDataFrame([("p", "5", "long enough text", 1)], "product_id string, rating string, review_content string, row_no int")
    clean = etl.clean_reviews(df)
    assert "top_category" not in clean.columns and etl.stage_counters(df).collect()[0].deduped == 1
    writers.write_clean(clean, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_observed_counter(spark, tmp_path):
    df, watch = etl.observed(spark.range(42), "rows seen")
    df.write.parquet(str(tmp_path / "o"))
    assert watch.get["rows"] == 42


def test_rules_edges(spark):
    df = spark.createDataFrame(
        [("a", "5", "0123456789a"), ("b", "6", "0123456789"), ("b", None, None), (None, "x", "12345678901")],
        "id string, rating string, text string",
    )
    ruleset = [
        rules.IsComplete("id"),
        rules.Completeness("id", 0.7),
        rules.ColumnValues("rating", 1, 5),
        rules.ColumnLength("text", gt=10),
        rules.ColumnLength("text", lt=12),
        rules.Uniqueness("id", 0.2),
        rules.IsUnique("id"),
        rules.ColumnCount(ge=3),
        rules.RowCount(gt=4),
        rules.IsComplete("nope"),
        rules.IsUnique("nope"),
    ]
    got = {r.rule_no: (r.actual, r.passed) for r in rules.evaluate(df, ruleset).collect()}
    assert got == {
        1: (0.75, False), 2: (0.75, True), 3: (2.0, False), 4: (10.0, False), 5: (11.0, True), 6: (0.25, True),
        7: (0.25, False), 8: (3.0, True), 9: (4.0, False), 10: (None, False), 11: (None, False),
    }


def test_rule_options(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,)], "v double")
    loose = rules.evaluate(df, [rules.ColumnValues("v", 1, 5)]).collect()[0]
    strict = rules.evaluate(df, [rules.ColumnValues("v", 1, 5, inclusive=False, nulls_pass=False)]).collect()[0]
    assert loose.passed and strict.actual == 3.0


def test_rules_on_empty_table(spark):
    df = spark.createDataFrame([], "response_id string, a int, b int")
    got = {r.rule: r.passed for r in rules.evaluate(df, "surveys").collect()}
    assert got == {"ColumnCount": True, "RowCount": False, "Completeness": False, "IsUnique": False}


def test_ruleset_sizes():
    assert {n: len(r) for n, r in rules.RULESETS.items()} == {
        "text_reviews": 13, "surveys": 4, "deployed": 9, "documented": 6,
    }


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_number_rows_is_exact_for_a_hot_group(spark, block):
    rows = spark.range(3000).selectExpr("if(id % 3 < 2, 'hot', 'k' || id % 5) as k", "id * id % 1000003 as o")
    got = ordering.number_rows(rows, "k", "o", block=block).collect()
    by_key: dict = {}
    for r in got:
        by_key.setdefault(r.k, []).append((r.o, r.row_number))
    for pairs in by_key.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))
    assert len(got) == 3000


def test_number_rows_takes_null_keys_and_negative_order(spark):
    rows = spark.createDataFrame([(None, -5), (None, 3), ("a", 0)], "k string, o int")
    got = {(r.k, r.o): r.row_number for r in ordering.number_rows(rows, "k", "o", block=2).collect()}
    assert got == {(None, -5): 1, (None, 3): 2, ("a", 0): 1}


def test_batches(spark):
    rows = spark.range(60).selectExpr("'f' as source_key", "id * 3 as seg_no")
    dense = segments.with_batch_id(rows.selectExpr("source_key", "seg_no div 3 as seg_no"))
    sparse = segments.with_batch_id(rows, dense=False)
    for df in (dense, sparse):
        assert {r.batch_id: r["count"] for r in df.groupBy("batch_id").count().collect()} == {0: 25, 1: 25, 2: 10}


def test_first_rows_equal_a_full_ranking(spark):
    rows = spark.range(2000).selectExpr("if(id % 3 < 2, 'hot', 'k' || id % 7) as k", "(id * 31) % 2003 as o", "'t' || id as t")
    want = ordering.first_k(rows, "k", [F.col("o")], 50, "rank").drop("rank")
    got = ordering.first_rows(rows, "k", "o", 50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dedup_breaks_ties_by_file(spark):
    rows = spark.createDataFrame([("r", 1, "b"), ("r", 2, "a"), ("r", 3, "a")], "review_id string, row_no int, source_key string")
    assert [(r.source_key, r.row_no) for r in etl.dedup_reviews(rows).collect()] == [("a", 2)]
