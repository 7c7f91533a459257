"""Shape of the physical plans: what a plan must and must not hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from feedmill.operators import aggregation, etl, metrics, normalization
from feedmill.plans import catalog
from feedmill.plans.nlp_queries import documents, review_nlp
from feedmill.plans.views import event_points, reviews, table

#: Queries that run jobs while they are built, so their plan is only a read.
WRITTEN = ("stream_", "write_", "feedback_reports", "call_reports")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith(WRITTEN)))
def test_no_cross_joins_or_single_partition_windows(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"Window \[.*\n(?:.*\n){0,4}", text):
        assert "SinglePartition" not in window


def cut_before_shuffle(text: str) -> bool:
    """The group limit stands below an exchange as well as above it."""
    lines = [line for line in text.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    kinds = ["limit" if "WindowGroupLimit" in line else "exchange" for line in lines]
    return any(kinds[i : i + 3] == ["limit", "exchange", "limit"] for i in range(len(kinds) - 2))


def test_hot_groups_are_cut_before_the_shuffle(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    dedup = etl.dedup_reviews(rows)
    sample = normalization.first_k(rows, "source_key", [F.col("row_no")], 50, "rank")
    phrases = aggregation.top_key_phrases(aggregation.annotate_key_phrases(documents(spark, sf_dir)))
    for df in (dedup, sample, phrases):
        assert cut_before_shuffle(plan(df)), plan(df)


def test_annotations_are_made_once(spark, sf_dir):
    text = plan(review_nlp(spark, sf_dir))
    assert text.count("ArrowEvalPython") == 1
    # The documents are read twice: once for the list of files, with one column.
    assert text.count("documents.parquet") == 2
    assert "ReadSchema: struct<source:string>" in text


def test_column_pruning_and_partial_aggregation(spark, sf_dir):
    text = plan(catalog.QUERIES["validation_by_source"](spark, sf_dir))
    assert "n_chars" not in text and "partial_count" in text
    text = plan(metrics.dashboard_series(event_points(spark, sf_dir)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text and "partial_sum" in text


def test_filters_reach_the_scan(spark, sf_dir):
    kept = normalization.normalize_column(table(spark, sf_dir, "documents"), "text").filter("lang = 'fr'")
    assert "EqualTo(lang,fr)" in plan(kept)


def test_tables_are_dealt_out_only_if_the_caller_says_so(spark, sf_dir):
    from feedmill.plans import views

    assert "REPARTITION" not in plan(table(spark, sf_dir, "documents"))
    spark.conf.set(views.PARTITIONS, "3")
    try:
        assert "REPARTITION" in plan(table(spark, sf_dir, "documents"))
    finally:
        spark.conf.unset(views.PARTITIONS)
