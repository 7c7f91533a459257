"""State of review files whose rows arrive in several loads. [STR5]

What a file's results need is mergeable: counts of issues and annotations with
their first place, score sums, and the rows that a prompt quotes. Each load adds
its own counts as one part of a keyed table; the results of the files it touches
come from all parts of these files. A repeated load replaces its own part, so
nothing is counted twice, and the texts of earlier loads are never read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators import aggregation
from feedmill.operators.ordering import first_k, first_rows
from feedmill.sinks.runs import RUN, read_runs

#: Folders that a part of the table is dealt to, so that a load reads only those of its files.
BUCKETS = 256
BUCKET = "bucket"


@dataclass(frozen=True)
class Files:
    """The files that a load touched, with all that is known of them."""

    files: DataFrame  # source_key, ts
    counts: DataFrame  # as review_counts
    rows: DataFrame  # the first rows of each file


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _add(rows: DataFrame, path: str, run: str) -> T.StructType:
    """Store a part by bucket; equal keys lie in one bucket."""
    parted = rows.withColumn(BUCKET, bucket_of(F.col("source_key")))
    parted.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{RUN}={run}")
    return T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])


def _of(spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, upto: str) -> DataFrame:
    """The rows of ``keys`` in the parts up to ``upto``; only their buckets are read."""
    rows = read_runs(spark, path, schema).filter(F.col(RUN) <= upto)
    return rows.join(keys, [BUCKET, "source_key"], "left_semi").drop(BUCKET, RUN)


def add_rows(rows: DataFrame, state: str, run: str, prompt_rows: int = 50) -> Files:
    """Add the rows of one load to the state and return the files it touched as they are now.

    ``rows`` hold ``source_key, row_no, review_content`` and optionally ``ts``;
    ``row_no`` is a row's place in its file, whatever load brings it. Names of
    runs sort in the order of the loads.
    """
    spark = rows.sparkSession
    ts = F.col("ts") if "ts" in rows.columns else F.lit(None)
    rows = rows.select("source_key", F.col("row_no").cast("bigint").alias("row_no"), "review_content", ts.cast("timestamp").alias("ts"))
    texts = rows.drop("ts")
    counts = _add(aggregation.review_counts(texts), f"{state}/counts", run)
    first = _add(first_rows(texts, "source_key", "row_no", prompt_rows), f"{state}/rows", run)
    seen = _add(rows.groupBy("source_key").agg(F.max("ts").alias("ts")), f"{state}/files", run)
    own = spark.read.schema(seen).parquet(f"{state}/files/{RUN}={run}").select(BUCKET, "source_key")
    files = _of(spark, f"{state}/files", seen, own, run).groupBy("source_key").agg(F.max("ts").alias("ts"))
    merged = aggregation.merge_counts(_of(spark, f"{state}/counts", counts, own, run))
    kept = first_rows(_of(spark, f"{state}/rows", first, own, run), "source_key", "row_no", prompt_rows)
    return Files(files, merged, kept)


def latest(rows: DataFrame, by: str = "source_key") -> DataFrame:
    """Of the results of all loads, the last one of each file."""
    return first_k(rows, by, [F.desc(RUN)], 1, "_rank").drop("_rank")
