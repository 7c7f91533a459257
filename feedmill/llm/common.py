"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.session import shared_dir

#: ASCII white space, which alone separates words, and a word.
SPACE = " \t\n\u000b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder in the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs reread the files, so a lost executor costs no
    recomputation, and costly columns are computed once.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wrap(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` as one struct ``_doc`` plus ``columns``, so that no name of the input can clash with a working name."""
    return rows.select(F.struct("*").alias("_doc"), *[c.alias(n) for n, c in columns.items()])


def unwrap(rows: DataFrame, names: list[str], *more: str | Column, **changed: Column) -> DataFrame:
    """The columns ``names`` of ``_doc``, with ``changed`` ones replaced, plus ``more``."""
    kept = [changed[c].alias(c) if c in changed else F.col(f"_doc.`{c}`") for c in names]
    return rows.select(*kept, *more)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches for long texts, where the session has no setting of its own.

    At the default of 10,000 rows a batch of documents takes tens of megabytes
    in the JVM and again in Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that Python holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def n_words(text: Column) -> Column:
    """Words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts, F.lit(seed)), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def bounded(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of the columns ``by``, the same ones in every run.

    A threshold from the number of rows leaves a few times ``most`` of them, so
    that tasks do not each send ``most`` rows on.
    """
    share = min(1.0, 4.0 * most / max(1, rows.count()))
    rank = uniform(*[F.col(c) for c in by], seed=77)
    return rows.withColumn("_rank", rank).filter(F.col("_rank") < share).orderBy("_rank").limit(most).drop("_rank")


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``.

    Alternates large-star and small-star steps: every step only takes minima
    per node and joins them back, so a hub is pre-aggregated and never
    collected. ``component`` is the smallest node reachable. Nodes without an
    edge to another node do not appear; nulls are ignored. Raises if
    ``rounds`` do not suffice (they grow with the logarithm of the longest
    path).
    """
    links = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).filter("a is not null and b is not null and a <> b").distinct()
    links = store(links, name)
    mark = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # Each node's own minimum stays linked, so that no node is dropped.
        large = large.unionByName(low.filter("u <> m").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            # Stable: every node hangs on its component's smallest node.
            return links.groupBy("u").agg(F.min("v").alias("component")).select(
                F.col("u").alias("node"), "component"
            ).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
