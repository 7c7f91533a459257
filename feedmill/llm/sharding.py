"""Sharding by weighted rendezvous hashing of stable record keys.

Each record goes to the shard with the lowest ``-ln(u(key, shard)) / weight``.
The scores of the old shards do not change when one is added, so records only
ever move into the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.common import store, uniform

BLOCKS = 1024


def rendezvous(key: Column, shards: int, weights: list[float] | None = None, seed: int = 8) -> Column:
    """The shard of a key, 0 to ``shards`` - 1. A null key is a key like any other."""
    weights = weights or [1.0] * shards
    scores = [
        F.struct((-F.log(uniform(key, F.lit(s), seed=seed)) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard"))
        for s, w in zip(range(shards), weights)
    ]
    return (scores[0] if shards == 1 else F.least(*scores))["shard"]


def slots(rows: DataFrame, shard: str, key: str, tie: list[str], name: str = "slot", blocks: int = BLOCKS) -> DataFrame:
    """Gapless positions from 0 inside each shard, in an order that is random but the same in every run.

    Keys are dealt to blocks by hash; a small table of block sizes says where a
    block starts, so no shard is ever sorted as a whole.
    """
    mixed = F.xxhash64(F.col(key), F.lit(99))
    cut = rows.withColumns({"_mixed": mixed, "_block": F.pmod(mixed, F.lit(blocks))})
    sizes = cut.groupBy(F.col(shard).alias("_of"), F.col("_block").alias("_in")).agg(F.count("*").alias("_size"))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_of", "_in", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(shard, "_block").orderBy("_mixed", key, *tie)
    numbered = cut.withColumn("_nth", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, (F.col(shard) == F.col("_of")) & (F.col("_block") == F.col("_in")))
        .withColumn(name, F.col("_nth") + F.col("_start"))
        .select(*rows.columns, name)
    )


def assign(
    docs: DataFrame, shards: int = 16, weights: list[float] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as empty.
    ``grown_shard`` is where the record goes with one more shard of weight 1.
    Texts are read, not moved. Rows with the same key share a shard.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    thin = store(
        docs.select(F.col(key).alias("_key"), body.alias("_body")).select(
            F.col("_key").alias(key),
            (F.octet_length("_body") + 1).cast("long").alias("size"),
            F.crc32(F.col("_body").cast("binary")).alias("text_crc32"),
            rendezvous(F.col("_key"), shards, weights).alias("shard"),
            rendezvous(F.col("_key"), shards + 1, [*(weights or [1.0] * shards), 1.0]).alias("grown_shard"),
        ),
        "shards",
    )
    return slots(thin, "shard", key, ["text_crc32", "size"])


def write_shards(docs: DataFrame, path: str, shards: int = 16, weights: list[float] | None = None, key: str = "doc_id") -> None:
    """Write whole records to one folder ``shard=k`` per shard.

    The rebalance hint lets Spark split large shards over several files and
    join the small ones of a shard.
    """
    name = "shard"
    out = docs.withColumn(name, rendezvous(F.col(key), shards, weights))
    out.hint("rebalance", name).write.mode("overwrite").partitionBy(name).parquet(path)
