"""Near-duplicate documents by SimHash, with pigeonring candidates.

A 64-bit fingerprint is cut into ``SEGMENTS`` segments in a ring. If two
fingerprints differ in at most ``bits`` bits, then from some segment on every
chain of ``l`` consecutive segments differs in at most ``l * bits / SEGMENTS``
bits. For 4 bits and 9 segments the first two segments of that chain are equal,
and so is one of the next two: 18 equi-join keys of 21 or 22 bits. The longer
chains are tested on the joined pair before the full Hamming distance.

Equal fingerprints are one node. Dense groups are linked along the sorted order
of a bucket first; only fingerprints that are still in different groups are
compared with each other after that, so a group is never expanded into all of
its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedmill.llm.common import components, slices, small_batches, store, unwrap, wrap

SHINGLE = 4
SEED = 42
BITS = 4
SEGMENTS = 9
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes; 0 without a word."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle + 1)
    starts, stops = first[:count].tolist(), ends[-count:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, BLOCK):
        hashes = np.array(
            [digest(line[a:b], seed) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])], dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_key, fp)`` per row; ``fp`` holds the 64 bits in a signed long."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["_key", "fp"])

    schema = StructType([slim.schema["_key"], StructField("fp", LongType(), False)])
    return slim.mapInArrow(run, schema)


def _segments(count: int = SEGMENTS) -> list[int]:
    """Bit masks of the ring's segments."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _keys(bits: int) -> list[tuple[int, int]]:
    """(start, mask) of the equi-join keys: the equal segments that each chain must hold.

    A chain's segments up to its first one with a budget of 1 are equal; of the
    segments that share that budget of one difference all but one are.
    """
    masks = _segments()
    budget = [(n + 1) * bits // SEGMENTS for n in range(SEGMENTS)]
    equal = budget.count(0)
    shared = [n for n in range(SEGMENTS) if budget[n] == 1]
    if not equal or equal == SEGMENTS:
        raise ValueError(f"bits must be from {1} to {SEGMENTS - 1}")
    out = []
    for start in range(SEGMENTS):
        seg = lambda n: masks[(start + n) % SEGMENTS]  # noqa: E731,B023
        fixed = sum(seg(n) for n in range(equal))
        out += [(start, fixed + sum(seg(n) for n in shared if n != skip)) for skip in shared or [None]]
    return out


def _viable(start: Column, x: Column, bits: int) -> Column:
    """Whether all chains from ``start`` on keep their budgets; ``x`` holds the differing bits."""
    masks, out = _segments(), F.lit(False)
    for s in range(SEGMENTS):
        chain, ok = 0, F.lit(True)
        for n in range(SEGMENTS):
            chain |= masks[(s + n) % SEGMENTS]
            ok = ok & (F.bit_count(x.bitwiseAND(_signed(chain))) <= (n + 1) * bits // SEGMENTS)
        out = F.when(start == s, ok).otherwise(out)
    return out


def link_groups(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """``(fp, group)`` for all distinct values of ``prints.fp``; ``group`` is a fingerprint of the group."""
    keys = _keys(bits)
    nodes = store(prints.select("fp").distinct(), "prints")
    fp = F.col("fp")
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.lit(s).alias("start"), fp.bitwiseAND(_signed(m)).alias("part"))
            for i, (s, m) in enumerate(keys)
        ]
    )

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select("fp", *more, F.inline(slots))

    # Neighbours in a bucket's sorted order: at most one link per row.
    order = Window.partitionBy("slot", "part").orderBy("fp")
    near = dealt(nodes).withColumn("_before", F.lag("fp").over(order))
    near = near.filter(F.bit_count(fp.bitwiseXOR(F.col("_before"))) <= bits)
    near = near.select(fp.alias("a"), F.col("_before").alias("b"))
    first = components(near, "near")
    first = nodes.join(first, fp == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("group"))
    first = store(first, "groups")

    # Buckets that still hold different groups: those groups are compared.
    spread = dealt(first, "group")
    mixed = spread.groupBy("slot", "part").agg(F.min("group").alias("_lo"), F.max("group").alias("_hi"))
    mixed = mixed.filter("_lo <> _hi").select("slot", "part")
    # The exploded keys are many times what Spark sizes them at, so they are never broadcast.
    rows = spread.hint("merge").join(mixed, ["slot", "part"])
    left = rows.select("slot", "part", "start", F.col("fp").alias("a"), F.col("group").alias("ga"))
    right = rows.select(F.col("slot").alias("_slot"), F.col("part").alias("_part"), F.col("fp").alias("b"), F.col("group").alias("gb"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    same = (F.col("slot") == F.col("_slot")) & (F.col("part") == F.col("_part"))
    close = (F.col("ga") < F.col("gb")) & _viable(F.col("start"), x, bits) & (F.bit_count(x) <= bits)
    far = left.hint("merge").join(right, same & close).select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    second = components(far, "far")
    return first.join(second, F.col("group") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "group").alias("group")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``(key, fp, component_id)`` per row: the smallest key reachable over links of ``bits`` bits or fewer.

    Null and blank texts have fingerprint 0 and are linked like any other.
    Repeated rows stay repeated. A null key never names a group, unless all of
    the group's keys are null.
    """
    prints = store(fingerprints(docs, key, text), "fingerprints")
    groups = store(link_groups(prints, bits), "fp_groups")
    # The smallest key per fingerprint comes first, so a group of copies is summed up on the map side.
    # Prints and groups have no size bound and are small only as files, so they are never broadcast.
    least = prints.groupBy("fp").agg(F.min("_key").alias("_least"))
    named = groups.hint("merge").join(least, "fp").groupBy("group").agg(F.min("_least").alias("component_id"))
    named = groups.hint("merge").join(named, "group").select(F.col("fp").alias("_fp"), "component_id")
    return prints.hint("merge").join(named, F.col("fp") == F.col("_fp")).select(F.col("_key").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with one document per group, the one with the smallest key.

    Rows with the same key are one document and stay or go together; rows
    without a key always stay.
    """
    found = near_duplicates(docs, key, text, bits)
    gone = found.filter(F.col("component_id") < F.col(key)).select(F.col(key).alias("_gone")).distinct()
    left = wrap(docs, _own=F.col(key)).join(gone, F.col("_own") == F.col("_gone"), "left_anti")
    return unwrap(left, docs.columns)
