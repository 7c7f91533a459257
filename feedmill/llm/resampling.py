"""Importance resampling of documents towards a target text collection.

Features of a text are its runs of one to three words, hashed into ``BUCKETS``
buckets. Counts of both collections give each bucket a gain, an array of fixed
length that travels to all tasks; a document's weight is the sum of the gains
of its features. Random noise that depends on the document alone makes the
highest scores a sample without replacement.

The highest scores are found without sorting the table: a quantile sketch names
a bracket of scores around the cutoff, exact counts outside it tell whether the
cutoff is in it (else it is widened), and only the rows of the bracket are
sorted to locate the last one drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedmill.llm.common import slices, small_batches, store, unwrap, wrap

BUCKETS = 10_000
#: Runs of one word up to so many.
RUN = 3
#: Words whose features are held at a time.
PART = 1 << 15
#: The sketch's rank error is the number of rows divided by this.
ACCURACY = 10_000

#: ASCII letters are lower-cased, all other ASCII signs but digits separate words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def buckets(found: list[bytes]) -> Iterator[np.ndarray]:
    """Buckets of all features, in bounded parts.

    The checksum of a run goes on from that of the run without its last word.
    """
    for at in range(0, len(found), PART):
        # A part has the runs that begin in it.
        part = found[at : at + PART + RUN - 1]
        here = min(PART, len(found) - at)
        codes = list(map(crc32, part[:here]))
        spaced = [b" " + w for w in part[1:]]
        out = [codes]
        for n in range(1, RUN):
            codes = list(map(crc32, spaced[n - 1 :], codes))
            out.append(codes)
        yield np.concatenate([np.array(c, np.uint32) for c in out]) % BUCKETS


def bucket_counts(texts: DataFrame, text: str = "text") -> list[int]:
    """How often each bucket occurs in all texts. A task sends one number per bucket at most."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in slices(iter([batch])):
                for data in piece.column(0).cast(pa.binary()).to_pylist():
                    for part in buckets(words(data)):
                        total += np.bincount(part, minlength=BUCKETS)
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    schema = StructType([StructField("bucket", LongType()), StructField("n", LongType())])
    counts = texts.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
    out = [0] * BUCKETS
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandfold logarithm of each bucket's share in the target over that in the source, with one added to each count."""
    s_all, t_all = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def weigh(docs: DataFrame, gain: list[int], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) plus ``_words``, ``_features`` and ``_weight``."""
    names = docs.columns if carry is None else carry
    small_batches(docs.sparkSession)
    values = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            size, features, weight = [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                found = words(data)
                n = total = 0
                for part in buckets(found):
                    n += len(part)
                    total += int(values[part].sum())
                size.append(len(found))
                features.append(n)
                weight.append(total)
            numbers = [pa.array(x, pa.int64()) for x in (size, features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], names=["_doc", "_words", "_features", "_weight"])

    rows = docs.select(F.struct(*names).alias("_doc"), F.col(text).cast("string").alias("_text"))
    made = [StructField(c, LongType()) for c in ("_words", "_features", "_weight")]
    done = rows.mapInArrow(run, StructType([rows.schema["_doc"], *made]))
    return unwrap(done, names, "_words", "_features", "_weight")


def noise(key: Column, seed: int) -> Column:
    """Thousandfold Gumbel noise, floored, from the key alone; a null key counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def bracket(scores: DataFrame, score: str, most: int, total: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """``(low, high, above)``: fewer than ``most`` rows lie above ``high``, at least ``most`` at ``low`` or above.

    A sketch proposes the bounds and exact counts check them; a bound that does
    not hold moves outwards by twice as much each time, so the bracket always holds in the end.
    """
    slack = 2.0 / accuracy
    while True:
        at = 1.0 - most / total
        ends = [max(0.0, at - slack), min(1.0, at + slack)]
        low, high = scores.agg(F.percentile_approx(score, ends, accuracy)).first()[0]
        if ends[0] == 0.0 or ends[1] == 1.0:
            # The ends of the sketch are not the ends of the table.
            least, largest = scores.agg(F.min(score), F.max(score)).first()
            low = least if ends[0] == 0.0 else low
            high = largest if ends[1] == 1.0 else high
        above, reach = scores.agg(F.count_if(F.col(score) > high), F.count_if(F.col(score) >= low)).first()
        if above < most <= reach:
            return low, high, above
        slack *= 2


def _numbered(rows: DataFrame, order: list[Column], start: int, name: str) -> DataFrame:
    """``rows`` with gapless numbers from ``start`` in ``order``: sorted ranges, then the size of each range as its offset."""
    spark = rows.sparkSession
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The place is fixed once it is written; a later task only reads it.
    placed = rows.repartitionByRange(many, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = store(placed, "ordered")
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, held = {}, start
    for p in sorted(sizes):
        offsets[p] = held
        held += sizes[p]
    # One entry for each partition.
    table = F.create_map(*[F.lit(x) for p, o in offsets.items() for x in (p, o)]) if offsets else F.create_map()
    inside = F.col("_at") - F.shiftleft(part, 33)
    return placed.withColumn(name, (F.element_at(table, part) if offsets else F.lit(start)) + inside).drop("_at")


def draw(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    key: str = "doc_id", text: str = "text", target_text: str = "text", accuracy: int = ACCURACY, carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) plus ``_features``, ``_weight``, ``_score`` and ``_rank``: 1, 2, ... for the drawn ones, null for the others.

    Of the documents with ``least_words`` words or more, ``percent`` % are
    drawn. Null and empty texts have no feature, weight 0 and are never drawn.
    Of equal scores the smaller key goes first, null keys last; rows that are
    equal in both as well go by their weights and their order of storage.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    names = docs.columns if carry is None else list(dict.fromkeys([*carry, key]))
    weighed = wrap(weigh(docs, gain, text, names), _key=F.col(key))
    scored = weighed.select(
        "_doc", "_key", (F.col("_doc._words") >= least_words).alias("_in"),
        (F.col("_doc._weight") + noise(F.col("_key"), seed)).alias("_score"), F.monotonically_increasing_id().alias("_row"),
    )
    # Stored, so that each text is weighed once and row numbers stay.
    rows = store(scored, "weighed")
    total = rows.filter("_in").count()
    most = percent * total // 100

    def finish(part: DataFrame, rank: Column) -> DataFrame:
        return unwrap(
            part, [], *[F.col(f"_doc.`{c}`") for c in names], "_doc._features", "_doc._weight", "_score", rank.alias("_rank")
        )

    if not most:
        return finish(rows, F.lit(None).cast("long"))
    low, high, above = bracket(rows.filter("_in"), "_score", most, total, accuracy)
    order = [F.desc("_score"), F.asc_nulls_last("_key"), F.asc("_weight"), F.asc("_row")]
    ranked = lambda part: part.select("_score", "_key", F.col("_doc._weight").alias("_weight"), "_row")
    inside = ranked(rows.filter(F.col("_in") & F.col("_score").between(low, high)))
    last = _numbered(inside, order, above + 1, "_n").filter(F.col("_n") == most).first()
    # Drawn rows are those up to the last one in the same order.
    after = F.when(
        F.col("_key").eqNullSafe(F.lit(last["_key"])),
        F.struct(F.col("_doc._weight").alias("w"), F.col("_row").alias("r"))
        <= F.struct(F.lit(last["_weight"]).alias("w"), F.lit(last["_row"]).alias("r")),
    ).otherwise(
        F.col("_key").isNotNull() if last["_key"] is None else F.coalesce(F.col("_key") < F.lit(last["_key"]), F.lit(False))
    )
    drawn = F.col("_in") & ((F.col("_score") > last["_score"]) | ((F.col("_score") == last["_score"]) & after))
    top = _numbered(rows.filter(drawn).withColumn("_weight", F.col("_doc._weight")), order, 1, "_n")
    return finish(top, F.col("_n").cast("long")).unionByName(finish(rows.filter(~drawn), F.lit(None).cast("long")))
