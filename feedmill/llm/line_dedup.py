"""Removal of line chunks that occur more than once in the corpus.

A rolling hash over line hashes cuts each text into chunks: a chunk ends where
the hash of the last ``WINDOW`` lines hits one of ``DIVISOR`` residues, so
lines inserted earlier in a text move a boundary only near the insertion. Two
chunkings are used. In the first every line of ``PASSAGE`` or more words is a
chunk by itself, so a repeated one-line passage is found wherever it stands; in
the second only the rolling hash cuts. Chunks count if they have two lines with
words or are such a passage.

Passages of ``PASSAGE`` or more words over several lines are found by windows:
the shortest runs of lines with so many words, from each line on and up to each
line. They are chunks like the others and do not depend on what surrounds them.

The first occurrence, by key and place, stays; the other occurrences are
removed after their bytes are compared, inside one document only those that do
not overlap the first. Only hashes and places are shuffled for
all chunks, texts only for those whose hash occurs twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from feedmill.functions.text import bind
from feedmill.llm.common import slices, small_batches, store, unwrap, wrap

WINDOW = 2
DIVISOR = 3
PASSAGE = 50
LEAST_WORDS = 8
_BASE = 0x9E3779B97F4A7C15
_TOP = 1 << 64


def _cuts(hashes: list[int], sizes: list[int], isolate: bool) -> list[tuple[int, int]]:
    """``(first line, end line)`` of the chunks of one chunking that count."""
    out, start, rolling = [], 0, 0
    drop = pow(_BASE, WINDOW, _TOP)

    def close(end: int) -> None:
        held = sizes[start:end]
        if sum(held) >= LEAST_WORDS and (sum(n > 0 for n in held) > 1 or (end - start == 1 and held[0] >= PASSAGE)):
            out.append((start, end))

    for i, h in enumerate(hashes):
        if isolate and sizes[i] >= PASSAGE and start < i:
            close(i)
            start = i
        rolling = (rolling * _BASE + h) % _TOP
        if i >= WINDOW:
            rolling = (rolling - hashes[i - WINDOW] * drop) % _TOP
        # The high bits of a product are mixed best.
        if ((rolling * _BASE) % _TOP >> 32) % DIVISOR == 0 or i + 1 == len(hashes) or (isolate and sizes[i] >= PASSAGE):
            close(i + 1)
            start = i + 1
    return out


def windows(sizes: list[int]) -> list[tuple[int, int]]:
    """``(first line, end line)`` of the shortest runs of lines with ``PASSAGE`` words, from each line on and up to each line.

    Every line of a passage of that many words, from its first line with words
    to its last, is in a window that lies in the passage. So two texts share
    such a passage just where they share its windows, and the shared windows
    together are the whole of it, with no boundary that depends on the lines
    around. Fewer than twice ``PASSAGE`` windows go over a line.
    """
    full = [i for i, n in enumerate(sizes) if n]
    out, start, end, held = set(), 0, 0, 0
    # Two pointers over the lines with words: held is the sum of full[start:end].
    for start, i in enumerate(full):
        while end < len(full) and held < PASSAGE:
            held += sizes[full[end]]
            end += 1
        if held < PASSAGE:
            break
        out.add((i, full[end - 1] + 1))
        held -= sizes[i]
    start, held = 0, 0
    for i in full:
        held += sizes[i]
        while held - sizes[full[start]] >= PASSAGE:
            held -= sizes[full[start]]
            start += 1
        if held >= PASSAGE:
            out.add((full[start], i + 1))
    # Blank lines between two lines that are windows by themselves.
    for i, j in zip(full, full[1:]):
        if j > i + 1 and sizes[i] >= PASSAGE and sizes[j] >= PASSAGE:
            out.add((i, j + 1))
    return sorted(out)


def spans(lines: list[bytes], isolate: bool) -> list[tuple[int, int]]:
    """``(first line, end line)`` of the chunks that count; with ``isolate`` the windows are among them."""
    sizes = [len(line.split()) for line in lines]
    found = _cuts([xxhash.xxh64_intdigest(line) for line in lines], sizes, isolate)
    return sorted({*found, *windows(sizes)}) if isolate else found


def chunks(text: str | None, isolate: bool) -> list[tuple[int, int, bytes]]:
    """``(first line, end line, bytes)`` of the chunks that count; none for a null or blank text."""
    lines = (text or "").encode().split(b"\n")
    return [(a, b, b"\n".join(lines[a:b])) for a, b in spans(lines, isolate)]


def _places(docs: DataFrame) -> DataFrame:
    """``(_key, _print, first, end, hash, more)`` of all chunks of ``docs(_key, _print, _text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, first, end, code, more = [], [], [], [], []
            for n, text in enumerate(batch.column(2).to_pylist()):
                lines = (text or "").encode().split(b"\n")
                # The same chunk in both chunkings counts once.
                for a, b in {*spans(lines, True), *spans(lines, False)}:
                    row.append(n)
                    first.append(a)
                    end.append(b)
                    digest = xxhash.xxh3_128_intdigest(b"\n".join(lines[a:b]))
                    code.append(digest >> 64)
                    more.append(digest & (_TOP - 1))
            took = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(took), batch.column(1).take(took), pa.array(first, pa.int32()),
                    pa.array(end, pa.int32()), *(pa.array(np.array(h, dtype=np.uint64).view(np.int64)) for h in (code, more)),
                ],
                names=["_key", "_print", "first", "end", "hash", "more"],
            )

    numbers = {"first": IntegerType(), "end": IntegerType(), "hash": LongType(), "more": LongType()}
    fields = [StructField(n, t) for n, t in numbers.items()]
    schema = StructType([docs.schema["_key"], docs.schema["_print"], *fields])
    return docs.mapInArrow(run, schema)


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_key, _print, _gone)``: per document the numbers of the lines to remove.

    A later occurrence of a chunk goes with all its lines if the first one is
    in another document. Inside one document it is a repeat only if it does not
    overlap the first one, and lines of first occurrences stay: so a text of
    equal lines, a refrain or a table keeps each passage whole once.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_print"), F.col(text).alias("_text"))
    places = store(_places(slim), "chunks")
    often = places.groupBy("hash", "more").agg(F.count("*").alias("_n")).filter("_n > 1")
    often = often.select(F.col("hash").alias("_hash"), F.col("more").alias("_more"))
    same = (F.col("hash") == F.col("_hash")) & (F.col("more") == F.col("_more"))
    # Chunks have no size bound and take many times their files' bytes in memory, so they are never broadcast.
    found = store(places.hint("merge").join(often, same).drop("_hash", "_more"), "repeated_chunks")
    # A struct compares null keys as equal.
    own = F.struct("_key", "_print")
    chunk = F.struct("first", "end", "hash", "more")
    per_doc = found.groupBy(own.alias("_doc")).agg(F.collect_set(chunk).alias("_c"))
    texts = slim.withColumn("_own", own).join(per_doc, F.col("_own") == F.col("_doc"))
    # Bytes are cut out before the explode, which would copy all lines for each chunk.
    cut = bind(
        F.split("_text", "\n"),
        lambda lines: F.transform(
            "_c", lambda c: F.struct(
                c.alias("c"), F.array_join(F.slice(lines, c["first"] + 1, c["end"] - c["first"]), "\n").alias("bytes")
            ),
        ),
    )
    texts = texts.select("_key", "_print", F.inline(cut)).select("_key", "_print", "c.*", F.col("bytes").alias("_bytes"))
    # Null keys come last, so a document with a key keeps its chunk.
    place = F.struct(F.col("_key").isNull().alias("none"), "_key", "_print", "first", "end")
    groups = texts.groupBy("hash", "more").agg(
        F.min("_bytes").alias("_lo"), F.max("_bytes").alias("_hi"), F.min(place).alias("_first")
    )
    # Equal hashes of 128 bits over different bytes, should they ever meet, are left alone.
    groups = groups.filter(F.col("_lo") == F.col("_hi")).select(F.col("hash").alias("_hash"), F.col("more").alias("_more"), "_first")
    seen = found.hint("merge").join(groups, same)
    here = F.col("_first._key").eqNullSafe(F.col("_key")) & (F.col("_first._print").eqNullSafe(F.col("_print")))
    lines = F.struct("first", "end")
    # F.when without a match is null, which collect_set leaves out.
    spans = seen.groupBy("_key", "_print").agg(
        F.collect_set(F.when(~here, lines)).alias("_other"),
        F.collect_set(F.when(here & (F.col("first") >= F.col("_first.end")), lines)).alias("_repeat"),
        F.collect_set(F.when(place == F.col("_first"), lines)).alias("_kept"),
    )
    each = lambda c: F.array_distinct(F.flatten(F.transform(c, lambda s: F.sequence(s["first"], s["end"] - 1))))
    gone = F.array_union(each("_other"), F.array_except(each("_repeat"), each("_kept")))
    return spans.select("_key", "_print", F.array_sort(gone).alias("_gone")).filter(F.size("_gone") > 0)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``, plus ``_removed`` (number of lines cut).

    A null text stays null; a text that is nothing but repeats of other
    documents becomes empty. Rows that are equal in key and text are one
    document and are cut alike.
    """
    spans = store(removals(docs, key, text), "line_spans")
    spans = spans.select(F.struct("_key", "_print").alias("_of"), "_gone")
    rows = wrap(docs, _text=F.col(text), _own=F.struct(F.col(key).alias("_key"), F.xxhash64(text).alias("_print")))
    # The spans of a corpus have no size bound, so they are never broadcast.
    joined = rows.hint("merge").join(spans, F.col("_own") == F.col("_of"), "left")
    # Lines are cut by place, in one pass over the places.
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.transform(places, lambda i: F.get("_lines", i))
    joined = joined.withColumn("_lines", F.when(F.col("_gone").isNotNull(), F.split("_text", "\n")))
    new = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return unwrap(joined, docs.columns, F.coalesce(F.size("_gone"), F.lit(0)).alias("_removed"), **{text: new})
