"""CSV records with line breaks inside quotes, cut in all byte ranges of a file at once.

A line by itself does not tell whether it begins a record: that depends on the
quotes before it. But a line only has two effects: where it ends up (outside or
inside quotes) if it is entered outside, and where if it is entered inside. Such
pairs compose, so each byte range becomes one pair, a scan over the few ranges
of a file tells how each one is entered, and then every range cuts its own
records. Only records that go over the border of a range are put together
afterwards. A file is never read by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.functions.text import bind

#: States of the automaton between two quotes: at the start of a cell, in a
#: bare cell or behind a closed quote, inside quotes, just behind a quote that closes or is doubled.
START, BARE, INSIDE, CLOSING = 0, 1, 2, 3


def _ends_inside(line: Column, state: int) -> Column:
    """Whether a line that is entered in ``state`` ends inside quotes."""
    parts = F.split(line, '"')

    def step(now: Column, part: Column) -> Column:
        # A quote, then the text up to the next one.
        quote = F.when(now == START, INSIDE).when(now == INSIDE, CLOSING).when(now == CLOSING, INSIDE).otherwise(BARE)
        return bind(quote, lambda q: _text(q, part))

    def _text(now: Column, part: Column) -> Column:
        outside = F.when(part.endswith(","), START).otherwise(BARE)
        return F.when((part == "") | (now == INSIDE), now).otherwise(outside)

    first = _text(F.lit(state), F.get(parts, 0))
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.aggregate(rest, first, step) == INSIDE


def _effect(line: Column) -> dict[str, Column]:
    """``_out`` and ``_in``: whether the line ends inside quotes, entered outside or inside them."""
    quoted = F.contains(line, F.lit('"'))
    return {
        "_out": F.when(quoted, _ends_inside(line, START)).otherwise(False),
        "_in": F.when(quoted, _ends_inside(line, INSIDE)).otherwise(True),
    }


def _with_entry(rows: DataFrame, by: Window, first: Column, name: str) -> DataFrame:
    """``rows`` of ``_out, _in`` plus whether each is entered inside quotes, if the first one is entered as ``first`` says.

    Rows that end alike however they are entered decide for those behind them;
    between these, rows that turn the state are counted.
    """
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("_out") & ~F.col("_in"), 1).otherwise(0)).over(before), F.lit(0))
    fixed = F.when(F.col("_out") == F.col("_in"), F.struct("_turns", "_out"))
    rows = rows.withColumn("_turns", turns).withColumn("_fixed", F.last(fixed, True).over(before))
    turned = (F.col("_turns") - F.coalesce(F.col("_fixed._turns"), F.lit(0))) % 2 == 1
    return rows.withColumn(name, F.coalesce(F.col("_fixed._out"), first) != turned).drop("_turns", "_fixed")


def lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """``_file, _at, _id, line``: lines that end with LF, with the place of their byte range and a number that grows along the file."""
    files = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n").text(path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    at = F.col("_metadata.file_block_start")
    return files.select(
        F.col("_metadata.file_path").alias("_file"), at.alias("_at"), (at + place).alias("_id"),
        tx.decode_utf8(F.col("value")).alias("line"),
    )


def range_entries(rows: DataFrame) -> DataFrame:
    """``_rf, _ra, _first``: whether a byte range of a file is entered inside quotes.

    Only lines that do not leave the state as it is are kept of a range, at most
    a range's own lines; one row per range goes through the scan.
    """
    effects = rows.select("_file", "_at", "_id", *[c.alias(n) for n, c in _effect(F.col("line")).items()])
    moved = F.when(F.col("_out") | ~F.col("_in"), F.struct("_id", "_out", "_in"))
    ranges = effects.groupBy("_file", "_at").agg(F.collect_list(moved).alias("_moves"))
    same = F.struct(F.lit(False).alias("_out"), F.lit(True).alias("_in"))
    after = lambda s, m: F.when(s, m["_in"]).otherwise(m["_out"])
    whole = F.aggregate(
        F.array_sort("_moves"), same,
        lambda f, m: F.struct(after(f["_out"], m).alias("_out"), after(f["_in"], m).alias("_in")),
    )
    ranges = ranges.select("_file", "_at", whole.alias("_w")).select("_file", "_at", "_w.*")
    entered = _with_entry(ranges, Window.partitionBy("_file").orderBy("_at"), F.lit(False), "_first")
    return entered.select(F.col("_file").alias("_rf"), F.col("_at").alias("_ra"), "_first")


def _joined(pieces: Column) -> Column:
    """Texts of ``(_id, text)`` in the order of the file."""
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p["text"]), "\n")


def records(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """``_file, _id, record, is_header, is_open`` of CSV files; quoted cells may hold commas, doubled quotes and line breaks.

    ``_id`` grows along a file, ``is_header`` marks its first record with text.
    Blank lines outside quotes are no records. Lines end with LF or CR LF. A
    quote that is never closed takes the rest of its file, as in any reader;
    that record ``is_open``.
    """
    rows = lines(spark, path, recursive)
    entries = range_entries(rows)
    rows = rows.withColumns(_effect(F.col("line")))
    # The ranges of a file are few; Spark broadcasts them where their size allows.
    rows = rows.join(entries, (F.col("_file") == F.col("_rf")) & (F.col("_at") == F.col("_ra"))).drop("_rf", "_ra")
    by = Window.partitionBy("_file", "_at").orderBy("_id")
    rows = _with_entry(rows, by, F.col("_first"), "_inside")
    begins = ~F.col("_inside")
    blank = begins & F.col("line").rlike(r"\A[ \t\r]*\z")
    rows = rows.withColumn("_leaves", F.when(F.col("_inside"), F.col("_in")).otherwise(F.col("_out")))
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_no", F.sum(F.when(begins & ~blank, 1).otherwise(0)).over(upto))
    rows = rows.filter(~blank)
    # Same keys as the window and one more: no further shuffle.
    held = rows.groupBy("_file", "_at", "_no").agg(
        F.min("_id").alias("_id"), F.collect_list(F.struct("_id", F.col("line").alias("text"))).alias("_pieces"),
        F.max_by("_leaves", "_id").alias("_open"), F.min_by("_inside", "_id").alias("_goes_on"),
    )
    held = held.select("_file", "_at", "_no", "_id", _joined(F.col("_pieces")).alias("text"), "_open", "_goes_on")
    torn = F.col("_open") | F.col("_goes_on")
    first = (F.col("_at") == 0) & (F.col("_no") == 1)
    done = held.filter(~torn).select("_file", "_id", F.col("text").alias("record"), first.alias("is_header"), F.lit(False).alias("is_open"))
    # At most two torn pieces a range.
    chain = F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(Window.partitionBy("_file").orderBy("_id"))
    over = held.filter(torn).withColumn("_chain", chain).groupBy("_file", "_chain").agg(
        F.min("_id").alias("_id"), _joined(F.collect_list(F.struct("_id", "text"))).alias("record"),
        F.max(first).alias("is_header"), F.max_by("_open", "_id").alias("is_open"),
    )
    both = done.unionByName(over.select(*done.columns))
    # The line break of a record's end, and a byte order mark before the first.
    clean = F.regexp_replace("record", r"\r\z", "")
    return both.withColumn("record", F.when(F.col("is_header"), F.ltrim(clean, F.lit("\ufeff"))).otherwise(clean))


def cells(record: Column) -> Column:
    """The cells of a record, quotes undone; null where its quotes do not match.

    Between quotes every second part lies outside cells' texts, and only commas
    there separate cells. A noncharacter marks them (one in a text becomes the
    replacement character), so every step is linear.
    """
    quote, mark = F.lit('"'), F.lit("\ufdd1")
    parts = F.split(F.replace(record, mark, F.lit("\ufffd")), '"')
    marked = F.transform(parts, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(","), mark)).otherwise(p))
    found = F.split(F.array_join(marked, '"'), "\ufdd1")
    inside = lambda c: F.substr(c, F.lit(2), F.length(c) - 2)

    def whole(c: Column) -> Column:
        """A quoted cell ends with its closing quote and holds only doubled ones; a bare cell holds none."""
        quoted = (F.length(c) >= 2) & c.endswith('"') & ~F.contains(F.replace(inside(c), F.lit('""'), F.lit("")), quote)
        return F.when(c.startswith('"'), quoted).otherwise(~F.contains(c, quote))

    plain = lambda c: F.when(c.startswith('"'), F.replace(inside(c), F.lit('""'), quote)).otherwise(c)
    return bind(found, lambda f: F.when((F.size(parts) % 2 == 1) & F.forall(f, whole), F.transform(f, plain)))
