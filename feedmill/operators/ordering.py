"""Ordering inside groups that may be very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def first_k(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows per group with their rank.

    The rank filter makes Spark cut every group to ``k`` rows before the
    shuffle as well, so a hot group never travels whole.
    """
    window = Window.partitionBy(*keys(by)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_rows(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows per group of a table with wide rows.

    The rank filter cuts every group to ``n`` rows in each task before the
    shuffle, so only texts that may be in the result are moved, whatever the
    number of groups and however large one is.
    """
    return first_k(df, by, [F.col(order)], n, "_rank").drop("_rank")


def deal_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt to all tasks by ``columns``, which tell most rows apart.

    A file is read by as many tasks as it has row groups, often one; a step that
    costs far more than moving its rows goes over dealt ones.
    """
    return df.repartition(*columns)


def number_rows(
    df: DataFrame, by: str | Sequence[str], order: str, name: str = "row_number", block: int = 1 << 16
) -> DataFrame:
    """Exact 1-based row numbers per group without one task per group.

    ``order`` is a whole number, unique in its group. Rows are cut into blocks
    of ``block`` order values; a small table of block sizes gives the number of
    rows before each block, and only the rows of one block are sorted together.
    """
    # A struct compares null keys as equal, so one plain key serves grouping,
    # join and window, and the rows are shuffled once.
    group = F.struct(*[F.col(c) for c in keys(by)])
    cut = df.withColumns({"_group": group, "_block": F.floor(F.col(order) / block)})
    sizes = cut.groupBy("_group", "_block").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group", "_block").orderBy(order)
    return (
        cut.join(starts, ["_group", "_block"])
        .withColumn(name, F.row_number().over(inside) + F.col("_before"))
        .select(*df.columns, name)
    )
