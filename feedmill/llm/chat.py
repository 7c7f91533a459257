"""Collapse of cumulative conversation snapshots, and rendering of what is left.

Logs often hold every state of a growing conversation. A rolling hash runs over
the turns of each conversation, so the hash after turn k stands for the first k
turns. A conversation whose last hash is also the hash of a longer
conversation's prefix is dropped by an anti-join; of conversations with the
same turns the one with the smallest id stays.

No conversation is collected: turns are numbered and hashed in blocks, blocks
are chained through a small table, and rendering packs a bounded number of
turns into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.common import store

#: Turn numbers per block, and turns per rendered row.
BLOCK = 1024
PART = 256


def _turn_hash(seed: int) -> Column:
    parts = [F.lit(seed), F.col("_pos"), F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    return F.xxhash64(*parts)


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, _c, _pos, _a, _b)``: place and 128-bit prefix hash of each turn.

    Turns are ordered by number (null last), then role and text; repeated rows
    count once. Rows without ``conv_id`` are one conversation.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumns(
        {"_c": F.struct("conv_id"), "_k": F.struct(F.col("turn").isNull(), F.floor(F.col("turn") / BLOCK))}
    )
    inside = Window.partitionBy("_c", "_k").orderBy("turn", "role", "text")
    rows = store(rows.withColumn("_nth", F.row_number().over(inside)), "turns")
    earlier = Window.partitionBy("_c").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)

    def chained(rows: DataFrame, totals: dict[str, Column], over: dict[str, tuple[str, Column]]) -> DataFrame:
        """``rows`` with what all earlier blocks of the conversation add up to; one small row per block."""
        blocks = rows.groupBy("_c", "_k").agg(*[c.alias(n) for n, c in totals.items()])
        heads = blocks.select(
            F.col("_c").alias("_hc"), F.col("_k").alias("_hk"),
            *[F.coalesce(c.over(earlier), F.lit(0).cast("long")).alias(n) for n, (_, c) in over.items()],
        )
        return rows.join(heads, (F.col("_c") == F.col("_hc")) & (F.col("_k") == F.col("_hk"))).drop("_hc", "_hk")

    placed = chained(rows, {"_n": F.count("*")}, {"_before": ("_n", F.sum("_n"))})
    placed = placed.withColumn("_pos", F.col("_nth") + F.col("_before"))
    placed = placed.withColumns({"_x": _turn_hash(1), "_y": _turn_hash(2)})
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumns({"_rx": F.bit_xor("_x").over(run), "_ry": F.bit_xor("_y").over(run)})
    placed = placed.select("conv_id", "turn", "role", "text", "_c", "_k", "_pos", "_x", "_y", "_rx", "_ry")
    linked = chained(
        placed,
        {"_bx": F.bit_xor("_x"), "_by": F.bit_xor("_y")},
        {"_hx": ("_bx", F.bit_xor("_bx")), "_hy": ("_by", F.bit_xor("_by"))},
    )
    return linked.select(
        "conv_id", "turn", "role", "text", "_c", "_pos",
        F.col("_rx").bitwiseXOR(F.col("_hx")).alias("_a"), F.col("_ry").bitwiseXOR(F.col("_hy")).alias("_b"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """The turns of conversations that no other one contains: ``conv_id, _pos, n_turns, n_equal, role, text``.

    ``n_equal`` counts the conversations with exactly these turns.
    """
    marked = store(prefixes(turns), "prefixes")
    ends = marked.groupBy("_c").agg(F.max(F.struct("_pos", "_a", "_b")).alias("_end"))
    ends = ends.select("_c", F.col("_end._pos").alias("_len"), F.col("_end._a").alias("_ea"), F.col("_end._b").alias("_eb"))
    ends = store(ends, "ends")
    whole = ends.groupBy("_len", "_ea", "_eb").agg(
        # A named conversation before the one without an id.
        F.min(F.struct(F.col("_c.conv_id").isNull(), "_c")).alias("_best"), F.count("*").alias("n_equal")
    )
    # Every prefix that a longer conversation goes on from, summed up on the map side.
    inner = marked.join(ends.select("_c", "_len"), "_c").filter("_pos < _len").select("_pos", "_a", "_b").distinct()
    same = [whole["_len"] == inner["_pos"], whole["_ea"] == inner["_a"], whole["_eb"] == inner["_b"]]
    kept = whole.join(inner, same[0] & same[1] & same[2], "left_anti")
    kept = kept.select(F.col("_best._c").alias("_kc"), F.col("_len").alias("n_turns"), "n_equal")
    return marked.join(kept, F.col("_c") == F.col("_kc")).select("conv_id", "_pos", "n_turns", "n_equal", "role", "text")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in chat markup; markers inside the text are broken up, so a text cannot open a turn."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(
        F.lit("<|im_start|>"), safe(F.coalesce(role, F.lit("unknown"))), F.lit("\n"),
        safe(F.coalesce(text, F.lit(""))), F.lit("<|im_end|>\n"),
    )


def render(turns: DataFrame, part: int = PART) -> DataFrame:
    """``(conv_id, part, n_turns, n_equal, text)``: maximal conversations as chat texts.

    A row holds up to ``part`` turns; the rows of a longer conversation joined
    in the order of ``part`` are its text, and only the longest have more than
    one. An empty table gives no rows.
    """
    rows = maximal(turns).withColumn("_part", F.floor((F.col("_pos") - 1) / part))
    packed = rows.groupBy(F.struct("conv_id").alias("_c"), "_part", "n_turns", "n_equal").agg(
        F.sort_array(F.collect_list(F.struct("_pos", rendered_turn(F.col("role"), F.col("text")).alias("t")))).alias("_t")
    )
    return packed.select(
        "_c.conv_id", F.col("_part").alias("part"), "n_turns", "n_equal",
        F.array_join(F.transform("_t", lambda x: x["t"]), "").alias("text"),
    )
