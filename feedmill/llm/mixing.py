"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document's expected number of copies is
``target / source size`` (times its relative weight); the whole part of it is
taken for certain, the fraction is an inclusion probability. Documents are
ranked by random odds over inclusion odds, and the sample is the beginning of
that order, as long as it fits into the words that are still open.

The order is never sorted as a whole: ranks fall into buckets, a small table of
bucket sums finds the bucket in which a source's target is reached, and only
that bucket's rows are put in order. A source that holds a third of all rows
costs one sum per task and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.common import n_words, store, uniform
from feedmill.llm.quality import SYMBOLS

#: No document is taken more often than this.
MOST = 2
BUCKETS = 4096


def targets(sizes: DataFrame, weights: list[float], share: float = 1.5, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)`` plus ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share ``share`` of all words. No target exceeds ``most`` times its source's
    size; the excess is shared by weight among the others. One row per source,
    which is all that is ordered globally.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").isNull(), "source")
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place))
    weighed = weighed.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    weighed = weighed.withColumn("_level", F.col("_cap") / F.col("weight"))
    # Raising a common level fills the sources; the one with the lowest cap per weight is full first.
    rising = everything.orderBy("_level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    all_weight = F.sum("weight").over(everything)
    full_cap, full_weight = F.sum("_cap").over(rising), F.sum("weight").over(rising)
    weighed = weighed.withColumns(
        {"_total": total, "_full": full_cap + F.col("_level") * (all_weight - full_weight) <= total, "_all": all_weight}
    )
    open_words = F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("weight") * open_words / open_weight)
    return weighed.withColumn("target", target).select("source", "source_size", "weight", "target")


def tidiness(text: str) -> Column:
    """A relative weight between a half and one: lower the more symbols a text has for its words.

    Above a half of the mean, so that a source whose target is twice its size can still be taken twice.
    """
    words, symbols = n_words(F.col(text)), F.coalesce(F.regexp_count(text, F.lit(f"[{SYMBOLS}]")), F.lit(0))
    return 0.5 + 0.5 * F.coalesce(F.try_divide(words, words + symbols), F.lit(0.0))


def _rank(p: Column, seed: int) -> Column:
    """Random odds over inclusion odds, mapped to (0, 1) by x / (1 + x), which keeps the order."""
    u = uniform(F.col("_id"), seed=seed)
    odds = (u / (1 - u)) * ((1 - p) / p)
    return odds / (1 + odds)


def mix(
    docs: DataFrame,
    weights: list[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: int = MOST,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weight: str | None = None,
    seed: int = 20,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The columns of ``docs`` plus ``_mix``: size, source_size, target, p, copies, taken.

    ``weight`` names a column of relative inclusion weights (null or <= 0: never
    taken beyond nothing); without it all documents of a source have equal
    odds. Null texts have size 0 and are taken 0 times. Null sources are one
    source. Rows with equal key and text rank equal and are taken together.
    Reruns agree: the random numbers are hashes of the key.

    What is open after the ordered sample is closed by the one remaining
    document per source whose size comes nearest to it, if that helps.
    """
    body = F.col(text)
    relative = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    row = F.struct(
        F.col(source).alias("s"), n_words(body).alias("n"), F.col(key).alias("id"),
        F.xxhash64(body).alias("h"), relative.alias("w"),
    )
    fields = [F.col("_r.s").alias("_s"), F.col("_r.n").alias("_n"), F.col("_r.id").alias("_id"), F.col("_r.h").alias("_h"), F.col("_r.w").alias("_w")]
    thin = store(docs.select(row.alias("_r")).select(*fields), "mix_sizes")

    by_source = thin.groupBy(F.col("_s").alias("source")).agg(
        F.sum("_n").alias("source_size"), F.sum(F.col("_n") * F.col("_w")).alias("_mass")
    )
    plan = store(
        targets(by_source.select("source", "source_size"), list(weights), share, most)
        .join(by_source.select(F.struct("source").alias("_at"), "_mass"), F.col("_at") == F.struct("source"))
        .withColumn("_rate", F.when(F.col("_mass") > 0, F.col("target") / F.col("_mass")).otherwise(0.0))
        .select(F.struct("source").alias("_at"), "source_size", "target", "_rate"),
        "mix_targets",
    )

    def expected(rows: DataFrame) -> DataFrame:
        """Adds the certain copies, the inclusion probability and the rank to ``_s, _n, _id, _h, _w``."""
        pi = F.least(F.col("_rate") * F.col("_w"), F.lit(float(most)))
        rows = rows.withColumn("_pi", F.when(F.col("_n") > 0, pi).otherwise(0.0))
        rows = rows.withColumn("_sure", F.floor("_pi").cast("long")).withColumn("_p", F.col("_pi") - F.floor("_pi"))
        return rows.withColumn("_q", F.when(F.col("_p") > 0, _rank(F.col("_p"), seed)))

    ranked = expected(thin.join(plan, F.struct(F.col("_s").alias("source")) == F.col("_at")))
    ranked = ranked.withColumn("_b", F.least(F.floor(F.col("_q") * buckets), F.lit(buckets - 1)))
    sure = ranked.groupBy(F.struct(F.col("_s").alias("source")).alias("_at")).agg(
        F.max("target").alias("_t"), F.sum(F.col("_sure") * F.col("_n")).alias("_sure_words")
    ).select("_at", (F.col("_t") - F.col("_sure_words")).alias("_open"))
    # Words per bucket, summed on the map side; at most `buckets` rows per source.
    sums = ranked.filter("_q is not null").groupBy(F.struct(F.col("_s").alias("source")).alias("_at"), "_b").agg(
        F.sum("_n").alias("_words")
    )
    upto = Window.partitionBy("_at").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (
        sums.withColumn("_upto", F.sum("_words").over(upto))
        .join(sure, "_at")
        .filter("_upto > _open")
        .groupBy("_at")
        .agg(F.min("_b").alias("_cut"), F.min_by(F.col("_upto") - F.col("_words"), "_b").alias("_before"))
    )
    border = store(sure.join(reached, "_at", "left"), "mix_border")
    # Only the bucket that holds the border is put in order.
    order = F.struct("_q", "_id", "_h")
    at = F.struct(F.col("_s").alias("source"))
    inside = ranked.withColumnRenamed("_at", "_of").join(border, (F.col("_of") == F.col("_at")) & (F.col("_b") == F.col("_cut")))
    peers = Window.partitionBy("_at").orderBy("_q", "_id", "_h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_sum", F.col("_before") + F.sum("_n").over(peers)).filter("_sum <= _open")
    last = inside.groupBy("_at").agg(F.max(order).alias("_last"), F.max("_sum").alias("_in"))
    border = store(
        border.join(last, "_at", "left").select(
            "_at", "_cut", "_last", "_open",
            # What stays open; without a border bucket the whole order fits and nothing is left to take.
            F.when(F.col("_cut").isNotNull(), F.col("_open") - F.coalesce("_in", "_before")).alias("_left"),
        ),
        "mix_last",
    )

    def taken_in_order() -> Column:
        in_last = F.col("_last").isNotNull() & (order <= F.col("_last"))
        return F.col("_q").isNotNull() & (
            F.col("_cut").isNull() | (F.col("_b") < F.col("_cut")) | ((F.col("_b") == F.col("_cut")) & in_last)
        )

    rest = ranked.withColumnRenamed("_at", "_of").join(border, F.col("_of") == F.col("_at"))
    rest = rest.filter(F.col("_q").isNotNull() & ~taken_in_order() & (F.col("_n") < 2 * F.col("_left")))
    # Rows that are equal rank equal and would be taken together.
    closing = rest.groupBy("_at", F.struct("_id", "_h").alias("_doc"), "_left", "_q").agg(F.sum("_n").alias("_all"))
    closing = closing.filter("_all < 2 * _left").groupBy("_at").agg(
        F.min_by("_doc", F.struct(F.abs(F.col("_all") - F.col("_left")), F.col("_q"), F.col("_doc"))).alias("_close")
    )
    final = store(
        plan.withColumnRenamed("_at", "_of")
        .join(border.select("_at", "_cut", "_last"), F.col("_of") == F.col("_at"))
        .drop("_of")
        .join(closing.select(F.col("_at").alias("_of"), "_close"), F.col("_of") == F.col("_at"), "left")
        .drop("_of"),
        "mix_plan",
    )
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), row.alias("_r")).select("_doc", *fields)
    whole = expected(whole.join(final, at == F.col("_at"), "left"))
    whole = whole.withColumn("_b", F.least(F.floor(F.col("_q") * buckets), F.lit(buckets - 1)))
    extra = taken_in_order() | F.coalesce(F.col("_close") == F.struct("_id", "_h"), F.lit(False))
    copies = F.when(F.col("_n") > 0, F.col("_sure") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)).otherwise(0)
    mixed = whole.withColumn("_copies", copies.cast("long"))
    return mixed.select(
        "_doc.*",
        F.struct(
            F.col("_n").alias("size"), "source_size", "target", F.col("_pi").alias("expected"),
            F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_n")).alias("taken"),
        ).alias("_mix"),
    )


def repeat(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, without ``_mix``."""
    names = [c for c in mixed.columns if c != "_mix"]
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_mix.copies").cast("int")))
    return mixed.select(*names, copies.alias("_copy")).select(*names)
