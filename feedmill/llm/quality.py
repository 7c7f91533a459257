"""Quality rules with risk-controlled thresholds.

The rules share a ladder of cutoffs from lax to strict. Per stratum (language)
the rung is the strictest one for which an exact binomial test on labelled good
documents shows that all rules together reject fewer than ``risk`` of the good
documents there.

Multiple testing: the error level ``delta`` is shared equally by the strata.
Inside a stratum the rungs are tested in their fixed order and the walk stops
at the first one that is not shown to be safe, which needs no further
correction.

Everything is DataFrame functions; the holdout is reduced to one row per
stratum before any test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedmill.llm.common import WORD, store, unwrap, wrap

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Between words.
GAP = r"[\x20\x09-\x0D]+"
#: Up to so many repeated windows of a text are looked up one by one; for more, the text's windows are sorted.
FEW = 24

#: Rule -> its cutoff on each rung, lax to strict. A document breaks a rule if
#: its value is above the cutoff.
RULES: dict[str, list[float]] = {
    "symbols_per_word": [2.5, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25],
    "dup_line_share": [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.6, 0.5],
    "repeat_word_share": [0.5, 0.49, 0.48, 0.47, 0.46, 0.45, 0.42, 0.4],
    "chars_per_word": [40.0, 35.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0],
    "upper_share": [0.95, 0.9, 0.8, 0.7, 0.65, 0.6, 0.55, 0.5],
}
RISK = 0.01
DELTA = 0.05


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` plus base counts and rule values, their names beginning with ``_q_``.

    These are plain columns, not fields of a struct: the optimizer would put a
    struct's expressions in place of every use of a field. A null text counts as empty. Word windows are compared by their 64-bit
    hash within one text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.select("*", F.split(body, GAP).alias("_t"), F.split(body, "\n").alias("_l"))
    # White space at either end leaves an empty first or last part.
    head = F.when(F.get("_t", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("_t") > 1) & (F.element_at("_t", -1) == ""), 1).otherwise(0)
    step = step.withColumns({"_head": head, "_nw": F.size("_t") - head - tail})
    words = F.when(F.col("_nw") == F.size("_t"), F.col("_t")).otherwise(F.slice("_t", F.col("_head") + 1, F.col("_nw")))
    step = step.withColumn("_w", words)
    # The hash of the window that begins at each word; the last two begin none.
    opens = F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))
    step = step.withColumn("_h", F.when(F.col("_nw") >= 4, F.slice(opens, 1, F.col("_nw") - 2)))
    # Only texts in which a window occurs twice go on.
    some = F.coalesce(F.size(F.array_distinct("_h")) < F.size("_h"), F.lit(False))
    step = step.withColumn("_o", F.when(some, F.sort_array("_h")))
    step = step.withColumn("_d", F.array_distinct(F.filter("_o", lambda h, k: F.get("_o", k + 1) == h)))
    few = F.size("_d") <= FEW
    spots = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_s", F.when(F.col("_d").isNotNull() & ~few, F.sort_array(spots)))
    same = lambda x, k: (F.get("_s", k + 1)["h"] == x["h"]) | ((k > 0) & (F.get("_s", k - 1)["h"] == x["h"]))
    place = F.transform("_h", lambda h, i: F.when(F.array_contains("_d", h), i))
    step = step.withColumn(
        "_p",
        F.when(F.col("_s").isNotNull(), F.transform(F.filter("_s", same), lambda x: x["i"]))
        .when(F.col("_d").isNotNull(), F.array_compact(place)),
    )
    covered = F.size(F.array_union(F.array_union("_p", F.transform("_p", lambda i: i + 1)), F.transform("_p", lambda i: i + 2)))
    lined = F.filter("_l", lambda x: F.rlike(x, F.lit(WORD)))
    step = step.withColumn("_l", lined)
    base = step.select(
        *docs.columns,
        F.col("_nw").cast("long").alias("_q_n_words"),
        F.length(F.regexp_replace(body, GAP, "")).cast("long").alias("_q_word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, f"[{SYMBOLS}]+", ""))).cast("long").alias("_q_n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_q_n_dup_lines"),
        F.when(F.col("_p").isNotNull(), covered).otherwise(0).cast("long").alias("_q_n_repeat_words"),
        F.size("_l").cast("long").alias("_q_n_lines"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long").alias("_q_n_upper"),
    )
    per = lambda a, b: F.coalesce(F.try_divide(F.col(f"_q_{a}"), F.col(f"_q_{b}")), F.lit(0.0))
    return base.select(
        "*",
        per("n_symbols", "n_words").alias("_q_symbols_per_word"),
        per("n_dup_lines", "n_lines").alias("_q_dup_line_share"),
        per("n_repeat_words", "n_words").alias("_q_repeat_word_share"),
        per("word_chars", "n_words").alias("_q_chars_per_word"),
        per("n_upper", "word_chars").alias("_q_upper_share"),
    )


def base_failed() -> Column:
    """The fixed rules: under 50 words, or over half of the words in repeated windows."""
    n, r = F.col("_q_n_words"), F.col("_q_n_repeat_words")
    return (n < 50) | (r * 100 > n * 50)


def binomial_cdf(k: Column, n: Column, p: float | Column) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding; a fold in log space."""
    p = F.lit(p) if isinstance(p, float) else p
    odds = F.log(p) - F.log(F.lit(1.0) - p)
    first = n * F.log(F.lit(1.0) - p)
    zero = F.struct(first.alias("term"), first.alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, acc["sum"]), F.least(term, acc["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.exp(F.least(F.aggregate(steps, zero, add)["sum"], F.lit(0.0)))


def _breaks(cutoff) -> Column:
    """Whether a document breaks any rule; ``cutoff`` gives a rule's cutoff."""
    return F.coalesce(F.greatest(*[F.col(f"_q_{rule}") > cutoff(rule) for rule in RULES]), F.lit(False))


def thresholds(holdout: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``(stratum, rung, n_good, n_rejected, p_value, cutoffs)``: the certified rung per stratum.

    ``holdout`` has good documents only: ``stratum`` and the columns of
    ``features``. A stratum whose holdout is too small for a proof has no row,
    and no rule rejects anything there. A null stratum is a stratum of its own.
    """
    rungs = range(len(next(iter(RULES.values()))))
    # All rungs are counted in one pass, so nothing is exploded before the shuffle.
    hits = [F.count_if(_breaks(lambda rule, i=i: F.lit(RULES[rule][i]))).alias(f"_hit{i}") for i in rungs]
    counts = holdout.groupBy(F.struct(F.col(stratum).alias("stratum")).alias("_at")).agg(
        F.count("*").alias("n_good"), *hits
    )
    counts = counts.withColumn("_level", F.lit(delta) / F.count("*").over(Window.partitionBy(F.lit(0))))
    tested = counts.select(
        "_at", "n_good", "_level", F.posexplode(F.array(*[F.col(f"_hit{i}") for i in rungs])).alias("rung", "n_rejected")
    )
    # At or above the expected number there is no proof, so the fold stays short.
    p_value = F.when(
        F.col("n_rejected") < F.col("n_good") * risk, binomial_cdf(F.col("n_rejected"), F.col("n_good"), risk)
    ).otherwise(F.lit(1.0))
    walk = Window.partitionBy("_at").orderBy("rung")
    tested = tested.withColumn("p_value", p_value)
    safe = tested.withColumn("_safe", F.min(F.col("p_value") <= F.col("_level")).over(walk)).filter("_safe")
    best = safe.groupBy("_at").agg(F.max_by(F.struct("rung", "n_good", "n_rejected", "p_value"), "rung").alias("_b"))
    cutoffs = F.struct(
        *[F.get(F.array(*[F.lit(c) for c in cuts]), F.col("_b.rung")).alias(rule) for rule, cuts in RULES.items()]
    )
    return best.select("_at.stratum", "_b.*", cutoffs.alias("cutoffs"))


def _prints(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("_p1"), F.xxhash64(F.lit(1), text).alias("_p2")]


def _once(held: DataFrame) -> DataFrame:
    """Copies of a text in a stratum are one draw, not several: an exact test wants independent ones."""
    return held.dropDuplicates(["_stratum", "_p1", "_p2"]).drop("_p1", "_p2")


def _good(labels: DataFrame, key: str) -> DataFrame:
    known = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
    return known.groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_low")).filter("_low = 1")


def verdicts(seen: DataFrame, holdout: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``seen`` plus ``_base`` and ``_kept``; both tables hold the columns of ``features``."""
    cut = store(thresholds(holdout.filter(~base_failed()), stratum, risk, delta), "thresholds")
    cut = cut.select(F.struct("stratum").alias("_at"), F.col("cutoffs").alias("_cut"))
    joined = seen.join(cut, F.struct(seen[stratum].alias("stratum")) == F.col("_at"), "left")
    broken = _breaks(lambda rule: F.col(f"_cut.{rule}"))
    # One expression over both sides: a filter on it is not pushed down in parts, which would count twice.
    kept = F.when(F.col("_base") | F.col("_broken"), False).otherwise(True)
    return joined.withColumns({"_base": base_failed(), "_broken": broken}).select(*seen.columns, "_base", kept.alias("_kept"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    stratum: str = "lang",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """The columns of ``docs`` plus those of ``features``, ``_base`` and ``_kept``.

    ``labels`` has ``key`` and ``quality`` (1 good, 0 bad); a document labelled
    both ways or not at all is not in the holdout, nor is one that the base
    rules reject. Repeated label rows and copies of a text count once. Without labels only the base
    rules reject. The labelled texts are read twice, and no text is moved.
    """
    slim = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(stratum).alias("_stratum"))
    held = _once(slim.join(_good(labels, key), "_key", "left_semi").select("_text", "_stratum", *_prints("_text")))
    held = store(features(held, "_text").drop("_text"), "holdout")
    seen = features(wrap(docs, _text=F.col(text), _stratum=F.col(stratum)), "_text")
    counts = [c for c in seen.columns if c.startswith("_q_")]
    return unwrap(verdicts(seen, held, "_stratum", risk, delta), docs.columns, *counts, "_base", "_kept")


def report(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    stratum: str = "lang",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """``judge`` without the texts: key, stratum, counts and verdict, with each text read once."""
    thin = docs.select(F.col(key).alias("_key"), F.col(stratum).alias("_stratum"), F.col(text).alias("_text"))
    seen = store(features(thin.select("*", *_prints("_text")), "_text").drop("_text"), "quality")
    held = _once(seen.join(_good(labels, key), "_key", "left_semi"))
    return verdicts(seen.drop("_p1", "_p2"), held, "_stratum", risk, delta).withColumnsRenamed({"_key": key, "_stratum": stratum})
