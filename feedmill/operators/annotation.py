"""Segment annotators: language, sentiment, entities, key phrases.

The default annotators are row-local column expressions over short word lists
and patterns. A user's own scorer runs as an Arrow function in batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedmill.operators.ordering import first_k
from feedmill.operators.segments import BATCH_SIZE

DEFAULT_LANGUAGE = "en"

#: Frequent function words per language, strongest tie-break first.
LANGUAGE_PROFILES = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "this", "are", "from"),
    "fr": ("le", "la", "les", "et", "des", "du", "une", "dans", "qui", "pour", "par", "sur", "est", "avec"),
    "de": ("der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "auf", "ist", "nicht", "dem", "ein"),
    "es": ("el", "los", "las", "del", "por", "con", "una", "su", "para", "como", "al", "lo", "y", "se"),
}

POSITIVE_WORDS = (
    "good", "great", "excellent", "best", "love", "loved", "happy", "perfect", "amazing",
    "recommend", "reliable", "helpful", "fast", "easy", "pleased", "satisfied", "solid",
)
NEGATIVE_WORDS = (
    "bad", "poor", "terrible", "awful", "worst", "broken", "slow", "disappointed", "useless",
    "worthless", "trash", "pathetic", "stupid", "idiot", "moron", "scum", "refund", "defective",
)

#: Entity type -> pattern. Plain classes only: no look-around, no nested loops.
ENTITY_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]",
    "URL": r"https?://[A-Za-z0-9./?=&_%#:+~-]+",
    "IP": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "QUANTITY": r"[0-9][0-9.,]*%?",
    "NAME": r"[A-Z][a-z]+ [A-Z][a-z]+",
}

#: Text every match of a default pattern holds.
ENTITY_MARKS = {"EMAIL": "@", "URL": "://"}
#: The same matches by a search that takes every run of characters at once and
#: is linear in it; runs without the mark are dropped afterwards.
ENTITY_SCANS = {"EMAIL": r"[A-Za-z0-9._%+-]++(?:@[A-Za-z0-9.-]*[A-Za-z0-9])?"}

#: Words that end a key phrase.
STOP_WORDS = tuple(
    dict.fromkeys(
        [w for profile in LANGUAGE_PROFILES.values() for w in profile]
        + "a an as at be by he or on than but not have has had you i we they de en que un au ou ne pas se".split()
    )
)


BREAK = "|"


def words_of(col: Column) -> Column:
    """Lower-cased runs of letters and digits; the array may hold one empty text."""
    return F.split(F.lower(col), r"[^\p{L}\p{N}]+")


def tokens_of(col: Column) -> Column:
    """Lower-cased runs of letters and digits, with ``|`` wherever anything but
    blanks stands between two; one split serves all default annotators."""
    marked = F.regexp_replace(F.lower(col), r"[^a-z0-9 \p{L}\p{N}]+", f" {BREAK} ")
    return F.split(marked, " +")


def _listed(tokens: Column, listed: Sequence[str]) -> Column:
    return F.size(F.filter(tokens, lambda w: w.isin(*listed)))


def language_of(
    col: Column,
    profiles: dict[str, Sequence[str]] = LANGUAGE_PROFILES,
    default: str = DEFAULT_LANGUAGE,
    head_chars: int | None = None,
    tokens: Column | None = None,
) -> Column:
    """Language whose profile has most hits; earlier profiles win ties. [NLP4]

    ``head_chars`` limits the look to the start of the text, as a hosted
    detector would; ``tokens`` are its ``words_of`` or ``tokens_of`` if at hand.
    """
    if tokens is None:
        tokens = words_of(col if head_chars is None else F.substring(col, 1, head_chars))
    every = [w for profile in profiles.values() for w in profile]

    def best(hits: Column) -> Column:
        top = F.array_max(
            F.array(
                *[
                    F.struct(_listed(hits, profile).alias("n"), F.lit(-i).alias("rank"), F.lit(name).alias("lang"))
                    for i, (name, profile) in enumerate(profiles.items())
                ]
            )
        )
        return F.when(top["n"] > 0, top["lang"])

    # One-element transform: the token hits are computed once and used often.
    hits = F.filter(tokens, lambda w: w.isin(*every))
    return F.coalesce(F.transform(F.array(hits), best)[0], F.lit(default))


def detect_language(
    segments: DataFrame,
    by: str = "source_key",
    profiles: dict[str, Sequence[str]] = LANGUAGE_PROFILES,
    default: str = DEFAULT_LANGUAGE,
    head_chars: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """Language of each file, taken from its first segment.

    ``dense`` says that every file has a segment 0, so no grouping is needed.
    """
    language = language_of(F.col("segment"), profiles, default, head_chars)
    if dense:
        return segments.filter(F.col("seg_no") == 0).select(by, language.alias("language"))
    # Each task keeps one segment per file before anything is analysed or moved.
    first = first_k(segments.select(by, "seg_no", "segment"), by, [F.col("seg_no")], 1, "_rank")
    return first.select(by, language.alias("language"))


def lexicon_sentiment(
    col: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    tokens: Column | None = None,
) -> Column:
    """Label and four scores from word counts. [NLP5]

    With ``p`` and ``n`` hits the scores share ``p + n + 1``: one part neutral,
    two per opposing pair mixed, the rest positive or negative.
    """

    def score(counts: Column) -> Column:
        p, n = counts["p"], counts["n"]
        both = F.least(p, n)
        whole = p + n + 1
        label = (
            F.when((p > 0) & (n > 0), "MIXED")
            .when(p > 0, "POSITIVE")
            .when(n > 0, "NEGATIVE")
            .otherwise("NEUTRAL")
        )
        return F.struct(
            label.alias("label"),
            F.struct(
                ((p - both) / whole).alias("Positive"),
                ((n - both) / whole).alias("Negative"),
                (F.lit(1) / whole).alias("Neutral"),
                (both * 2 / whole).alias("Mixed"),
            ).alias("scores"),
        )

    tokens = words_of(col) if tokens is None else tokens
    hits = F.filter(tokens, lambda w: w.isin(*positive, *negative))
    # One-element transform: both counts are computed once and used many times.
    counts = F.transform(F.array(hits), lambda h: F.struct(
        F.size(F.filter(h, lambda w: w.isin(*positive))).alias("p"),
        F.size(F.filter(h, lambda w: w.isin(*negative))).alias("n"),
    ))
    return F.transform(counts, score)[0]


def annotate_sentiment(segments: DataFrame, scorer: Callable | None = None, **options) -> DataFrame:
    """Add ``label``, ``scores`` and ``error``. [NLP5]"""
    if scorer is not None:
        return score_batches(
            segments,
            scorer,
            "label string, scores struct<Positive:double,Negative:double,Neutral:double,Mixed:double>",
            **options,
        )
    rest = segments.columns
    done = segments.withColumn("_s", lexicon_sentiment(F.col("segment"), **options))
    return done.select(
        *rest, F.col("_s.label").alias("label"), F.col("_s.scores").alias("scores"),
        F.lit(None).cast("string").alias("error"),
    )


def entities_of(col: Column, patterns: dict[str, str] = ENTITY_PATTERNS) -> Column:
    """Array of (type, text) found by the patterns, type by type."""

    no_texts = F.expr("cast(array() as array<string>)")

    def of_type(name: str, pattern: str) -> Column:
        mark = ENTITY_MARKS.get(name) if pattern == ENTITY_PATTERNS.get(name) else None
        scan = ENTITY_SCANS.get(name, pattern) if mark else pattern
        texts = F.regexp_extract_all(col, F.lit(scan), F.lit(0))
        if mark:
            if scan != pattern:
                texts = F.filter(texts, lambda t: F.contains(t, F.lit(mark)))
            # Texts without the mark skip a pattern that is slow to fail.
            texts = F.when(F.contains(col, F.lit(mark)), texts).otherwise(no_texts)
        return F.transform(texts, lambda t: F.struct(F.lit(name).alias("type"), t.alias("text")))

    return F.concat(*[of_type(name, pattern) for name, pattern in patterns.items()])


def annotate_entities(segments: DataFrame, extractor: Callable | None = None, **options) -> DataFrame:
    """Add ``entities``, an array of (type, text), and ``error``. [NLP7]"""
    if extractor is not None:
        return score_batches(segments, extractor, "entities array<struct<type:string,text:string>>", **options)
    return segments.withColumn("entities", entities_of(F.col("segment"), **options)).withColumn(
        "error", F.lit(None).cast("string")
    )


def key_phrases_of(
    col: Column, stop_words: Sequence[str] = STOP_WORDS, tokens: Column | None = None
) -> Column:
    """Word runs, lower-cased, between stop words and anything but words and blanks."""
    tokens = tokens_of(col) if tokens is None else tokens
    cut = F.transform(tokens, lambda w: F.when(w.isin(*stop_words), BREAK).otherwise(w))
    return F.filter(F.split(F.btrim(F.array_join(cut, " ")), r"[ |]*\|[ |]*"), lambda p: p != "")


def annotate_key_phrases(segments: DataFrame, extractor: Callable | None = None, **options) -> DataFrame:
    """Add ``phrases``, an array of text, and ``error``. [NLP9]"""
    if extractor is not None:
        return score_batches(segments, extractor, "phrases array<string>", **options)
    return segments.withColumn("phrases", key_phrases_of(F.col("segment"), **options)).withColumn(
        "error", F.lit(None).cast("string")
    )


def score_batches(
    df: DataFrame,
    fn: Callable[[list], list],
    output: str,
    text: str = "segment",
    batch: int = BATCH_SIZE,
    retry_rows: bool = False,
) -> DataFrame:
    """Run a user's function over lists of at most ``batch`` texts.

    ``fn`` returns one value per text (a tuple if ``output`` names several
    columns, dicts for structs). A batch that raises keeps its rows: the columns
    are null and ``error`` holds the reason, so aggregates can leave them out.
    With ``retry_rows`` the texts of such a batch are tried one by one, so that
    a bad text costs only itself.
    Only the text column leaves the JVM. The call counts as non-deterministic,
    so that no optimizer rule runs a costly model twice for one row.
    """
    fields = T.StructType.fromDDL(output)
    names = fields.fieldNames()
    result = T.StructType([*fields.fields, T.StructField("error", T.StringType())])
    arrow_type = to_arrow_type(result)

    def score(texts: list) -> list[dict]:
        try:
            got = list(fn(texts))
            if len(got) != len(texts):
                raise ValueError(f"{len(got)} results for {len(texts)} texts")
            rows = [dict(zip(names, v if isinstance(v, tuple) else (v,))) for v in got]
            pa.array(rows, type=arrow_type)  # a wrong type is a failed batch too
            return rows
        except Exception as exc:  # noqa: BLE001 - any failure marks the batch
            return [{"error": f"{type(exc).__name__}: {exc}"} for _ in texts]

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts = column.to_pylist()
            rows: list[dict] = []
            for start in range(0, len(texts), batch):
                part = score(texts[start : start + batch])
                if retry_rows and len(part) > 1 and "error" in part[0]:
                    part = [row for text in texts[start : start + batch] for row in score([text])]
                rows += part
            yield pa.array(rows, type=arrow_type)

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, result).asNondeterministic()
    return df.withColumn("_scored", udf(F.col(text))).select(*df.columns, "_scored.*")
