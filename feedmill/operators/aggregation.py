"""Per-file aggregates of annotations.

Counts are formed first, so what is ranked or collected afterwards is small;
ties go to the value seen first, tracked as one sortable number. Arrays are
exploded in the outer form and empty rows dropped after it: for the inner form
the optimizer tests the array's size first and thereby builds it twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import normalize_text, one_if_filled, strip
from feedmill.operators.annotation import (
    DEFAULT_LANGUAGE,
    annotate_entities,
    annotate_key_phrases,
    annotate_sentiment,
    language_of,
    tokens_of,
)
from feedmill.operators.ordering import deal_rows, first_k
from feedmill.operators.validation import summary_of, validate
from feedmill.schemas import ENTITIES_TYPE, ITEMS_TYPE, NLP_TYPE, SCORES_TYPE, SENTIMENT_TYPE

SCORES = ("Positive", "Negative", "Neutral", "Mixed")
TOP_ENTITIES = 10
TOP_PHRASES = 30
# Fixed value: Spark's arrays have fewer places than this.
_PLACES = 1 << 31
# Scores are summed as decimals: the sum does not depend on the order of rows.
_SCORE_TYPE = "decimal(18,12)"


def first_seen(seg_no: str, position: str) -> Column:
    """Segment number and place inside it as one ordered number.

    A decimal holds every pair of a long and an array place, and unlike a
    struct it keeps the aggregate in the hash table.
    """
    number = F.col(seg_no).cast("decimal(20,0)") * F.lit(_PLACES).cast("decimal(10,0)") + F.col(position).cast("decimal(10,0)")
    return number.cast("decimal(38,0)")


def _ordered(cols: list[str], order: Column) -> Column:
    """Collected structs of ``cols`` in ``order``; for short groups only."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("_o"), *cols)))
    return F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in cols]))


def _score_sums(scores: str) -> list[Column]:
    return [F.sum(F.col(f"{scores}.{s}").cast(_SCORE_TYPE)).alias(s) for s in SCORES]


def _sparse_score_sums(scores: str) -> list[Column]:
    """``_score_sums`` for rows of which few have scores, the same numbers of the same type.

    A decimal of this length is renewed as an object for every row, one with a
    null included. Thousandths and the rest below them are longs, which stay in
    place; both are below 10^9.
    """

    def total(name: str) -> Column:
        score = F.col(f"{scores}.{name}").cast(_SCORE_TYPE) * F.lit(1000)
        high = F.floor(score)
        low = (score - high) * F.lit(1_000_000_000)
        sums = [F.sum(part.cast("bigint")).cast("decimal(19,0)") for part in (high, low)]
        units = [F.expr(f"cast('{unit}' as decimal(12,12))") for unit in ("0.001", "0.000000000001")]
        return (sums[0] * units[0] + sums[1] * units[1]).cast("decimal(28,12)").alias(name)

    return [total(s) for s in SCORES]


def aggregate_sentiment(rows: DataFrame, by: str = "source_key") -> DataFrame:
    """Label counts, average scores, total and dominant label per file. [NLP6]

    Rows with an ``error`` are left out.
    """
    good = rows.filter(F.col("error").isNull())
    per_label = good.groupBy(by, "label").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("seg_no").alias("seen"),
        *_score_sums("scores"),
    )
    total = F.sum("cnt")
    averages = [x for s in SCORES for x in (F.lit(s), F.round(F.sum(s).cast("double") / total, 4))]
    return per_label.groupBy(by).agg(
        F.struct(
            F.map_from_entries(_ordered(["label", "cnt"], F.col("seen"))).alias("counts"),
            F.create_map(*averages).alias("average_scores"),
            F.max_by("label", F.struct("cnt", -F.col("seen"))).alias("dominant_sentiment"),
            total.alias("total_analyzed"),
        ).alias("sentiment")
    )


def entity_rows(rows: DataFrame, by: str = "source_key") -> DataFrame:
    """Exploded entities with their first-seen number."""
    return (
        rows.filter(F.col("error").isNull())
        .select(by, "seg_no", F.posexplode_outer("entities").alias("pos", "e"))
        .filter("pos is not null")
        .select(by, F.col("e.type").alias("type"), F.col("e.text").alias("text"), first_seen("seg_no", "pos").alias("seen"))
    )


def entity_totals(rows: DataFrame, by: str = "source_key") -> DataFrame:
    return (
        entity_rows(rows, by)
        .groupBy(by, "type", "text")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("seen").alias("seen"))
    )


def top_entities(rows: DataFrame, by: str = "source_key", k: int = TOP_ENTITIES) -> DataFrame:
    """The ``k`` most frequent texts of each entity type, with their rank. [NLP8]"""
    order = [F.desc("cnt"), F.asc("seen"), F.asc("text")]
    return first_k(entity_totals(rows, by), [by, "type"], order, k, "rank")


def aggregate_entities(rows: DataFrame, by: str = "source_key", k: int = TOP_ENTITIES) -> DataFrame:
    """Counts by type and top texts by type per file, types in first-seen order. [NLP8]"""
    totals = entity_totals(rows, by)
    per_type = totals.groupBy(by, "type").agg(F.sum("cnt").alias("total"), F.min("seen").alias("type_seen"))
    order = [F.desc("cnt"), F.asc("seen"), F.asc("text")]
    tops = first_k(totals, [by, "type"], order, k, "rank")
    lists = tops.groupBy(by, "type").agg(_ordered(["text", "cnt"], F.col("rank")).alias("top"))
    return (
        per_type.join(lists, [by, "type"])
        .groupBy(by)
        .agg(_ordered(["type", "total", "top"], F.col("type_seen")).alias("_t"))
        .select(
            by,
            F.struct(
                F.map_from_entries(
                    F.transform("_t", lambda t: F.struct(t["type"], t["total"]))
                ).alias("counts_by_type"),
                F.map_from_entries(
                    F.transform("_t", lambda t: F.struct(t["type"], t["top"]))
                ).alias("top_entities_by_type"),
            ).alias("entities"),
        )
    )


def phrase_totals(rows: DataFrame, by: str = "source_key") -> DataFrame:
    """Count of each lower-cased, trimmed phrase per file. [NLP10]"""
    return (
        rows.filter(F.col("error").isNull())
        .select(by, "seg_no", F.posexplode_outer("phrases").alias("pos", "raw"))
        .select(by, strip(F.lower("raw")).alias("text"), first_seen("seg_no", "pos").alias("seen"))
        .filter(F.col("text") != "")
        .groupBy(by, "text")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("seen").alias("seen"))
    )


def top_key_phrases(rows: DataFrame, by: str = "source_key", k: int = TOP_PHRASES) -> DataFrame:
    """The ``k`` most frequent phrases of each file, with their rank. [NLP10]"""
    order = [F.desc("cnt"), F.asc("seen"), F.asc("text")]
    return first_k(phrase_totals(rows, by), by, order, k, "rank")


def aggregate_key_phrases(rows: DataFrame, by: str = "source_key", k: int = TOP_PHRASES) -> DataFrame:
    top = top_key_phrases(rows, by, k)
    return top.groupBy(by).agg(_ordered(["text", "cnt"], F.col("rank")).alias("key_phrases"))


def annotate(
    segments: DataFrame, sentiment_scorer=None, entity_extractor=None, phrase_extractor=None,
    default_language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """All annotations of a segment side by side; ``*_error`` marks failed ones."""
    rows = segments.withColumn("_tokens", tokens_of(F.col("segment")))
    tokens = F.col("_tokens")
    rows = rows.withColumn("language", language_of(F.col("segment"), default=default_language, tokens=tokens))
    for step, plug_in, name, shared in (
        (annotate_sentiment, sentiment_scorer, "sentiment", {"tokens": tokens}),
        (annotate_entities, entity_extractor, "entity", {}),
        (annotate_key_phrases, phrase_extractor, "phrase", {"tokens": tokens}),
    ):
        rows = step(rows, plug_in, **({} if plug_in else shared)).withColumnRenamed("error", f"{name}_error")
    if phrase_extractor:
        rows = rows.withColumn("phrases", F.transform("phrases", lambda p: strip(F.lower(p))))
    return rows.drop("_tokens")


def _fact(kind: str, name: Column, text: Column, place: Column, scores: Column | None = None) -> Column:
    no_scores = F.lit(None).cast(SCORES_TYPE)
    return F.struct(
        F.lit(kind).alias("kind"),
        name.cast("string").alias("name"),
        text.cast("string").alias("text"),
        place.cast("bigint").alias("place"),
        (no_scores if scores is None else scores).alias("scores"),
    )


def _annotation_facts() -> Column:
    """The annotations of a segment as facts ``kind, name, text, place``, with scores for sentiment."""
    none, start = F.lit(None), F.lit(0)
    entities = F.when(F.col("entity_error").isNull(), F.col("entities"))
    phrases = F.when(F.col("phrase_error").isNull(), F.col("phrases"))
    single = F.array_compact(
        F.array(
            _fact("document", none, none, start),
            _fact("language", F.col("language"), none, start),
            F.when(F.col("sentiment_error").isNull(), _fact("label", F.col("label"), none, start, F.col("scores"))),
        )
    )
    all_facts = [
        single,
        F.transform(entities, lambda e, i: _fact("type", e["type"], none, i)),
        F.transform(entities, lambda e, i: _fact("entity", e["type"], e["text"], i)),
        F.transform(phrases, lambda p, i: _fact("phrase", none, p, i)),
    ]
    nothing = F.slice(single, 1, 0)
    return F.concat(*[F.coalesce(f, nothing) for f in all_facts])


def _row_facts() -> Column:
    """The verdict and the issues of a validated row as facts."""
    none, start = F.lit(None), F.lit(0)
    verdict = F.array(_fact("row", F.when(F.col("is_valid"), "valid").otherwise("invalid"), none, start))
    return F.concat(verdict, F.transform("issues", lambda i: _fact("issue", i, none, start)))


def _count(rows: DataFrame, facts: Column, by: str) -> DataFrame:
    # The outer form keeps the optimizer from testing the array's size first,
    # which would build it twice; it is never empty here.
    rows = rows.select(by, "seg_no", F.explode_outer(facts).alias("_f"))
    rows = rows.select(by, "seg_no", "_f.kind", "_f.name", "_f.text", "_f.place", "_f.scores")
    rows = rows.filter("kind <> 'phrase' or text <> ''").withColumn("seen", first_seen("seg_no", "place"))
    return rows.groupBy(by, "kind", "name", "text").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("seen").alias("seen"), *_sparse_score_sums("scores")
    )


def nlp_counts(annotated: DataFrame, by: str = "source_key") -> DataFrame:
    """``by, kind, name, text, cnt, seen`` and score sums: all that the results of a file need, and mergeable."""
    return _count(annotated, _annotation_facts(), by)


def review_counts(rows: DataFrame, by: str = "source_key", text: str = "review_content", order: str = "row_no") -> DataFrame:
    """Counts of validation and annotations of review rows in one pass over the texts.

    Each row is checked, cleaned and annotated once; blank rows are only checked.
    """
    checked = validate(deal_rows(rows.select(by, order, text), by, order), text)
    filled = F.get(one_if_filled(normalize_text(F.col(text))), 0)
    parts = checked.select(by, F.col(order).cast("bigint").alias("seg_no"), "issues", "is_valid", filled.alias("segment"))
    annotated = annotate(parts)
    facts = F.when(F.col("segment").isNull(), _row_facts()).otherwise(F.concat(_row_facts(), _annotation_facts()))
    return _count(annotated, facts, by)


def merge_counts(parts: DataFrame, by: str = "source_key") -> DataFrame:
    """Counts of the same files from several loads as one."""
    return parts.groupBy(by, "kind", "name", "text").agg(
        F.sum("cnt").alias("cnt"), F.min("seen").alias("seen"), *[F.sum(s).cast("decimal(28,12)").alias(s) for s in SCORES]
    )


def nlp_results(
    files: DataFrame,
    segments: DataFrame,
    by: str = "source_key",
    default_language: str = DEFAULT_LANGUAGE,
    sentiment_scorer=None,
    entity_extractor=None,
    phrase_extractor=None,
    top_entities: int = TOP_ENTITIES,
    top_phrases: int = TOP_PHRASES,
) -> DataFrame:
    """One nested ``nlp`` result per file in ``files``. [NLP11, NLP12]

    One read of the segments: each is annotated once, its annotations become
    rows, one grouped count serves all results, and only the short top lists of
    a file are brought together. A file without segments was blank: it is
    marked skipped and has empty results. ``total_documents`` counts the
    segments sent, failed ones included. ``top_entities`` per type and
    ``top_phrases`` per file are listed.
    """
    annotated = annotate(segments, sentiment_scorer, entity_extractor, phrase_extractor, default_language)
    counted = nlp_counts(annotated, by)
    return file_results(files, counted, by, default_language, top_entities, top_phrases).select(by, "nlp")


def file_results(
    files: DataFrame,
    counted: DataFrame,
    by: str = "source_key",
    default_language: str = DEFAULT_LANGUAGE,
    top_entities: int = TOP_ENTITIES,
    top_phrases: int = TOP_PHRASES,
) -> DataFrame:
    """``nlp``, ``validation`` and ``rows`` of each file in ``files`` from its counts."""
    # Labels, types and languages are groups of one row; entity texts of a type
    # and phrases of a file are the groups that get cut.
    order = [F.desc("cnt"), F.asc("seen"), F.asc("text")]
    top = first_k(counted, [by, "kind", "name"], order, max(top_entities, top_phrases), "rank")

    def gather(kind: str, *cols: str, keep: Column | None = None) -> Column:
        """Rows of one kind as structs, sorted by their first column."""
        wanted = F.col("kind") == kind
        wanted = wanted if keep is None else wanted & keep
        return F.array_sort(F.collect_list(F.when(wanted, F.struct(*cols))))

    def only(kind: str, value: Column | str) -> Column:
        return F.when(F.col("kind") == kind, F.col(value) if isinstance(value, str) else value)

    analysed = F.sum(only("label", "cnt"))
    gathered = top.groupBy(by).agg(
        F.sum(only("document", "cnt")).alias("documents"),
        F.min(only("language", F.struct("seen", "name")))["name"].alias("language"),
        gather("label", "seen", "name", "cnt").alias("labels"),
        F.max(only("label", F.struct("cnt", -F.col("seen"), "name")))["name"].alias("dominant"),
        F.coalesce(analysed, F.lit(0)).alias("analysed"),
        *[F.round(F.sum(only("label", s)).cast("double") / analysed, 4).alias(s) for s in SCORES],
        gather("type", "seen", "name", "cnt").alias("types"),
        gather("entity", "rank", "name", "text", "cnt", keep=F.col("rank") <= top_entities).alias("entities"),
        gather("phrase", "rank", "text", "cnt", keep=F.col("rank") <= top_phrases).alias("phrases"),
        F.coalesce(F.sum(only("row", "cnt")), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when((F.col("kind") == "row") & (F.col("name") == "valid"), F.col("cnt"))), F.lit(0)).alias("valid"),
        F.map_from_entries(F.collect_list(only("issue", F.struct("name", "cnt")))).alias("issues"),
    )

    def counts(rows: str) -> Column:
        return F.map_from_entries(F.transform(rows, lambda r: F.struct(r["name"], r["cnt"])))

    def items(rows: Column) -> Column:
        return F.transform(rows, lambda r: F.struct(r["text"].alias("text"), r["cnt"].alias("cnt")))

    averages = [x for s in SCORES for x in (F.lit(s), F.coalesce(F.col(s), F.lit(0.0)))]
    top_by_type = F.transform(
        "types",
        lambda t: F.struct(t["name"], items(F.filter("entities", lambda e: e["name"].eqNullSafe(t["name"])))),
    )
    results = gathered.select(
        by,
        "rows",
        "valid",
        "issues",
        F.when(F.col("documents").isNotNull(), F.struct(
            F.coalesce("language", F.lit(default_language)).alias("language"),
            F.col("documents").alias("total_documents"),
            F.lit(False).alias("skipped"),
            F.struct(
                counts("labels").alias("counts"),
                F.create_map(*averages).alias("average_scores"),
                F.coalesce("dominant", F.lit("NEUTRAL")).alias("dominant_sentiment"),
                F.col("analysed").alias("total_analyzed"),
            ).alias("sentiment"),
            F.struct(
                counts("types").alias("counts_by_type"),
                F.map_from_entries(top_by_type).alias("top_entities_by_type"),
            ).alias("entities"),
            items(F.col("phrases")).alias("key_phrases"),
        ))
        .cast(NLP_TYPE)
        .alias("_nlp"),
    )
    blank = F.struct(
        F.lit(default_language),
        F.lit(0).cast("bigint"),
        F.lit(True),
        F.lit(None).cast(SENTIMENT_TYPE),
        F.lit(None).cast(ENTITIES_TYPE),
        F.expr(f"cast(array() as {ITEMS_TYPE})"),
    ).cast(NLP_TYPE)
    known = files.select(by).join(results, by, "left")
    total, valid = F.coalesce("rows", F.lit(0)).cast("bigint"), F.coalesce("valid", F.lit(0)).cast("bigint")
    return known.select(
        by, F.coalesce("_nlp", blank).alias("nlp"), summary_of(total, valid, F.col("issues")).alias("validation"), total.alias("rows")
    )
