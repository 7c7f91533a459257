"""Registered queries: segments, annotations and their aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.functions import prompts
from feedmill.functions import text as tx
from feedmill.operators import aggregation, annotation, normalization, segments, trained
from feedmill.operators.ordering import deal_rows
from feedmill.plans.registry import query
from feedmill.plans.table_queries import SAMPLED, normalized_sample
from feedmill.plans.views import (
    NL,
    REVIEWS_SQL,
    count_sql,
    listed,
    normalize_sql,
    quote,
    reviews,
    strip_sql,
    table,
    words_sql,
)

LANGS = list(annotation.LANGUAGE_PROFILES)


def documents(spark, sf_dir):
    """Every document as one segment, numbered inside its source."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_key"), F.col("doc_id").alias("seg_no"), F.col("text").alias("segment"), "lang"
    )


@query(
    "segments",
    f"""WITH parts AS (SELECT doc_id, list_filter(list_transform(
    string_split(replace(text, {NL}, {NL} || '---' || {NL}), '---'), lambda p: {strip_sql('p')}), lambda p: p <> '') AS l
  FROM documents)
SELECT doc_id, unnest(range(len(l))) AS seg_no, unnest(l) AS segment FROM parts""",
)
def segment_lines(spark, sf_dir):
    marked = table(spark, sf_dir, "documents").select(
        "doc_id", F.replace("text", F.lit("\n"), F.lit("\n---\n")).alias("normalized_text")
    )
    return segments.segment(marked)


@query(
    "byte_truncate",
    """WITH h AS (SELECT doc_id, text, hex(encode(text)) AS x FROM documents),
k AS (SELECT *, left(x, 10000) AS c FROM h)
SELECT doc_id, CASE WHEN length(x) <= 10000 THEN text ELSE decode(unhex(left(c, 10000 - 2 * CASE
    WHEN right(c, 2) >= 'C0' THEN 1
    WHEN right(c, 2) >= '80' AND substr(c, 9997, 2) >= 'E0' THEN 2
    WHEN right(c, 2) >= '80' AND substr(c, 9997, 2) >= '80' AND substr(c, 9995, 2) >= 'F0' THEN 3
    ELSE 0 END))) END AS text FROM k""",
)
def byte_truncate(spark, sf_dir):
    """The byte cut of size-limited scorers."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.truncate_bytes(F.col("text")).alias("text"))


@query(
    "batches",
    f"""WITH {REVIEWS_SQL} SELECT source_key, row_no,
  (row_number() OVER (PARTITION BY source_key ORDER BY row_no) - 1) // 25 AS batch_id FROM reviews""",
)
def batches(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("source_key", "row_no")
    return segments.with_batch_id(rows, "source_key", "row_no", dense=False)


def _language_cte(name: str, source: str, key: str, expr: str) -> str:
    counts = ", ".join(f"{count_sql('toks', p)} AS n_{n}" for n, p in annotation.LANGUAGE_PROFILES.items())
    best = "greatest(" + ", ".join(f"n_{n}" for n in LANGS) + ")"
    cases = " ".join(f"WHEN n_{n} = {best} THEN {quote(n)}" for n in LANGS)
    return (
        f"{name} AS (SELECT {key}, CASE WHEN {best} = 0 THEN 'en' {cases} END AS language FROM "
        f"(SELECT {key}, {counts} FROM (SELECT {key}, {words_sql(expr)} AS toks FROM {source})))"
    )


@query(
    "language_by_document",
    f"WITH {_language_cte('l', 'documents', 'doc_id', 'text')} SELECT doc_id, language FROM l",
)
def language_by_document(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", annotation.language_of(F.col("text")).alias("language"))


@query(
    "language_confusion",
    f"WITH {_language_cte('l', 'documents', 'doc_id, lang', 'text')} "
    "SELECT lang, language, count(*) AS n FROM l GROUP BY 1, 2",
)
def language_confusion(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", annotation.language_of(F.col("text")).alias("language"))
    return rows.groupBy("lang", "language").agg(F.count(F.lit(1)).alias("n"))


@query(
    "language_by_source",
    f"""WITH {_language_cte('l', 'documents', 'doc_id, source', 'text')}
SELECT source AS source_key, arg_min(language, doc_id) AS language FROM l GROUP BY 1""",
)
def language_by_source(spark, sf_dir):
    return annotation.detect_language(documents(spark, sf_dir))


def sentiment_cte(source: str, keys: str, expr: str) -> str:
    """CTE ``s``: label and scores per row of ``source``."""
    return f"""hits AS (SELECT {keys}, {count_sql('toks', annotation.POSITIVE_WORDS)} AS p,
    {count_sql('toks', annotation.NEGATIVE_WORDS)} AS n FROM (SELECT {keys}, {words_sql(expr)} AS toks FROM {source})),
s AS (SELECT {keys}, CASE WHEN p > 0 AND n > 0 THEN 'MIXED' WHEN p > 0 THEN 'POSITIVE' WHEN n > 0 THEN 'NEGATIVE'
      ELSE 'NEUTRAL' END AS label,
    (p - least(p, n)) / (p + n + 1)::DOUBLE AS positive, (n - least(p, n)) / (p + n + 1)::DOUBLE AS negative,
    1 / (p + n + 1)::DOUBLE AS neutral, 2 * least(p, n) / (p + n + 1)::DOUBLE AS mixed FROM hits)"""


@query(
    "sentiment_rows",
    f"WITH {sentiment_cte('documents', 'source, doc_id', 'text')} SELECT source AS source_key, doc_id AS seg_no, label, "
    "round(positive, 6) AS positive, round(negative, 6) AS negative, round(neutral, 6) AS neutral, "
    "round(mixed, 6) AS mixed FROM s",
)
def sentiment_rows(spark, sf_dir):
    rows = annotation.annotate_sentiment(documents(spark, sf_dir))
    return rows.select(
        "source_key", "seg_no", "label", *[F.round(f"scores.{s}", 6).alias(s.lower()) for s in aggregation.SCORES]
    )


_LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED")
_SENTIMENT_SUMMARY = f"""per_label AS (SELECT source_key, label, count(*) AS cnt, min(seg_no) AS seen FROM s GROUP BY 1, 2),
dominant AS (SELECT source_key, arg_max(label, (cnt, -seen)) AS dominant_sentiment FROM per_label GROUP BY 1),
summary AS (SELECT source_key, count(*) AS total_analyzed,
    {', '.join(f"count(*) FILTER (WHERE label = '{x}') AS n_{x.lower()}" for x in _LABELS)},
    {', '.join(f'round(sum({x}::DECIMAL(18,12))::DOUBLE / count(*), 4) AS avg_{x}' for x in ('positive', 'negative', 'neutral', 'mixed'))}
  FROM s GROUP BY 1)"""


@query(
    "sentiment_summary",
    f"WITH d AS (SELECT source AS source_key, doc_id AS seg_no, text FROM documents), "
    f"{sentiment_cte('d', 'source_key, seg_no', 'text')}, {_SENTIMENT_SUMMARY} "
    "SELECT * FROM summary JOIN dominant USING (source_key)",
)
def sentiment_summary(spark, sf_dir):
    rows = aggregation.aggregate_sentiment(annotation.annotate_sentiment(documents(spark, sf_dir)))
    s = F.col("sentiment")
    return rows.select(
        "source_key",
        s["total_analyzed"].alias("total_analyzed"),
        s["dominant_sentiment"].alias("dominant_sentiment"),
        *[F.coalesce(F.try_element_at(s["counts"], F.lit(x)), F.lit(0)).alias(f"n_{x.lower()}") for x in _LABELS],
        *[s["average_scores"][x].alias(f"avg_{x.lower()}") for x in aggregation.SCORES],
    )


def entity_cte(source: str, expr: str) -> str:
    """CTE ``ents``: count and first place per file, type and text of ``source(source_key, seg_no)``."""
    lists = ", ".join(
        f"list_transform(regexp_extract_all({expr}, {quote(p)}), lambda t: {{'type': {quote(n)}, 'text': t}})"
        for n, p in annotation.ENTITY_PATTERNS.items()
    )
    return f"""found AS (SELECT source_key, seg_no, flatten([{lists}]) AS l FROM {source}),
flat AS (SELECT source_key, seg_no, unnest(l) AS e, unnest(range(len(l))) AS pos FROM found),
ents AS (SELECT source_key, e.type AS type, e.text AS text, count(*) AS cnt,
    min(seg_no::HUGEINT * 16777216 + pos) AS seen FROM flat GROUP BY ALL)"""


_DOCS = "d AS (SELECT source AS source_key, doc_id AS seg_no, text FROM documents)"


@query(
    "entity_counts",
    f"WITH {_DOCS}, {entity_cte('d', 'text')} "
    "SELECT source_key, type, sum(cnt)::BIGINT AS total, count(*) AS texts FROM ents GROUP BY 1, 2",
)
def entity_counts(spark, sf_dir):
    totals = aggregation.entity_totals(annotation.annotate_entities(documents(spark, sf_dir)))
    return totals.groupBy("source_key", "type").agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("texts"))


_TOP_ENTITIES = """tops AS (SELECT source_key, type, text, cnt, seen,
    row_number() OVER (PARTITION BY source_key, type ORDER BY cnt DESC, seen, text) AS rank FROM ents)"""


@query(
    "top_entities",
    f"WITH {_DOCS}, {entity_cte('d', 'text')}, {_TOP_ENTITIES} "
    "SELECT source_key, type, rank, text, cnt FROM tops WHERE rank <= 10",
)
def top_entities(spark, sf_dir):
    rows = annotation.annotate_entities(documents(spark, sf_dir))
    return aggregation.top_entities(rows).select("source_key", "type", "rank", "text", "cnt")


def phrase_cte(source: str, expr: str) -> str:
    """CTE ``phr``: count and first place per file and phrase."""
    marked = f"regexp_replace(lower({expr}), '[^\\p{{L}}\\p{{N}} ]+', ' | ', 'g')"
    tokens = (
        f"list_transform(regexp_split_to_array({marked}, ' +'), "
        f"lambda w: CASE WHEN list_contains({listed(annotation.STOP_WORDS)}, w) THEN '|' ELSE w END)"
    )
    parts = f"regexp_split_to_array(trim(array_to_string({tokens}, ' '), ' '), '[ |]*\\|[ |]*')"
    return f"""cand AS (SELECT source_key, seg_no, list_filter({parts}, lambda p: p <> '') AS l FROM {source}),
pflat AS (SELECT source_key, seg_no, unnest(l) AS text, unnest(range(len(l))) AS pos FROM cand),
phr AS (SELECT source_key, text, count(*) AS cnt, min(seg_no::HUGEINT * 16777216 + pos) AS seen FROM pflat GROUP BY ALL),
ptops AS (SELECT source_key, text, cnt,
    row_number() OVER (PARTITION BY source_key ORDER BY cnt DESC, seen, text) AS rank FROM phr)"""


@query(
    "top_key_phrases",
    f"WITH {_DOCS}, {phrase_cte('d', 'text')} SELECT source_key, rank, text, cnt FROM ptops WHERE rank <= 30",
)
def top_key_phrases(spark, sf_dir):
    rows = annotation.annotate_key_phrases(documents(spark, sf_dir))
    return aggregation.top_key_phrases(rows).select("source_key", "rank", "text", "cnt")


# --- nested results per file ------------------------------------------------

NLP_SQL = f"""norm AS (SELECT source_key, row_no AS seg_no, {normalize_sql('review_content')} AS segment FROM reviews),
segs AS (SELECT * FROM norm WHERE segment <> ''),
sent AS (SELECT source_key, count(*) AS total_documents FROM segs GROUP BY 1),
{_language_cte('langs', 'segs', 'source_key, seg_no', 'segment')},
lang AS (SELECT source_key, arg_min(language, seg_no) AS language FROM langs GROUP BY 1),
{sentiment_cte('segs', 'source_key, seg_no', 'segment')}, {_SENTIMENT_SUMMARY},
{entity_cte('segs', 'segment')}, {_TOP_ENTITIES},
{phrase_cte('segs', 'segment')},
files AS (SELECT DISTINCT source_key FROM reviews),
etot AS (SELECT source_key, sum(cnt)::BIGINT AS entity_count, count(DISTINCT type) AS entity_types FROM ents GROUP BY 1),
ptot AS (SELECT source_key, count(*) AS phrase_count, max(CASE WHEN rank = 1 THEN text END) AS top_phrase,
    sum(cnt)::BIGINT AS phrase_hits FROM ptops WHERE rank <= 30 GROUP BY 1),
nlp AS (SELECT source_key, coalesce(language, 'en') AS language, coalesce(total_documents, 0) AS total_documents,
    total_documents IS NULL AS skipped, dominant_sentiment, total_analyzed, avg_neutral,
    coalesce(entity_count, 0) AS entity_count, coalesce(entity_types, 0) AS entity_types,
    coalesce(phrase_count, 0) AS phrase_count, top_phrase, phrase_hits
  FROM files LEFT JOIN sent USING (source_key) LEFT JOIN lang USING (source_key) LEFT JOIN summary USING (source_key)
  LEFT JOIN dominant USING (source_key) LEFT JOIN etot USING (source_key) LEFT JOIN ptot USING (source_key))"""


def review_nlp(spark, sf_dir):
    """NLP results of all rows of every review file."""
    rows = reviews(spark, sf_dir).select("source_key", "row_no", "review_content")
    dealt = deal_rows(rows, "source_key", "row_no")
    normal = normalization.normalize_column(dealt).drop("review_content")
    parts = segments.segments_from_rows(normal)
    return aggregation.nlp_results(rows.select("source_key").distinct(), parts)


def flat_nlp(results):
    n = F.col("nlp")
    top = n["entities"]["counts_by_type"]
    return results.select(
        "source_key",
        n["language"].alias("language"),
        n["total_documents"].alias("total_documents"),
        n["skipped"].alias("skipped"),
        n["sentiment"]["dominant_sentiment"].alias("dominant_sentiment"),
        n["sentiment"]["total_analyzed"].alias("total_analyzed"),
        n["sentiment"]["average_scores"]["Neutral"].alias("avg_neutral"),
        F.aggregate(F.map_values(top), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("entity_count"),
        F.size(top).alias("entity_types"),
        F.size(n["key_phrases"]).alias("phrase_count"),
        F.try_element_at(n["key_phrases"], F.lit(1))["text"].alias("top_phrase"),
        F.aggregate(n["key_phrases"], F.lit(0).cast("bigint"), lambda a, p: a + p["cnt"]).alias("phrase_hits"),
    )


@query("nlp_results", f"WITH {REVIEWS_SQL}, {NLP_SQL} SELECT * FROM nlp")
def nlp_results(spark, sf_dir):
    return flat_nlp(review_nlp(spark, sf_dir))


@query(
    "nlp_blank_files",
    f"""WITH d AS (SELECT 'files/' || source || '/' || (doc_id % 5) || '.csv' AS source_key,
    CASE WHEN doc_id % 5 > 0 THEN text WHEN doc_id % 2 = 0 THEN '  ' END AS review_content FROM documents),
n AS (SELECT source_key, count(*) FILTER (WHERE {normalize_sql('review_content')} <> '') AS filled FROM d GROUP BY 1)
SELECT source_key, filled = 0 AS skipped, filled AS total_documents FROM n""",
)
def nlp_blank_files(spark, sf_dir):
    """Files that hold nothing but blank rows are skipped, not failed."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        "'files/' || source || '/' || (doc_id % 5) || '.csv' as source_key",
        "doc_id as row_no",
        "case when doc_id % 5 > 0 then text when doc_id % 2 = 0 then '  ' end as review_content",
    )
    dealt = deal_rows(rows, "source_key", "row_no")
    parts = segments.segments_from_rows(normalization.normalize_column(dealt).drop("review_content"))
    found = aggregation.nlp_results(rows.select("source_key").distinct(), parts)
    return found.select("source_key", "nlp.skipped", "nlp.total_documents")


# --- prompts ----------------------------------------------------------------

_FRAME = prompts.REVIEW_FRAME.split("%s")
_PROMPT_PARTS = (
    "'key=' || f.source_key",
    "coalesce(dominant_sentiment, 'UNKNOWN')",
    "coalesce(label_line, '')",
    "coalesce(entity_lines, '  (no entities detected)')",
    "coalesce(phrase_line, '(none)')",
    "coalesce(normalized_text, '')",
)
_PROMPT = quote(_FRAME[0]) + "".join(f" || {v} || {quote(p)}" for v, p in zip(_PROMPT_PARTS, _FRAME[1:]))

PROMPT_SQL = f"""label_lines AS (SELECT source_key, string_agg(label || ': ' || cnt, ', ' ORDER BY seen) AS label_line
  FROM per_label GROUP BY 1),
type_lines AS (SELECT source_key, type, min(seen) AS type_seen,
    string_agg('"' || text || '"', ', ' ORDER BY rank) FILTER (WHERE rank <= 10) AS line FROM tops GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY type_seen) AS type_no FROM type_lines),
entity_text AS (SELECT source_key, string_agg('  - ' || type || ': ' || line, {NL} ORDER BY type_seen) AS entity_lines
  FROM numbered GROUP BY 1),
phrase_text AS (SELECT source_key, string_agg('"' || text || '"', ', ' ORDER BY rank) AS phrase_line
  FROM ptops WHERE rank <= 30 GROUP BY 1)
SELECT f.source_key, {_PROMPT} AS prompt FROM files f LEFT JOIN dominant USING (source_key)
  LEFT JOIN label_lines USING (source_key) LEFT JOIN entity_text USING (source_key)
  LEFT JOIN phrase_text USING (source_key) LEFT JOIN samples USING (source_key)"""


@query("review_prompts", f"WITH {REVIEWS_SQL}, {NLP_SQL}, {SAMPLED}, {PROMPT_SQL}")
def review_prompts(spark, sf_dir):
    state = review_nlp(spark, sf_dir).join(normalized_sample(spark, sf_dir), "source_key", "left")
    prompt = prompts.review_prompt(F.col("source_key"), F.col("nlp"), F.col("normalized_text"))
    return state.select("source_key", prompt.alias("prompt"))



_HALVES = "doc_id % 2"


@query(
    "language_confusion",
    r"""WITH d AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS t FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, lang, z[1] || z[2] || z[3] AS run
  FROM (SELECT doc_id, lang, unnest(list_zip(s, s[2:], s[3:])) AS z FROM (SELECT doc_id, lang, string_split(t, '') AS s FROM d))
  WHERE z[3] IS NOT NULL),
n AS (SELECT doc_id, lang, run, count(*) AS n FROM r GROUP BY 1, 2, 3),
counts AS (SELECT lang, run, sum(n) AS n FROM n WHERE doc_id % 2 = 0 AND lang IS NOT NULL GROUP BY 1, 2),
totals AS (SELECT lang, -ln(sum(n)::DOUBLE + 2001) AS floor FROM counts GROUP BY 1),
profile AS (SELECT lang, run, ln(n + 1.0::DOUBLE) AS gain FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, run) <= 2000),
size AS (SELECT doc_id, sum(n) AS size FROM n WHERE doc_id % 2 = 1 GROUP BY 1),
gains AS (SELECT n.doc_id, p.lang, sum(n.n * gain) AS gain FROM n JOIN profile p USING (run) WHERE n.doc_id % 2 = 1 GROUP BY 1, 2),
best AS (SELECT doc_id, g.lang AS language FROM gains g JOIN size USING (doc_id) JOIN totals t ON t.lang = g.lang
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(gain + size * floor, 6) DESC, g.lang) = 1)
SELECT lang, coalesce(language, 'en') AS language, count(*) AS n FROM documents LEFT JOIN best USING (doc_id)
WHERE doc_id % 2 = 1 GROUP BY 1, 2""",
)
def language_confusion(spark, sf_dir):
    """Profiles of one half of the documents tell the language of the other half."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = trained.language_profiles(docs.filter(f"{_HALVES} = 0"))
    held = docs.filter(f"{_HALVES} = 1")
    found = trained.detect_language(held, profiles, "doc_id")
    return held.select("doc_id", "lang").join(found, "doc_id").groupBy("lang", "language").agg(F.count(F.lit(1)).alias("n"))


@query("sentiment_trained")
def sentiment_trained(spark, sf_dir):
    """Sentiment of the documents of one half by a model of the other half's labels. No SQL: the fit is iterative."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("positive"))
    model = trained.train_sentiment(rows.filter(f"{_HALVES} = 0").join(labels, "doc_id"))
    done = model.annotate(rows.filter(f"{_HALVES} = 1"), "text")
    return done.select("doc_id", "label", F.round("scores.Positive", 4).alias("positive"), F.round("scores.Negative", 4).alias("negative"))
