"""Registered queries: validation, normalisation, ETL, data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.functions import text as tx
from feedmill.operators import etl, normalization, rule_history, rules, validation
from feedmill.operators.ordering import first_rows
from feedmill.plans.registry import query
from feedmill.plans.views import (
    NL,
    REVIEWS_SQL,
    normalize_sql,
    quote,
    reviews,
    strip_sql,
    table,
)
from feedmill.session import shared_dir


def _checked_sql(source: str, col: str) -> str:
    """CTEs ``t, c, w, v``: the rows of ``source`` with ``issues``."""
    cleaned = f"regexp_replace(regexp_replace(tx, {quote(tx.HTML_PATTERN)}, ' ', 'g'), {quote(tx.URL_PATTERN)}, ' ', 'g')"
    return f"""t AS (SELECT *, {strip_sql(col)} AS tx FROM {source}),
c AS (SELECT *, {strip_sql(cleaned)} AS cl FROM t),
w AS (SELECT *, list_filter(regexp_split_to_array(lower(cl), '[{tx.SPACE_CLASS}]+'), lambda x: x <> '') AS toks FROM c),
v AS (SELECT *, CASE WHEN {col} IS NULL OR tx = '' THEN ['empty_review'] ELSE list_filter([
    CASE WHEN length(tx) < 10 THEN 'too_short' END,
    CASE WHEN length(tx) > 10000 THEN 'too_long' END,
    CASE WHEN cl = '' THEN 'content_is_urls_or_html_only' END,
    CASE WHEN len(toks) > 0 AND len(list_distinct(toks)) / len(toks)::DOUBLE < 0.20 THEN 'low_vocabulary_diversity' END
  ], lambda x: x IS NOT NULL) END AS issues FROM w)"""


CHECKED = f"WITH {REVIEWS_SQL},\n{_checked_sql('reviews', 'review_content')}"
_SUMMARY = """count(*) AS total_rows, count(*) FILTER (WHERE len(issues) = 0) AS valid_rows,
  count(*) FILTER (WHERE len(issues) > 0) AS invalid_rows,
  round(count(*) FILTER (WHERE len(issues) = 0) / count(*)::DOUBLE * 100, 2) AS quality_score"""
_ISSUE_COLUMNS = ", ".join(
    f"count(*) FILTER (WHERE list_contains(issues, '{n}')) AS {n}" for n in validation.ISSUES
)


def _flat_issues(df):
    """Issue map as one column per issue name."""
    issues = F.col("validation_issues")
    flat = {n: F.coalesce(F.try_element_at(issues, F.lit(n)), F.lit(0)) for n in validation.ISSUES}
    return df.withColumns(flat).drop("validation_issues")


@query(
    "validate_rows",
    CHECKED + "\nSELECT row_no, source_key, array_to_string(issues, ',') AS issues, len(issues) = 0 AS is_valid FROM v",
)
def validate_rows(spark, sf_dir):
    checked = validation.validate(reviews(spark, sf_dir).select("row_no", "source_key", "review_content"), "review_content")
    return checked.select("row_no", "source_key", F.array_join("issues", ",").alias("issues"), "is_valid")


@query(
    "validate_pages",
    f"WITH {_checked_sql('pages', 'html')}\n"
    "SELECT page_id, array_to_string(issues, ',') AS issues, length(cl) AS content_chars, len(toks) AS words FROM v",
)
def validate_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    checked = validation.validate(pages, "html")
    cleaned = tx.strip(tx.strip_urls(tx.strip_html(tx.strip(F.col("html")))))
    staged = checked.withColumn("_clean", cleaned)
    return staged.select(
        "page_id",
        F.array_join("issues", ",").alias("issues"),
        F.length("_clean").alias("content_chars"),
        F.size(tx.words(F.lower("_clean"))).alias("words"),
    )


@query(
    "issue_histogram",
    CHECKED + "\nSELECT issue, count(*) AS cnt FROM (SELECT unnest(issues) AS issue FROM v) GROUP BY issue",
)
def issue_histogram(spark, sf_dir):
    checked = validation.validate(reviews(spark, sf_dir), "review_content")
    return validation.issue_histogram(checked)


@query("validation_summary", CHECKED + f"\nSELECT {_SUMMARY}, {_ISSUE_COLUMNS} FROM v")
def validation_summary(spark, sf_dir):
    checked = validation.validate(reviews(spark, sf_dir), "review_content")
    return _flat_issues(validation.validation_summary(checked, by=()))


@query(
    "validation_by_source", CHECKED + f"\nSELECT source_key, {_SUMMARY}, {_ISSUE_COLUMNS} FROM v GROUP BY source_key"
)
def validation_by_source(spark, sf_dir):
    checked = validation.validate(reviews(spark, sf_dir), "review_content")
    return _flat_issues(validation.validation_summary(checked))


@query(
    "validation_with_files",
    CHECKED
    + f""",
files AS (SELECT DISTINCT source_key FROM reviews UNION SELECT 'text-reviews/lang-' || lang || '.csv' FROM documents),
s AS (SELECT source_key, {_SUMMARY} FROM v GROUP BY source_key)
SELECT f.source_key, coalesce(total_rows, 0) AS total_rows, coalesce(valid_rows, 0) AS valid_rows,
  coalesce(invalid_rows, 0) AS invalid_rows, coalesce(quality_score, 0.0::DOUBLE) AS quality_score,
  CASE WHEN total_rows IS NULL THEN 1 ELSE 0 END AS no_content_found
FROM files f LEFT JOIN s USING (source_key)""",
)
def validation_with_files(spark, sf_dir):
    """Files without rows: the language files listed here have none."""
    rows = reviews(spark, sf_dir)
    empty = table(spark, sf_dir, "documents").select(F.concat(F.lit("text-reviews/lang-"), "lang", F.lit(".csv")).alias("source_key"))
    files = rows.select("source_key").union(empty).distinct()
    summary = validation.validation_summary(validation.validate(rows, "review_content"), files=files)
    none = F.coalesce(F.try_element_at("validation_issues", F.lit(validation.NO_CONTENT)), F.lit(0))
    return summary.withColumn("no_content_found", none).drop("validation_issues")


@query("normalize_pages", f"SELECT page_id, {normalize_sql('html')} AS text FROM pages")
def normalize_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.normalize_text(F.col("html")).alias("text"))


@query("normalize_documents", f"SELECT doc_id, {normalize_sql('text')} AS text FROM documents")
def normalize_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", tx.normalize_text(F.col("text")).alias("text"))


@query(
    "normalize_column",
    f"WITH {REVIEWS_SQL} SELECT row_no, source_key, review_id, "
    f"{normalize_sql('review_content')} AS review_content_normalized FROM reviews",
)
def normalize_column(spark, sf_dir):
    normal = normalization.normalize_column(reviews(spark, sf_dir))
    return normal.select("row_no", "source_key", "review_id", "review_content_normalized")


SAMPLED = f"""ranked AS (SELECT source_key, row_no, review_content,
    row_number() OVER (PARTITION BY source_key ORDER BY row_no) AS rn FROM reviews),
first_rows AS (SELECT source_key, row_no, {normalize_sql('review_content')} AS norm FROM ranked WHERE rn <= 50),
samples AS (SELECT source_key, coalesce(string_agg(norm, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY row_no)
    FILTER (WHERE norm <> ''), '') AS normalized_text FROM first_rows GROUP BY source_key)"""


@query("normalized_sample", f"WITH {REVIEWS_SQL}, {SAMPLED} SELECT source_key, normalized_text FROM samples")
def normalized_sample(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("source_key", "row_no", "review_content")
    first = first_rows(rows, "source_key", "row_no", 50)
    return normalization.sample_text(normalization.normalize_column(first))


@query(
    "pick_raw_text",
    """SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0
  THEN coalesce(nullif(CASE WHEN turn % 2 = 0 THEN text ELSE '' END, ''), nullif(role, ''), '')
  ELSE coalesce(nullif(CASE WHEN turn % 3 = 0 THEN '' ELSE role END, ''), nullif(text, ''), '') END AS raw_input
FROM conversations""",
)
def pick_raw_text(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    audio = F.col("conv_id") % 3 == 0
    staged = turns.select(
        "conv_id",
        "turn",
        F.when(audio, "audio").otherwise("other").alias("data_type"),
        F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise("").alias("transcript"),
        F.when(audio, F.col("role")).when(F.col("turn") % 3 == 0, "").otherwise(F.col("role")).alias("raw_text"),
        F.col("text").alias("extracted_text"),
    )
    return normalization.pick_raw_text(staged).select("conv_id", "turn", "raw_input")


CLEANED = f"""WITH {REVIEWS_SQL},
nums AS (SELECT *, TRY_CAST(regexp_replace(rating, '[^0-9.]', '', 'g') AS DOUBLE) AS r,
    TRY_CAST(replace(discount_percentage, '%', '') AS DOUBLE) AS dp,
    TRY_CAST(regexp_replace(actual_price, '[^0-9.]', '', 'g') AS DOUBLE) AS ap,
    TRY_CAST(replace(rating_count, ',', '') AS INTEGER) AS rc FROM reviews),
kept AS (SELECT * FROM nums WHERE review_content IS NOT NULL AND length(review_content) > 10
    AND product_id IS NOT NULL AND r IS NOT NULL AND r BETWEEN 1 AND 5),
ranked AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY source_key, row_no) AS rn FROM kept),
clean AS (SELECT review_id, row_no, product_id, r AS rating, dp AS discount_percentage, ap AS actual_price,
    rc AS rating_count, length(review_content) AS review_length,
    coalesce(length(img_link) > 10, false) AS has_image_url, split_part(category, '|', 1) AS top_category,
    CASE WHEN r >= 4 THEN 'POSITIVE' WHEN r <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment_proxy
  FROM ranked WHERE rn = 1)"""
CLEAN_COLUMNS = (
    "review_id", "row_no", "product_id", "rating", "discount_percentage", "actual_price", "rating_count",
    "review_length", "has_image_url", "top_category", "sentiment_proxy",
)
_BY_CATEGORY = """SELECT top_category, sentiment_proxy, count(*) AS n, round(avg(rating), 4) AS avg_rating,
  sum(rating_count)::BIGINT AS ratings, count(*) FILTER (WHERE has_image_url) AS with_image
FROM clean GROUP BY 1, 2"""


def by_category(clean):
    return clean.groupBy("top_category", "sentiment_proxy").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
        F.sum("rating_count").alias("ratings"),
        F.count_if("has_image_url").alias("with_image"),
    )


@query("etl_clean", CLEANED + f" SELECT {', '.join(CLEAN_COLUMNS)} FROM clean")
def etl_clean(spark, sf_dir):
    return etl.clean_reviews(reviews(spark, sf_dir)).select(*CLEAN_COLUMNS)


@query(
    "etl_counters",
    CLEANED + " SELECT (SELECT count(*) FROM reviews) AS loaded, (SELECT count(*) FROM kept) AS filtered, "
    "(SELECT count(*) FROM clean) AS deduped",
)
def etl_counters(spark, sf_dir):
    return etl.stage_counters(reviews(spark, sf_dir))


@query("etl_by_category", CLEANED + " " + _BY_CATEGORY)
def etl_by_category(spark, sf_dir):
    return by_category(etl.clean_reviews(reviews(spark, sf_dir)))


# --- data-quality rules -----------------------------------------------------

_METRIC_SQL = {
    "IsComplete": "count({c}) / count(*)::DOUBLE",
    "Completeness": "count({c}) / count(*)::DOUBLE",
    "RowCount": "count(*)::DOUBLE",
}


def _rule_sql(no: int, rule: rules.Rule, source: str, columns: list[str], by: str = "") -> str:
    """One rule as a SELECT over ``source``."""
    known = rule.column is None or rule.column in columns
    frm = source
    if not known:
        metric, test = "any_value(NULL::DOUBLE)", "false"
    elif isinstance(rule, rules.Uniqueness):
        group = f"{by}, {rule.column}" if by and by != rule.column else rule.column
        frm = f"(SELECT {group}, count(*) AS n FROM {source} GROUP BY {group})"
        metric = f"count(*) FILTER (WHERE n = 1 AND {rule.column} IS NOT NULL) / sum(n)::DOUBLE"
        test = "m = 1" if isinstance(rule, rules.IsUnique) else f"m > {rule.gt}"
    elif isinstance(rule, rules.ColumnValues):
        value = f"TRY_CAST({rule.column} AS DOUBLE)"
        metric = (
            f"count(*) FILTER (WHERE {rule.column} IS NOT NULL AND "
            f"NOT coalesce({value} BETWEEN {rule.low} AND {rule.high}, false))::DOUBLE"
        )
        test = "m = 0"
    elif isinstance(rule, rules.ColumnLength):
        fn, test = ("min", f"m > {rule.gt}") if rule.gt is not None else ("max", f"m < {rule.lt}")
        metric = f"{fn}(length({rule.column}))::DOUBLE"
    elif isinstance(rule, rules.ColumnCount):
        metric = f"any_value({len(columns)}::DOUBLE)"
        test = f"m > {rule.gt}" if rule.gt is not None else f"m >= {rule.ge}"
    else:
        metric = _METRIC_SQL[rule.kind].format(c=rule.column)
        test = {"IsComplete": "m = 1"}.get(rule.kind, f"m > {getattr(rule, 'gt', 0)}")
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    column = "NULL::VARCHAR" if rule.column is None else quote(rule.column)
    return (
        f"SELECT {key}{no} AS rule_no, {quote(rule.kind)} AS rule, {column} AS column_name, round(m, 6) AS actual, "
        f"{quote(rule.threshold())} AS threshold, coalesce({test}, false) AS passed "
        f"FROM (SELECT {key}{metric} AS m FROM {frm}{group})"
    )


_REVIEW_COLUMNS = [
    "review_id", "row_no", "product_id", "user_id", "category", "rating", "rating_count", "actual_price",
    "discount_percentage", "review_content", "img_link", "source_key",
]


def _ruleset_sql(name: str, source: str, columns: list[str], by: str = "") -> str:
    return " UNION ALL ".join(_rule_sql(i, r, source, columns, by) for i, r in enumerate(rules.RULESETS[name], 1))


_RESULT = ("rule_no", "rule", "column_name", "actual", "threshold", "passed")


def _review_rules(name):
    def run(spark, sf_dir):
        return rules.evaluate(reviews(spark, sf_dir), name).select(*_RESULT)

    return run


for _key, _name in (("dq_text_reviews", "text_reviews"), ("dq_deployed", "deployed"), ("dq_documented", "documented")):
    query(_key, f"WITH {REVIEWS_SQL} {_ruleset_sql(_name, 'reviews', _REVIEW_COLUMNS)}")(_review_rules(_name))

_SURVEYS_SQL = "surveys AS (SELECT CASE WHEN turn = 0 THEN 'c' || conv_id ELSE 'c' || conv_id || '-' || turn END AS response_id, role, text FROM conversations)"


@query("dq_surveys", f"WITH {_SURVEYS_SQL} {_ruleset_sql('surveys', 'surveys', ['response_id', 'role', 'text'])}")
def dq_surveys(spark, sf_dir):
    surveys = table(spark, sf_dir, "conversations").selectExpr(
        "case when turn = 0 then 'c' || conv_id else 'c' || conv_id || '-' || turn end as response_id", "role", "text"
    )
    return rules.evaluate(surveys, "surveys").select(*_RESULT)


@query(
    "dq_pass_rates",
    f"""WITH {REVIEWS_SQL}, results AS (
{_ruleset_sql('deployed', 'reviews', [c for c in _REVIEW_COLUMNS if c != 'source_key'], 'source_key')})
SELECT source_key, 'deployed' AS ruleset, count(*) AS rules, count(*) FILTER (WHERE passed) AS passed_rules,
  count(*) FILTER (WHERE NOT passed) AS failed_rules,
  round(count(*) FILTER (WHERE passed) / count(*)::DOUBLE, 4) AS pass_rate FROM results GROUP BY 1""",
)
def dq_pass_rates(spark, sf_dir):
    results = rules.evaluate(reviews(spark, sf_dir), "deployed", by="source_key")
    return rules.pass_rates(results, ("source_key", "ruleset"))


def _loads_sql() -> str:
    """The ruleset over the first, the first two and all three loads."""
    some = [f"r{k} AS (SELECT * FROM reviews WHERE row_no % 3 < {k})" for k in (1, 2, 3)]
    each = [
        f"SELECT 'load{k}' AS run, * FROM ({_ruleset_sql('text_reviews', f'r{k}', _REVIEW_COLUMNS)})" for k in (1, 2, 3)
    ]
    return f"WITH {REVIEWS_SQL}, {', '.join(some)}, results AS ({' UNION ALL '.join(each)})"


def _load_reviews(spark, sf_dir) -> str:
    state = shared_dir(spark, "rules")
    rows = reviews(spark, sf_dir)
    for k in range(3):
        rule_history.evaluate_load(rows.filter(F.col("row_no") % 3 == k), "text_reviews", state, f"load{k + 1}")
    return state


@query("dq_loads", f"{_loads_sql()} SELECT * FROM results")
def dq_loads(spark, sf_dir):
    """Results after each of three loads; each load reads its own rows only."""
    return rule_history.results(spark, _load_reviews(spark, sf_dir)).select("run", *_RESULT)


@query(
    "dq_pass_rates_over_time",
    f"""{_loads_sql()} SELECT run, count(*) AS rules, count(*) FILTER (WHERE passed) AS passed_rules,
  count(*) FILTER (WHERE NOT passed) AS failed_rules, round(count(*) FILTER (WHERE passed) / count(*)::DOUBLE, 4) AS pass_rate
FROM results GROUP BY 1""",
)
def dq_pass_rates_over_time(spark, sf_dir):
    return rules.pass_rates(rule_history.results(spark, _load_reviews(spark, sf_dir)), "run")


@query(
    "validate_encoding",
    """SELECT doc_id, doc_id % 4 = 1 AS bad, length(text) >= 10 AND doc_id % 4 = 1 AND trim(text) <> '' AS reported
FROM documents WHERE length(trim(text)) >= 10""",
)
def validate_encoding(spark, sf_dir):
    """Every fourth text ends in a broken byte."""
    long_enough = table(spark, sf_dir, "documents").filter("length(trim(text)) >= 10")
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    bad = F.col("doc_id") % 4 == 1
    rows = long_enough.select("doc_id", bad.alias("bad"), F.when(bad, broken).otherwise(F.col("text")).alias("t"))
    checked = validation.validate(rows, "t")
    return checked.select("doc_id", "bad", F.array_contains("issues", "invalid_encoding").alias("reported"))
