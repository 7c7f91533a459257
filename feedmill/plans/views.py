"""Input views shared by the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions import text as tx

NL = "chr(10)"


#: A session setting: how many partitions the caller wants its input tables dealt to.
PARTITIONS = "feedmill.input.partitions"


def spread(df: DataFrame) -> DataFrame:
    """Input tables as the files give them, unless the caller set ``PARTITIONS``.

    A test table of one row group is one task whatever the split size; a
    benchmark on such tables sets the number of its cores. Nothing is decided by
    the size of the data.
    """
    wanted = df.sparkSession.conf.get(PARTITIONS, None)
    return df.repartition(int(wanted), df.columns[0]) if wanted else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels in the shape of a review table."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.selectExpr(
        "cast(doc_id - doc_id % 10 * (case when doc_id % 7 = 0 then 1 else 0 end) as string) as review_id",
        "doc_id as row_no",
        "source as product_id",
        "'U' || (doc_id % 97) as user_id",
        "lang || '|' || source as category",
        "case when quality = 1 and toxic = 0 then '5.0' when quality = 1 then '3' "
        "when toxic = 0 then '1|x' when toxic = 1 then 'n/a' end as rating",
        "(doc_id % 90 + 10) || ',' || lpad(cast(doc_id % 1000 as string), 3, '0') as rating_count",
        "'$' || (doc_id * 7 % 900) || '.99' as actual_price",
        "(doc_id % 80) || '%' as discount_percentage",
        "case when doc_id % 53 = 0 then null when doc_id % 59 = 0 then '   ' else text end as review_content",
        "case when doc_id % 3 = 0 then 'https://example.com/i/' || doc_id end as img_link",
        "'text-reviews/' || source || '.csv' as source_key",
    )


REVIEWS_SQL = """reviews AS (
  SELECT CAST(d.doc_id - d.doc_id % 10 * (CASE WHEN d.doc_id % 7 = 0 THEN 1 ELSE 0 END) AS VARCHAR) AS review_id,
    d.doc_id AS row_no, d.source AS product_id, 'U' || (d.doc_id % 97) AS user_id,
    d.lang || '|' || d.source AS category,
    CASE WHEN l.quality = 1 AND l.toxic = 0 THEN '5.0' WHEN l.quality = 1 THEN '3'
         WHEN l.toxic = 0 THEN '1|x' WHEN l.toxic = 1 THEN 'n/a' END AS rating,
    (d.doc_id % 90 + 10) || ',' || lpad(CAST(d.doc_id % 1000 AS VARCHAR), 3, '0') AS rating_count,
    '$' || (d.doc_id * 7 % 900) || '.99' AS actual_price,
    (d.doc_id % 80) || '%' AS discount_percentage,
    CASE WHEN d.doc_id % 53 = 0 THEN NULL WHEN d.doc_id % 59 = 0 THEN '   ' ELSE d.text END AS review_content,
    CASE WHEN d.doc_id % 3 = 0 THEN 'https://example.com/i/' || d.doc_id END AS img_link,
    'text-reviews/' || d.source || '.csv' AS source_key
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def event_points(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events as metric points: a start, an outcome and a score each."""
    events = table(spark, sf_dir, "events") if events is None else events
    dims = F.create_map(F.lit("DataType"), F.col("event_type"))

    def point(metric, value, unit):
        return F.struct(
            metric.alias("metric"), value.alias("value"), F.lit(unit).alias("unit"), dims.alias("dims")
        )

    failed = F.col("event_type") == "error"
    outcome = F.when(failed, "PipelineExecutionsFailed").otherwise("PipelineExecutionsSucceeded")
    points = F.array(
        point(F.lit("PipelineExecutionsStarted"), F.lit(1.0), "Count"),
        point(outcome, F.lit(1.0), "Count"),
        point(F.lit("FinalDataQualityScore"), F.col("value"), "None"),
    )
    return events.select("ts", F.explode(points).alias("p")).select("ts", "p.*")


POINTS_SQL = """points AS (
  SELECT ts, event_type AS data_type, 'PipelineExecutionsStarted' AS metric, 1.0::DOUBLE AS value FROM events
  UNION ALL SELECT ts, event_type, CASE WHEN event_type = 'error' THEN 'PipelineExecutionsFailed'
    ELSE 'PipelineExecutionsSucceeded' END, 1.0::DOUBLE FROM events
  UNION ALL SELECT ts, event_type, 'FinalDataQualityScore', value FROM events),
series AS (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, metric, count(*) AS points,
    sum(value) AS total, avg(value) AS average
  FROM points GROUP BY 1, 2)"""


# --- SQL text helpers -------------------------------------------------------


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{tx.SPACE_CLASS}]+|[{tx.SPACE_CLASS}]+$', '', 'g')"


def gsub(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(by)}, 'g')"


def normalize_sql(expr: str) -> str:
    out = f"nfc_normalize(coalesce({expr}, ''))"
    out = gsub(out, tx.HTML_PATTERN, " ")
    out = gsub(out, tx.URL_PATTERN, " ")
    out = gsub(out, tx.EMOJI_PATTERNS["reference"], " ")
    for entity, char in tx.ENTITIES:
        out = f"replace({out}, {quote(entity)}, {quote(char)})"
    for mark in "!?.,;:-":
        out = gsub(out, f"[{mark}]{{3,}}", mark)
    out = gsub(out, " {2,}", " ")
    out = f"regexp_replace({out}, '\\n{{3,}}', {NL} || {NL}, 'g')"
    return strip_sql(out)


def words_sql(expr: str) -> str:
    return f"regexp_split_to_array(lower({expr}), '[^\\p{{L}}\\p{{N}}]+')"


def count_sql(tokens: str, values) -> str:
    return f"len(list_filter({tokens}, lambda w: list_contains({listed(values)}, w)))"
