"""JSON payloads: notifications, OCR blocks, transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import keys

_DETAIL = "struct<bucket:struct<name:string>,object:struct<key:string>>"
_NOTIFICATION = f"detail {_DETAIL}, Records array<struct<detail:{_DETAIL},s3:{_DETAIL}>>"
_OCR = (
    "Blocks array<struct<BlockType:string,Text:string>>, DocumentMetadata struct<Pages:int>"
)


def parse_notifications(df: DataFrame, json_col: str = "body") -> DataFrame:
    """One row per object named in a notification: ``bucket, source_key,
    data_type, status``. [SRC10]

    ``status`` is ``started`` or ``skipped`` (unknown prefix); records of an
    unknown shape are ``unrecognised`` and those lacking a name ``failed``, both
    dead letters with an ``error``.
    """
    rest = [c for c in df.columns if c != json_col]
    parsed = df.withColumn("_n", F.from_json(json_col, _NOTIFICATION))
    # A top-level detail makes the event itself the only record.
    none = F.lit(None).cast(_DETAIL)
    own = F.array(F.struct(F.col("_n.detail").alias("detail"), none.alias("s3")))
    records = F.when(F.col("_n.detail").isNotNull(), own).otherwise(F.col("_n.Records"))
    each = parsed.select(*rest, F.col(json_col), F.explode_outer(records).alias("_r"))
    named = each.withColumn("_o", F.coalesce("_r.detail", "_r.s3")).select(
        *rest,
        json_col,
        F.col("_o.bucket.name").alias("bucket"),
        F.col("_o.object.key").alias("source_key"),
        F.col("_o").isNotNull().alias("_known"),
    )
    typed = named.withColumn(
        "data_type", F.when(F.col("source_key").isNotNull(), keys.data_type(F.col("source_key")))
    )
    status = (
        F.when(~F.col("_known"), "unrecognised")
        .when(F.col("bucket").isNull() | F.col("source_key").isNull(), "failed")
        .when(F.col("data_type") == "unknown", "skipped")
        .otherwise("started")
    )
    return typed.withColumn("status", status).withColumn(
        "error", F.when(F.col("status").isin("unrecognised", "failed"), F.col(json_col))
    ).drop("_known", json_col)


def ocr_text(df: DataFrame, json_col: str = "ocr_json") -> DataFrame:
    """Add ``extracted_text`` (LINE blocks in order), ``pages`` and ``block_count``. [SRC8]"""
    parsed = df.withColumn("_ocr", F.from_json(json_col, _OCR))
    lines = F.filter("_ocr.Blocks", lambda b: (b["BlockType"] == "LINE") & b["Text"].isNotNull())
    return parsed.withColumns(
        {
            "extracted_text": F.coalesce(F.array_join(F.transform(lines, lambda b: b["Text"]), "\n"), F.lit("")),
            "pages": F.coalesce("_ocr.DocumentMetadata.Pages", F.lit(1)),
            "block_count": F.when(F.col("_ocr.Blocks").isNull(), 0).otherwise(F.size("_ocr.Blocks")),
        }
    ).drop("_ocr")


def transcript_text(df: DataFrame, json_col: str = "transcript_json") -> DataFrame:
    """Add ``transcript``: the first transcript, else the empty text. [SRC7]"""
    found = F.get_json_object(json_col, "$.results.transcripts[0].transcript")
    return df.withColumn("transcript", F.coalesce(found, F.lit("")))
