"""Routing of objects and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import keys


def with_data_type(df: DataFrame, key_col: str = "source_key") -> DataFrame:
    """[RT1]"""
    return df.withColumn("data_type", keys.data_type(F.col(key_col)))


def route(df: DataFrame) -> DataFrame:
    """The rows with ``data_type`` and, for unknown types, an ``error``, in one pass. [RT2]

    Store it by ``data_type`` and a branch reads only its own folder;
    ``split_dead_letters`` parts the errors.
    """
    routed = df if "data_type" in df.columns else with_data_type(df)
    return routed.withColumn("error", F.when(F.col("data_type") == "unknown", F.lit("unknown data type")))


def route_upload(df: DataFrame, filename: str = "filename") -> DataFrame:
    """Target key (null: skipped) and content type of local files. [RT3, RT4]"""
    prefix = keys.upload_prefix(F.col(filename))
    return df.withColumns(
        {"target_key": F.concat(prefix, F.col(filename)), "content_type": keys.content_type(F.col(filename))}
    )


def with_audio_format(df: DataFrame, key_col: str = "source_key") -> DataFrame:
    """Media format, or ``error`` for unsupported files. [RT5]"""
    fmt = keys.audio_format(F.col(key_col))
    return df.withColumn("media_format", fmt).withColumn(
        "error",
        F.when(F.col("media_format").isNull(), F.concat(F.lit("Unsupported audio format: "), F.col(key_col))),
    )


def with_image_route(df: DataFrame, key_col: str = "source_key", len_col: str = "length") -> DataFrame:
    """Image format, direct or deferred reading, image or text prompt. [RT6]"""
    inline = keys.fits_inline(F.col(len_col))
    return df.withColumns(
        {
            "image_format": keys.image_format(F.col(key_col)),
            "method": F.when(inline, "sync").otherwise("async"),
            "prompt_kind": F.when(inline, "multimodal").otherwise("text"),
        }
    )


def with_output_key(df: DataFrame, kind: str, key_col: str = "source_key", out: str = "output_key") -> DataFrame:
    """[RT7]"""
    data_type = F.col("data_type") if "data_type" in df.columns else keys.data_type(F.col(key_col))
    ts = F.col("ts") if "ts" in df.columns else None
    return df.withColumn(out, keys.output_key(F.col(key_col), kind, data_type, ts))


def split_dead_letters(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows and rows with an error. [STR6]"""
    bad = F.col(error_col).isNotNull()
    return df.filter(~bad).drop(error_col), df.filter(bad)
