"""Object-key expressions: type, format and derived output keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key prefix -> data type.
DATA_TYPES = {
    "text-reviews/": "text_reviews",
    "images/": "images",
    "audio/": "audio",
    "surveys/": "surveys",
}

# File name rule (start, end) -> prefix, first hit wins.
UPLOAD_RULES = (
    ("survey_", ".txt", "surveys/"),
    ("", ".csv", "text-reviews/"),
    ("", ".json", "surveys/"),
    ("", ".mp3", "audio/"),
    ("", ".wav", "audio/"),
    ("", ".flac", "audio/"),
    ("", ".jpg", "images/"),
    ("", ".jpeg", "images/"),
    ("", ".png", "images/"),
)

# File extension -> content type.
CONTENT_TYPES = {
    ".csv": "text/csv",
    ".json": "application/json",
    ".txt": "text/plain",
    ".mp3": "audio/mpeg",
    ".wav": "audio/wav",
    ".flac": "audio/flac",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
}

# Supported audio extensions and image extension -> format.
AUDIO_FORMATS = ("mp3", "mp4", "wav", "flac", "ogg", "amr", "webm")
IMAGE_FORMATS = {"jpg": "jpeg", "jpeg": "jpeg", "png": "png", "gif": "gif", "webp": "webp"}
IMAGE_BYTE_LIMIT = 5 * 1024 * 1024


def _lookup(key: Column, table: dict[str, str], default: str | None = None) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def extension(key: Column) -> Column:
    """Lower-cased text after the last dot; null without a dot."""
    return F.when(F.contains(key, F.lit(".")), F.lower(F.substring_index(key, ".", -1)))


def data_type(key: Column) -> Column:
    col = F.lit("unknown")
    for prefix, name in reversed(DATA_TYPES.items()):
        col = F.when(key.startswith(prefix), name).otherwise(col)
    return col


def upload_prefix(filename: Column) -> Column:
    """Target prefix of a file name; null means the file is skipped."""
    col = F.lit(None).cast("string")
    for start, end, prefix in reversed(UPLOAD_RULES):
        hit = filename.startswith(start) & filename.endswith(end)
        hit = hit & (F.length(filename) >= len(start) + len(end))
        col = F.when(hit, prefix).otherwise(col)
    return col


def content_type(filename: Column) -> Column:
    suffix = F.lower(F.regexp_extract(basename(filename), r"^.+(\.[^.]+)$", 1))
    return _lookup(suffix, CONTENT_TYPES, "application/octet-stream")


def audio_format(key: Column) -> Column:
    """Media format, or null when the extension is unsupported."""
    ext = extension(key)
    return F.when(ext.isin(*AUDIO_FORMATS), ext)


def image_format(key: Column) -> Column:
    return _lookup(F.coalesce(extension(key), F.lit("jpeg")), IMAGE_FORMATS, "jpeg")


def fits_inline(length: Column, limit: int = IMAGE_BYTE_LIMIT) -> Column:
    """True for images small enough for a direct call; unknown size is not."""
    return F.coalesce(length <= limit, F.lit(False))


def normalized_key(key: Column) -> Column:
    """First ``text-reviews/`` swapped for ``normalized/``, else the prefix added."""
    old, new = "text-reviews/", "normalized/"
    at = F.instr(key, old)
    swapped = F.when(
        at > 0,
        F.concat(F.substring(key, F.lit(1), at - 1), F.lit(new), F.substring(key, at + len(old), F.length(key))),
    ).otherwise(key)
    return F.when(swapped.startswith(new), swapped).otherwise(F.concat(F.lit(new), swapped))


# Folder and ending of each kind of output.
OUTPUTS = {
    "transcript": ("normalized/", ".txt"),
    "ocr": ("textract-output/", ".txt"),
    "survey": ("survey-summaries/", ".summary.txt"),
    "quality": ("quality-reports/", ".quality.json"),
    "insights": ("insights/", ".insights.json"),
}


def output_key(key: Column, kind: str, data_type_col: Column | None = None, ts: Column | None = None) -> Column:
    """Derived key of one output kind; reports lie by type, insights also by day."""
    if kind == "normalized":
        return normalized_key(key)
    if kind not in OUTPUTS:
        raise ValueError(f"unknown output kind: {kind}")
    folder, ending = OUTPUTS[kind]
    by = [data_type_col] if kind in ("quality", "insights") else []
    if kind == "insights":
        by.append(F.date_format(ts, "yyyy/MM/dd"))
    levels = [part for level in by for part in (level, F.lit("/"))]
    return F.concat(F.lit(folder), *levels, basename(key), F.lit(ending))
