"""File and table readers."""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions import text as tx
from feedmill.schemas import RAW_REVIEW_SCHEMA
from feedmill.sources import drift, records

UNREADABLE_SURVEY = "Could not read survey data."
# Line breaks besides CR and LF, which the text reader handles.
LINE_BREAKS = r"[\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_ROW_BITS = 33


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _bare(path: str) -> str:
    """A path without scheme, the way it stands in a full path of any file below it."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path.rstrip("/"))


def parent_of(path: str) -> str:
    """The folder that holds ``path``; of a pattern, the folder above its fixed part."""
    fixed = re.split(r"[*?{\[]", path.rstrip("/"))[0]
    return fixed.rpartition("/")[0]


def key_from_path(path: Column, root: str | list[str]) -> Column:
    """Object key: the path relative to the root it lies in, else the file name.

    Two files below different folders of a root keep different keys, and the
    data type follows from the first folder below the root.
    """
    full = _decoded(path)
    key = F.lit(None).cast("string")
    for base in [root] if isinstance(root, str) else root:
        mark = f"{_bare(base)}/"
        mark = mark if mark.startswith("/") else f"/{mark}"
        at = F.instr(full, mark)
        key = F.coalesce(key, F.when(at > 0, F.substr(full, at + len(mark), F.length(full))))
    return F.coalesce(key, F.substring_index(full, "/", -1))


def _roots(path: str | list[str], root: str | None) -> list[str]:
    return [root] if root is not None else [parent_of(p) for p in ([path] if isinstance(path, str) else path)]


def _row_no() -> Column:
    """A number that grows along each file.

    Byte offset of the split plus the row's place in its scan task: every row
    takes at least one byte, so a later split always starts above an earlier one.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return F.col("_metadata.file_block_start") + place


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_REVIEW_SCHEMA,
    multi_line: bool = False,
    root: str | None = None,
) -> DataFrame:
    """Review CSV files with this header, one ``source_key`` per file. [SRC1]

    Large files are split. Without ``multi_line`` a record is a line; with it
    quoted cells may hold line breaks, and the byte ranges of a file are still
    read side by side. Keys are relative to ``root``, by default the folder that
    holds ``path``. Files with other headers: ``read_mixed``.
    """
    key = lambda path_col: key_from_path(path_col, _roots(path, root)).alias("source_key")
    if multi_line:
        found = records.records(spark, path)
        names = F.array(*[F.lit(f.name) for f in schema.fields])
        wrong = F.raise_error(F.concat(F.lit("the header does not name the schema's columns: "), F.substr("record", F.lit(1), F.lit(500))))
        same = F.coalesce(records.cells(F.col("record")) == names, F.lit(False))
        # A header is checked where it lies, and left out.
        body = found.filter(F.when(F.col("is_header"), F.when(same, False).otherwise(wrong.cast("boolean"))).otherwise(True))
        parsed = F.from_csv("record", _ddl(schema), {"quote": '"', "escape": '"'})
        return body.select(key(F.col("_file")), F.col("_id").alias("row_no"), parsed.alias("_c")).select("source_key", "row_no", "_c.*")
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("enforceSchema", False).schema(schema)
    rows = reader.csv(path)
    return rows.select(key(F.col("_metadata.file_path")), _row_no().alias("row_no"), *rows.columns)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Lines of text files with their place: ``_file, _at, _id, _part, line``."""
    files = spark.read.option("recursiveFileLookup", recursive).text(path)
    return files.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_at"),
        _row_no().alias("_id"),
        F.posexplode(F.split(tx.decode_utf8(F.col("value")), LINE_BREAKS)).alias("_part", "line"),
    )


def _headers(lines: DataFrame) -> DataFrame:
    """The first line of each file: one small row per file."""
    first = lines.filter("_at = 0").groupBy("_file").agg(F.min(F.struct("_id", "_part", "line")).alias("_h"))
    return first.select(F.col("_file").alias("_hf"), F.col("_h.line").alias("header"), F.col("_h._id").alias("_hid"), F.col("_h._part").alias("_hpart"))


def read_reviews_salvage(
    spark: SparkSession, path: str | list[str], column: str = "review_content", root: str | None = None
) -> DataFrame:
    """One column of malformed CSV files by plain comma splitting, with ``row_no``. [SRC2]

    Bad bytes are replaced. The column is the first whose header contains the
    name in any case; a file without it gives no rows, a short line gives null.
    """
    lines = _lines(spark, path)
    names = F.transform(F.split("header", ","), lambda h: F.lower(F.btrim(h, F.lit('"'))))
    index = F.array_position(F.transform(names, lambda h: F.contains(h, F.lit(column.lower()))), F.lit(True))
    headers = _headers(lines).withColumn("_index", index.cast("int")).filter("_index > 0")
    body = lines.join(headers, F.col("_file") == F.col("_hf")).filter("_id <> _hid or _part <> _hpart")
    return body.select(
        key_from_path(F.col("_file"), _roots(path, root)).alias("source_key"),
        F.col("_id").alias("row_no"),
        F.try_element_at(F.split("line", ","), F.col("_index")).alias(column),
    )


def read_mixed(
    spark: SparkSession,
    path: str | list[str],
    column: str = "review_content",
    root: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The review text of CSV files with any header: ``source_key, row_no, <column>, error``. [SRC1-SRC3]

    A file's text column is the one named ``column``, else the one with the
    longest texts on average. A record is a line, or with ``multi_line`` a
    record with line breaks inside its quotes. A record whose quotes do not
    match, or with another number of cells than the header, is an error row
    without a text; blank lines are skipped; a file without a header gives no
    rows. One bad file costs only itself.
    """
    if multi_line:
        found = records.records(spark, path, recursive=True)
    else:
        lines = _lines(spark, path, recursive=True).filter(~F.col("line").rlike(r"\A[ \t\r]*\z"))
        first = _headers(lines)
        heads = first.select("_hf", "_hid", "_hpart")
        lines = lines.join(heads, F.col("_file") == F.col("_hf"))
        is_header = (F.col("_id") == F.col("_hid")) & (F.col("_part") == F.col("_hpart"))
        record = F.when(is_header, F.ltrim("line", F.lit("\ufeff"))).otherwise(F.col("line"))
        found = lines.select("_file", "_id", record.alias("record"), is_header.alias("is_header"), F.lit(False).alias("is_open"))
    found = found.select("_file", "_id", "is_header", records.cells(F.col("record")).alias("_cells"))
    # One small row for each file.
    names = found.filter("is_header").select(F.col("_file").alias("_hf"), F.col("_cells").alias("_names"))
    body = found.filter("not is_header").join(names, F.col("_file") == F.col("_hf"))
    good = F.coalesce(F.size("_cells") == F.size("_names"), F.lit(False))
    body = body.withColumn("_good", good)
    # Sums of lengths per file and place of a column: as many numbers as the widest header has names.
    sizes = body.filter("_good").select("_file", F.posexplode("_cells").alias("_place", "_cell"))
    means = sizes.groupBy("_file", "_place").agg(F.avg(F.length("_cell")).alias("_mean"))
    longest = means.groupBy("_file").agg(F.max_by("_place", F.struct("_mean", -F.col("_place"))).alias("_longest"))
    longest = longest.withColumnRenamed("_file", "_lf")
    named = F.array_position("_names", column)
    chosen = F.when(named > 0, named.cast("int") - 1).otherwise(F.col("_longest"))
    rows = body.join(longest, F.col("_file") == F.col("_lf"), "left")
    text = F.nullif(F.get("_cells", chosen), F.lit(""))
    return rows.select(
        key_from_path(F.col("_file"), _roots(path, root)).alias("source_key"),
        F.col("_id").alias("row_no"),
        F.when(F.col("_good"), text).alias(column),
        F.when(~F.col("_good"), F.lit("malformed line")).alias("error"),
    )


def text_column_scores(df: DataFrame) -> DataFrame:
    """Mean length of the non-null texts of every string column, and which is the text column, in one scan."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    means = df.agg(*[F.avg(F.length(n)).alias(n) for n in names])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.round(n, 4).alias("mean_length"))
            for i, n in enumerate(names)
        ]
    )
    # The first of the longest: means are compared before places.
    ranked = F.transform(rows, lambda r: F.struct(r["mean_length"], -r["position"], r["column_name"]))
    best = F.array_max(ranked)["column_name"]
    return means.select(F.explode(rows).alias("_c"), best.alias("_best")).select("_c.*", (F.col("_c.column_name") == F.col("_best")).alias("picked"))


def pick_text_column(df: DataFrame, preferred: str = "review_content") -> str | None:
    """The preferred column if present, else the string column with the longest texts. [SRC3]

    One row of means comes to the driver; of equal means the first column wins.
    """
    if preferred in df.columns:
        return preferred
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return None
    means = df.agg(*[F.avg(F.length(n)).alias(n) for n in names]).first()
    known = [n for n in names if means[n] is not None]
    return max(known, key=lambda n: (round(means[n], 4), -names.index(n))) if known else None


def read_catalog(spark: SparkSession, table: str) -> DataFrame:
    """[SRC4]"""
    return spark.table(table)


def read_objects(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """Whole objects with size, time and bytes, keyed relative to ``root``, by default the folder that holds ``path``. [SRC6]

    Without a use of ``content`` Spark reads the listing only. Spark skips files
    of zero bytes; where they matter, take the file list from the notifications.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        key_from_path(F.col("path"), _roots(path, root)).alias("source_key"),
        F.col("modificationTime").alias("ts"),
        "length",
        "content",
    )


def survey_text(content: Column) -> Column:
    return F.coalesce(tx.strip(tx.decode_utf8(content)), F.lit(UNREADABLE_SURVEY))


def read_text_documents(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """Whole files as trimmed text, bad bytes replaced. [SRC5]"""
    objects = read_objects(spark, path, root)
    return objects.select(
        "source_key", "ts", "length", survey_text(F.col("content")).alias("survey_summary"),
        (~F.is_valid_utf8(F.col("content").cast("string"))).alias("had_bad_bytes"),
    )


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that were added, removed or changed type; nothing is applied. [SRC9]"""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in dict.fromkeys([*wanted, *found]):
        have, want = found.get(name), wanted.get(name)
        change = "removed" if have is None else "added" if want is None else "type_changed"
        if have != want:
            rows.append((name, want, have, change))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, found_type string, change string"
    )


def infer_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files of new folders with an inferred schema, for ``schema_drift``; large files are split."""
    return read_reviews(spark, path, drift.infer_schema(spark, path), multi_line=True).drop("source_key", "row_no")
