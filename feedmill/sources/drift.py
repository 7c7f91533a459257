"""Column types of CSV files and their drift from a catalog's schema, reading each file once. [SRC9]

The kinds of a column's cells are bits, and bits merge by ``or``: within a task,
over the tasks of a file, over files and over runs. The type is read off the
bits at the end. A manifest of the files seen lets a run read only new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.sinks.runs import read_runs, write_run
from feedmill.sources import records

NONE, INT, LONG, DOUBLE, DATE, TIME, BOOLEAN, STRING = (1 << i for i in range(8))
#: What a column of a type may hold, null always among it.
HOLDS = {
    "int": INT, "bigint": INT | LONG, "double": INT | LONG | DOUBLE, "date": DATE, "timestamp": DATE | TIME, "boolean": BOOLEAN,
    "string": INT | LONG | DOUBLE | DATE | TIME | BOOLEAN | STRING,
}

FILES = "path string, length bigint, ts timestamp"
TYPES = "path string, column_name string, place int, kinds bigint, rows bigint"
CHANGES = "column_name string, change string, expected_type string, found_type string, files bigint, rows bigint, first_file string"


def kind_of(cell: Column) -> Column:
    """The kind of one cell as a bit."""
    whole = cell.rlike(r"\A[+-]?[0-9]{1,19}\z")
    number = cell.rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\z")
    day = cell.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    time = cell.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:?[0-9]{2})?\z")
    return (
        F.when(cell.isNull() | (cell == ""), NONE)
        .when(whole & cell.try_cast("int").isNotNull(), INT)
        .when(whole & cell.try_cast("bigint").isNotNull(), LONG)
        .when(number, DOUBLE)
        .when(day & cell.try_cast("date").isNotNull(), DATE)
        .when(time & cell.try_cast("timestamp").isNotNull(), TIME)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .otherwise(STRING)
    )


def type_of(kinds: Column) -> Column:
    """The narrowest type that holds all kinds; a column without values is ``void``."""
    out = F.when(kinds.bitwiseAND(~NONE) == 0, "void")
    for name, bits in HOLDS.items():
        out = out.when(kinds.bitwiseAND(F.lit(~(bits | NONE)).cast("bigint")) == 0, name)
    return out


def column_types(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, column_name, place, kinds, rows``: one row for each file and column of its header.

    Files are split, quoted cells may hold line breaks, and one number per cell
    is what the tasks count. Records with more or fewer cells than the header
    count for the columns they have.
    """
    found = records.records(spark, paths)
    # The header travels with the counts, so the files are cut once.
    cell = lambda c: F.struct(
        F.when(F.col("is_header"), c).alias("name"), F.when(~F.col("is_header"), kind_of(c).cast("bigint")).alias("kind")
    )
    cells = found.select("_file", F.posexplode_outer(F.transform(records.cells(F.col("record")), cell)).alias("place", "_c"))
    merged = cells.groupBy("_file", "place").agg(
        F.max("_c.name").alias("column_name"), F.bit_or("_c.kind").alias("kinds"), F.count("_c.kind").alias("rows")
    )
    return merged.filter("column_name is not null").select(
        F.col("_file").alias("path"), "column_name", "place", F.coalesce("kinds", F.lit(NONE).cast("bigint")).alias("kinds"), "rows"
    )


def infer_schema(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """The merged schema of all files, columns in order of their first place; one small row per column comes to the driver."""
    merged = column_types(spark, path).groupBy("column_name").agg(F.bit_or("kinds").alias("kinds"), F.min("place").alias("place"))
    rows = merged.select("column_name", "place", type_of(F.col("kinds")).alias("type")).collect()
    fields = sorted(rows, key=lambda r: (r["place"], r["column_name"]))
    return T.StructType([T.StructField(r["column_name"], T._parse_datatype_string("string" if r["type"] == "void" else r["type"])) for r in fields])


def changes(types: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that files have more or less than expected, or whose cells the expected type cannot hold."""
    spark = types.sparkSession
    wanted = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), HOLDS.get(f.dataType.simpleString(), HOLDS["string"]) | NONE) for f in expected.fields],
        "_name string, _type string, _holds bigint",
    )
    beside = types.join(wanted, F.col("column_name") == F.col("_name"), "left")
    too_wide = F.col("kinds").bitwiseAND(F.bitwise_not("_holds")) != 0
    change = F.when(F.col("_name").isNull(), "added").when(too_wide, "type_changed")
    found = beside.select("path", "column_name", change.alias("change"), F.col("_type").alias("expected_type"), type_of(F.col("kinds")).alias("found_type"), "rows")
    # Each file against the list of expected names, which is as long as the schema.
    per_file = types.groupBy("path").agg(F.max("rows").alias("rows"), F.collect_set("column_name").alias("_has"))
    lost = per_file.select("path", "rows", F.explode(F.array_except(F.array(*[F.lit(f.name) for f in expected.fields]), F.col("_has"))).alias("column_name"))
    lost = lost.join(wanted, F.col("column_name") == F.col("_name")).select(
        "path", "column_name", F.lit("removed").alias("change"), F.col("_type").alias("expected_type"), F.lit(None).cast("string").alias("found_type"), "rows"
    )
    both = found.filter("change is not null").unionByName(lost)
    return both.groupBy("column_name", "change", "expected_type", "found_type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("path").alias("first_file")
    )


def new_files(spark: SparkSession, path: str | list[str], state: str, run: str) -> DataFrame:
    """``path, length, ts`` of the files that no earlier run has seen as they are now."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = listed.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length", F.col("modificationTime").alias("ts"))
    seen = read_runs(spark, f"{state}/files", FILES, but=run)
    return listed.join(seen.select("path", "length", "ts"), ["path", "length", "ts"], "left_anti")


def drift_run(spark: SparkSession, path: str | list[str], expected: T.StructType, state: str, run: str) -> DataFrame:
    """The changes that the files new in this run show for the first time; nothing is applied.

    ``state`` holds the manifest, the column types of every file and the changes
    reported so far. The manifest is written last, so a run that breaks off is
    repeated in full, and a repeated run replaces its own part.
    """
    fresh = new_files(spark, path, state, run)
    # The names of new files only; Spark takes its input as such a list in any case.
    paths = [r["path"] for r in fresh.select("path").collect()]
    if paths:
        types = write_run(column_types(spark, paths), f"{state}/types", run)
    else:
        types = spark.createDataFrame([], TYPES)
    told = read_runs(spark, f"{state}/changes", CHANGES, but=run)
    key = ["column_name", "change", "found_type"]
    now = changes(types, expected)
    # A struct compares nulls as equal.
    known = told.select(F.struct(*key).alias("_known")).distinct()
    now = now.withColumn("_own", F.struct(*key)).join(known, F.col("_own") == F.col("_known"), "left_anti").drop("_own")
    out = write_run(now, f"{state}/changes", run)
    write_run(fresh, f"{state}/files", run)
    return out
