"""Tables that grow by runs: each run owns one folder and replaces only that when it is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def write_run(rows: DataFrame, path: str, run: str) -> DataFrame:
    """Store ``rows`` as the part of ``run`` and go on from their stored form."""
    folder = f"{path.rstrip('/')}/{RUN}={run}"
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def read_runs(spark: SparkSession, path: str, schema: T.StructType | str, but: str | None = None) -> DataFrame:
    """All runs with their name in ``run``, without the run ``but``; no rows if there is no table yet."""
    empty = spark.createDataFrame([], schema)
    if not exists(spark, path):
        return empty.withColumn(RUN, F.lit(None).cast("string"))
    typed = T.StructType([*empty.schema.fields, T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(typed).parquet(path)
    return rows if but is None else rows.filter(F.col(RUN) != but)
