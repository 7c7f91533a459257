"""All sinks of a run as one commit: a reader sees every one of them or none. [SNK1-SNK6]

An attempt writes into a folder of its own. When the last sink is written, one
small file is moved into place that names the attempt; that move is the commit.
An attempt that breaks off is never named, and a repeated run changes from its
old attempt to the new one at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.sinks.runs import RUN


def _files(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path


def commit_run(spark: SparkSession, path: str, run: str, write: Callable[[str], None]) -> str:
    """Let ``write`` store all sinks of ``run`` in the folder it is given, then make them visible. Returns that folder."""
    attempt = f"{path.rstrip('/')}/attempts/{RUN}={run}-{uuid.uuid4().hex}"
    write(attempt)
    fs, path_of = _files(spark, path)
    draft = path_of(f"{attempt}.pointer")
    out = fs.create(draft, True)
    out.write(bytearray(attempt.rpartition("/")[2].encode()))
    out.close()
    pointer = path_of(f"{path.rstrip('/')}/commits/{RUN}={run}")
    fs.mkdirs(pointer.getParent())
    # One move, over the pointer of an earlier attempt.
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(pointer), how)
    return attempt


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each committed run."""
    fs, path_of = _files(spark, path)
    folder = path_of(f"{path.rstrip('/')}/commits")
    if not fs.exists(folder):
        return {}
    out = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{RUN}="):
            stream = fs.open(status.getPath())
            attempt = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            out[name.removeprefix(f"{RUN}=")] = f"{path.rstrip('/')}/attempts/{attempt}"
    return out


def read_sink(spark: SparkSession, path: str, sink: str, schema, kind: str = "parquet") -> DataFrame:
    """One sink of all committed runs, with the run's name in ``run``."""
    empty = spark.createDataFrame([], schema).withColumn(RUN, F.lit(None).cast("string"))
    for run, folder in sorted(committed(spark, path).items()):
        # A run is one folder; runs are few beside their rows.
        rows = spark.read.schema(schema).format(kind).load(f"{folder}/{sink}")
        empty = empty.unionByName(rows.withColumn(RUN, F.lit(run)))
    return empty


def remove_broken(spark: SparkSession, path: str) -> int:
    """Delete the folders of attempts that no commit names. For times without a running writer."""
    fs, path_of = _files(spark, path)
    kept = {folder.rpartition("/")[2] for folder in committed(spark, path).values()}
    folder = path_of(f"{path.rstrip('/')}/attempts")
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in kept] if fs.exists(folder) else []
    for old in gone:
        fs.delete(old, True)
    return len(gone)
