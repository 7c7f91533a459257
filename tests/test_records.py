"""CSV records cut in many byte ranges, against the standard library's reader."""

from __future__ import annotations

import csv
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.sources import readers, records


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 700 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def random_file(rng, rows=150, end="\n"):
    def cell():
        signs = 'ab ,"\n\n"",d\r\n' if rng.random() < 0.6 else "abc é"
        return "".join(rng.choice(signs) for _ in range(rng.randrange(3000 if rng.random() < 0.02 else 30)))

    table = [["h\n1", "h,2", 'h"3']] + [[cell() for _ in range(3)] for _ in range(rows)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(table)
    return table, out.getvalue()


def test_records_of_many_ranges(spark, tmp_path, small_ranges):
    rng, want = random.Random(11), {}
    for name, end, before in (("a.csv", "\n", ""), ("b.csv", "\r\n", "\n \n"), ("c.csv", "\n", "﻿")):
        want[name], body = random_file(rng, end=end)
        (tmp_path / name).write_bytes((before + body).encode())
    (tmp_path / "empty.csv").write_bytes(b"\n\n")
    assert records.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 30
    got = defaultdict(list)
    found = records.records(spark, str(tmp_path)).withColumn("cells", records.cells(F.col("record")))
    for r in found.orderBy("_file", "_id").collect():
        got[r["_file"].rpartition("/")[2]].append((r["cells"], r["is_header"], r["is_open"]))
    assert set(got) == set(want)
    for name, rows in want.items():
        assert got[name] == [(row, i == 0, False) for i, row in enumerate(rows)], name


def test_quotes_that_do_not_match(spark, tmp_path, small_ranges):
    """A quote in a bare cell is a character; one that never closes takes the rest of its file only."""
    (tmp_path / "a.csv").write_text('x,y\n5" wide,1\nb,2"\n' + "long,row\n" * 200 + 'c,"open\n' + "still,inside\n" * 200)
    (tmp_path / "b.csv").write_text('x,y\n"a"b,1\nc,d\n')
    rows = records.records(spark, str(tmp_path)).orderBy("_file", "_id").collect()
    a = [r for r in rows if r["_file"].endswith("a.csv")]
    assert [r["record"] for r in a[:3]] == ["x,y", '5" wide,1', 'b,2"'] and len(a) == 204
    assert a[-1]["is_open"] and a[-1]["record"].count("\n") == 200 and not any(r["is_open"] for r in a[:-1])
    mixed = readers.read_mixed(spark, str(tmp_path), "y", multi_line=True)
    bad = mixed.filter("error is not null").groupBy("source_key").count().collect()
    assert {r["source_key"].rpartition("/")[2]: r["count"] for r in bad} == {"a.csv": 3, "b.csv": 1}


def test_cells_of_a_record(spark):
    cases = {
        "a,b": ["a", "b"], "": [""], ",": ["", ""], '"a, ""b""",c': ['a, "b"', "c"], '"a': None, 'a"b': None, '"a"b,c': None,
        '""': [""], '"""": ': None, '""""': ['"'], "a﷑b,c": ["a�b", "c"], '"a\nb",\n': ["a\nb", "\n"], '"': None, '"a","b': None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "record string")
    got = {r["record"]: r["c"] for r in df.select("record", records.cells(F.col("record")).alias("c")).collect()}
    assert got == cases
    long = spark.createDataFrame([('"' + "x,y" * 300_000 + '",' + '"' + '""' * 300_000 + '"',)], "record string")
    assert long.select(F.size(records.cells(F.col("record")))).first()[0] == 2


def test_header_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,"b"\n1,"2\n3"\n')
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert [tuple(r)[2:] for r in readers.read_reviews(spark, str(tmp_path / "a.csv"), schema, multi_line=True).collect()] == [(1, "2\n3")]
    with pytest.raises(Exception, match="header does not name"):
        readers.read_reviews(spark, str(tmp_path), schema, multi_line=True).collect()


def test_no_task_per_file(spark, tmp_path, small_ranges):
    """One file is read by many tasks, and texts are shuffled once: by their byte range."""
    (tmp_path / "one.csv").write_text("a,b\n" + '1,"x\ny"\n' * 2000)
    df = records.records(spark, str(tmp_path / "one.csv"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2001 and "multiLine" not in plan
    assert records.lines(spark, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 15
    texts = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_at" in x]
    assert texts and not any("RoundRobin" in x for x in plan.split("\n"))
