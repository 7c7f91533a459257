"""Column kinds, inferred schemas and drift over runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.sinks.runs import read_runs
from feedmill.sources import drift


def test_kinds_and_types(spark):
    cells = {
        None: "void", "": "void", "7": "int", "-12": "int", "3000000000": "bigint", "99999999999999999999": "double", "1.5": "double", ".5e3": "double",
        "2024-02-29": "date", "2023-02-29": "string", "2024-01-02 03:04:05": "timestamp", "2024-01-02T03:04:05.5Z": "timestamp", "2024-01-02T03:04Z": "string", "TRUE": "boolean",
        "12a": "string", " 7": "string", "NaN": "string",
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r["c"]: r["t"] for r in df.select("c", drift.type_of(drift.kind_of(F.col("c")).cast("bigint")).alias("t")).collect()}
    assert got == cells
    mixed = {("1", "3000000000", ""): "bigint", ("1", "1.5"): "double", ("2024-01-01", "2024-01-01 00:00:00"): "timestamp", ("1", "true"): "string", ("1", "2024-01-01"): "string"}
    for values, want in mixed.items():
        kinds = spark.createDataFrame([(v,) for v in values], "c string").agg(F.bit_or(drift.kind_of(F.col("c")).cast("bigint")).alias("k"))
        assert kinds.select(drift.type_of(F.col("k"))).first()[0] == want, values


def test_types_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,"the, text",e\n1,"x\ny",\n2,,\n')
    (tmp_path / "b.csv").write_text("n,z\n1.5,true\n7\n")
    (tmp_path / "c.csv").write_text("n\n")
    got = {(r["path"].rpartition("/")[2], r["column_name"]): (r["place"], r["rows"], drift_type(spark, r["kinds"])) for r in drift.column_types(spark, str(tmp_path)).collect()}
    assert got == {
        ("a.csv", "n"): (0, 2, "int"), ("a.csv", "the, text"): (1, 2, "string"), ("a.csv", "e"): (2, 2, "void"),
        ("b.csv", "n"): (0, 2, "double"), ("b.csv", "z"): (1, 1, "boolean"), ("c.csv", "n"): (0, 0, "void"),
    }
    assert drift.infer_schema(spark, str(tmp_path)).simpleString() == "struct<n:double,the, text:string,z:boolean,e:string>"


def drift_type(spark, kinds):
    return spark.range(1).select(drift.type_of(F.lit(kinds).cast("bigint"))).first()[0]


def test_runs_tell_news_only(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    expected = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("at", T.DateType())])

    def run(name, **files):
        for file, body in files.items():
            (folder / f"{file}.csv").write_text(body)
        rows = drift.drift_run(spark, str(folder), expected, state, name).collect()
        return sorted((r["column_name"], r["change"], r["expected_type"], r["found_type"], r["files"], r["rows"]) for r in rows)

    assert run("1", a="id,text,at\n1,x,2024-01-01\n") == []
    news = run("2", b="id,text,more\nx1,y,1\n", c="id,text,at,more\n5,y,,1\n")
    assert news == [("at", "removed", "date", None, 1, 1), ("id", "type_changed", "bigint", "string", 1, 1), ("more", "added", None, "int", 2, 2)]
    # The same run again sees its own files anew and says the same.
    assert run("2") == news
    assert run("3") == [] and run("4", d="id,text,more\nx2,y,1\n") == []
    # A file that was written anew is a new file; a wider type is a new change.
    assert run("5", a="id,text,at,more\n1,x,soon,2.5\n2,x,,1\n") == [("at", "type_changed", "date", "string", 1, 2), ("more", "added", None, "double", 1, 2)]
    seen = read_runs(spark, f"{state}/files", drift.FILES).groupBy("run").count().collect()
    assert {r["run"]: r["count"] for r in seen} == {"1": 1, "2": 2, "4": 1, "5": 1}
