"""Data-quality rules over a table that grows by loads, with their results kept. [DQ5, DQ6, DQ11]

Every metric is a merge of parts, one per load, so a load reads its own rows
only. Uniqueness keeps how often each value has occurred: the values of a new
load look up what they were before, and the number of values that occur once
changes by the difference. Results are appended under the load's name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators import rules as dq
from feedmill.operators.ordering import keys
from feedmill.sinks.runs import RUN, read_runs, write_run

RESULTS = "ruleset string, rule_no int, rule string, column_name string, actual double, threshold string, passed boolean"
BUCKETS = 64


def _part(rule: dq.Rule, known: Sequence[str], n_columns: int) -> tuple[Column, str]:
    """What a load contributes to a rule's metric, and how parts merge."""
    if rule.column is not None and rule.column not in known:
        return F.lit(None).cast("double"), "sum"
    if isinstance(rule, (dq.IsComplete, dq.Completeness)):
        return F.count(rule.column).cast("double"), "sum"
    if isinstance(rule, dq.ColumnValues):
        return rule.metric(n_columns), "sum"
    if isinstance(rule, dq.ColumnLength):
        return rule.metric(n_columns), "min" if rule.gt is not None else "max"
    return F.lit(float(n_columns)), "max"


def _metric(rule: dq.Rule, value: Column, rows: Column) -> Column:
    if isinstance(rule, (dq.IsComplete, dq.Completeness)):
        return F.try_divide(value, rows)
    return rows.cast("double") if isinstance(rule, dq.RowCount) else value


def _upto(spark: SparkSession, path: str, schema: T.StructType, run: str, own: bool) -> DataFrame:
    rows = read_runs(spark, path, schema)
    return rows.filter(F.col(RUN) <= run if own else F.col(RUN) < run)


def _values(df: DataFrame, uniques: dict[int, dq.Rule], by: list[str]) -> DataFrame:
    """How often each value of each unique column occurs: one scan and one shuffle for all of them."""
    cells = F.array(*[F.struct(F.lit(no).alias("rule_no"), F.col(r.column).cast("string").alias("value")) for no, r in uniques.items()])
    rows = df.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*")
    return rows.groupBy(*by, "rule_no", "value").agg(F.count(F.lit(1)).alias("n"))


def _once(df: DataFrame, uniques: dict[int, dq.Rule], by: list[str], state: str, run: str) -> DataFrame:
    """``by, rule_no, once, total`` over all loads up to this one."""
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64("rule_no", "value"), F.lit(BUCKETS)).cast("int")
    path = f"{state}/values"
    fresh = _values(df, uniques, by).withColumn("bucket", bucket)
    fresh.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{RUN}={run}")
    fresh = spark.read.schema(fresh.schema).parquet(f"{path}/{RUN}={run}")
    group = F.struct(*by, "rule_no", "value")
    new = fresh.select("bucket", group.alias("_g"), *by, "rule_no", "value", "n")
    # Only values that the load has are looked up; the optimizer filters the stored ones by them before any shuffle.
    old = _upto(spark, path, fresh.schema, run, own=False).select("bucket", group.alias("_o"), F.col("n").alias("before"))
    old = old.join(new.select(F.col("bucket"), F.col("_g").alias("_o")), ["bucket", "_o"], "left_semi")
    old = old.groupBy("_o").agg(F.sum("before").alias("before"))
    both = new.join(old, F.col("_g") == F.col("_o"), "left").withColumn("before", F.coalesce("before", F.lit(0)))
    single = (F.col("before") == 0) & (F.col("n") == 1)
    change = F.when(F.col("value").isNull(), 0).when(single, 1).when(F.col("before") == 1, -1).otherwise(0)
    delta = both.groupBy(*by, "rule_no").agg(F.sum(change).alias("once"), F.sum("n").alias("total"))
    delta = write_run(delta, f"{state}/once", run)
    return _upto(spark, f"{state}/once", delta.schema, run, own=True).groupBy(*by, "rule_no").agg(
        F.sum("once").alias("once"), F.sum("total").alias("total")
    )


def evaluate_load(
    df: DataFrame, rules: Sequence[dq.Rule] | str, state: str, run: str, name: str | None = None, by: str | Sequence[str] = ()
) -> DataFrame:
    """Results over all loads so far, after adding the rows of ``df`` as the load ``run``.

    Equal to ``rules.evaluate`` over all rows at once. Names of loads sort in
    their order; a repeated load replaces its own part and results.
    """
    by = keys(by)
    spark = df.sparkSession
    if isinstance(rules, str):
        name, rules = name or rules, dq.RULESETS[rules]
    name = name or "custom"
    n_columns = len([c for c in df.columns if c not in by])
    numbered = dict(enumerate(rules, 1))
    uniques = {no: r for no, r in numbered.items() if isinstance(r, dq.Uniqueness) and r.column in df.columns}
    plain = {no: r for no, r in numbered.items() if no not in uniques}
    parts = {no: _part(r, df.columns, n_columns) for no, r in plain.items()}
    own = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[p.alias(f"_m{no}") for no, (p, _) in parts.items()])
    own = write_run(own, f"{state}/parts", run)
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    merged = _upto(spark, f"{state}/parts", own.schema, run, own=True).groupBy(*by).agg(
        F.sum("_rows").alias("_rows"), *[merge[how](f"_m{no}").alias(f"_m{no}") for no, (_, how) in parts.items()]
    )
    found = []
    if plain:
        metrics = [dq._result(no, r, _metric(r, F.col(f"_m{no}"), F.col("_rows"))) for no, r in plain.items()]
        found.append(dq._as_rows(merged, by, name, metrics))
    if uniques:
        # The rule's number chooses its threshold and verdict.
        share = _once(df, uniques, by, state, run).withColumn("_u", F.try_divide("once", "total"))
        picked = [F.when(F.col("rule_no") == no, dq._result(no, r, F.col("_u"))) for no, r in uniques.items()]
        found.append(share.select(*by, F.lit(name).alias("ruleset"), F.coalesce(*picked).alias("_r")).select(*by, "ruleset", "_r.*"))
    out = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return write_run(out, f"{state}/results", run)


def results(spark: SparkSession, state: str, by: str | Sequence[str] = ()) -> DataFrame:
    """The results of all loads, with the load's name in ``run``; for ``rules.pass_rates`` over time."""
    groups = "".join(f"`{c}` string, " for c in keys(by))
    return read_runs(spark, f"{state}/results", groups + RESULTS)
