"""Declarative data-quality rules evaluated as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.operators.ordering import keys


@dataclass(frozen=True)
class Rule:
    """A rule names the column it reads and yields metric and verdict."""

    column: str | None = None

    @property
    def kind(self) -> str:
        return type(self).__name__

    def threshold(self) -> str:
        return ""

    def metric(self, n_columns: int) -> Column:
        raise NotImplementedError

    def verdict(self, metric: Column) -> Column:
        raise NotImplementedError


def _rows() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class IsComplete(Rule):
    """No nulls."""

    def threshold(self) -> str:
        return "= 1"

    def metric(self, n_columns: int) -> Column:
        return F.try_divide(F.count(self.column), _rows())

    def verdict(self, metric: Column) -> Column:
        return metric == 1


@dataclass(frozen=True)
class Completeness(Rule):
    """Share of non-null rows above a bound."""

    gt: float = 0.0

    def threshold(self) -> str:
        return f"> {self.gt}"

    def metric(self, n_columns: int) -> Column:
        return F.try_divide(F.count(self.column), _rows())

    def verdict(self, metric: Column) -> Column:
        return metric > self.gt


@dataclass(frozen=True)
class ColumnValues(Rule):
    """All values within bounds; the metric is the number of rows that are not."""

    low: float = 0.0
    high: float = 0.0
    inclusive: bool = True
    nulls_pass: bool = True

    def threshold(self) -> str:
        return f"between {self.low} and {self.high}"

    def metric(self, n_columns: int) -> Column:
        value = F.col(self.column).cast("string").try_cast("double")
        inside = value.between(self.low, self.high) if self.inclusive else (value > self.low) & (value < self.high)
        # A value that is no number is a violation, a null only if so asked.
        inside = F.coalesce(inside, F.col(self.column).isNull() & F.lit(self.nulls_pass))
        return F.count_if(~inside).cast("double")

    def verdict(self, metric: Column) -> Column:
        return metric == 0


@dataclass(frozen=True)
class ColumnLength(Rule):
    """All texts longer than ``gt`` or shorter than ``lt``; the metric is the extreme length."""

    gt: int | None = None
    lt: int | None = None

    def threshold(self) -> str:
        return f"> {self.gt}" if self.gt is not None else f"< {self.lt}"

    def metric(self, n_columns: int) -> Column:
        extreme = F.min if self.gt is not None else F.max
        return extreme(F.length(self.column)).cast("double")

    def verdict(self, metric: Column) -> Column:
        return metric > self.gt if self.gt is not None else metric < self.lt


@dataclass(frozen=True)
class Uniqueness(Rule):
    """Share of rows whose value occurs exactly once."""

    gt: float = 0.0

    def threshold(self) -> str:
        return f"> {self.gt}"

    def verdict(self, metric: Column) -> Column:
        return metric > self.gt


@dataclass(frozen=True)
class IsUnique(Uniqueness):
    def threshold(self) -> str:
        return "= 1"

    def verdict(self, metric: Column) -> Column:
        return metric == 1


@dataclass(frozen=True)
class ColumnCount(Rule):
    gt: int | None = None
    ge: int | None = None

    def threshold(self) -> str:
        return f"> {self.gt}" if self.gt is not None else f">= {self.ge}"

    def metric(self, n_columns: int) -> Column:
        return F.lit(float(n_columns))

    def verdict(self, metric: Column) -> Column:
        return metric > self.gt if self.gt is not None else metric >= self.ge


@dataclass(frozen=True)
class RowCount(Rule):
    gt: int = 0

    def threshold(self) -> str:
        return f"> {self.gt}"

    def metric(self, n_columns: int) -> Column:
        return _rows().cast("double")

    def verdict(self, metric: Column) -> Column:
        return metric > self.gt


# The named rulesets.
RULESETS: dict[str, tuple[Rule, ...]] = {
    "text_reviews": (
        IsComplete("review_content"),
        IsComplete("rating"),
        IsComplete("product_id"),
        IsComplete("user_id"),
        IsComplete("review_id"),
        ColumnValues("rating", 1, 5),
        ColumnLength("review_content", gt=10),
        ColumnLength("review_content", lt=10000),
        Uniqueness("review_id", 0.85),
        IsComplete("review_title"),
        Completeness("user_name", 0.80),
        Completeness("product_name", 0.95),
        ColumnCount(gt=10),
    ),
    "surveys": (
        ColumnCount(ge=3),
        RowCount(gt=0),
        Completeness("response_id", 0.99),
        IsUnique("response_id"),
    ),
    "deployed": (
        IsComplete("review_content"),
        IsComplete("rating"),
        IsComplete("product_id"),
        IsComplete("user_id"),
        ColumnValues("rating", 1.0, 5.0),
        ColumnLength("review_content", gt=10),
        Uniqueness("review_id", 0.85),
        IsComplete("review_title"),
        Completeness("user_name", 0.8),
    ),
    "documented": (
        IsComplete("review_content"),
        IsComplete("rating"),
        ColumnValues("rating", 1, 5),
        ColumnLength("review_content", gt=10),
        Uniqueness("review_id", 0.85),
        IsComplete("product_id"),
    ),
}


def _result(no: int, rule: Rule, metric: Column) -> Column:
    actual = metric.cast("double")
    return F.struct(
        F.lit(no).alias("rule_no"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.column).cast("string").alias("column_name"),
        F.round(actual, 6).alias("actual"),
        F.lit(rule.threshold()).alias("threshold"),
        F.coalesce(rule.verdict(actual), F.lit(False)).alias("passed"),
    )


def _as_rows(df: DataFrame, by: list[str], ruleset: str, results: list[Column]) -> DataFrame:
    exploded = df.select(*by, F.explode(F.array(*results)).alias("_r"))
    return exploded.select(*by, F.lit(ruleset).alias("ruleset"), "_r.*")


def evaluate(
    df: DataFrame, rules: Sequence[Rule] | str, name: str | None = None, by: str | Sequence[str] = ()
) -> DataFrame:
    """One row per rule (and group): metric, threshold and verdict. [DQ1-DQ10]

    All plain metrics share one aggregate; every uniqueness rule counts its
    values first. A rule on an unknown column fails instead of raising.
    """
    by = keys(by)
    if isinstance(rules, str):
        name, rules = name or rules, RULESETS[rules]
    name = name or "custom"
    n_columns = len([c for c in df.columns if c not in by]) if by else len(df.columns)
    plain = [
        (no, r)
        for no, r in enumerate(rules, 1)
        if not isinstance(r, Uniqueness) or r.column not in df.columns
    ]
    parts = []
    if plain:
        metrics = {
            no: F.lit(None).cast("double")
            if r.column is not None and r.column not in df.columns
            else r.metric(n_columns)
            for no, r in plain
        }
        totals = df.groupBy(*by).agg(_rows().alias("_rows"), *[m.alias(f"_m{no}") for no, m in metrics.items()])
        parts.append(_as_rows(totals, by, name, [_result(no, r, F.col(f"_m{no}")) for no, r in plain]))
    for no, r in enumerate(rules, 1):
        if isinstance(r, Uniqueness) and r.column in df.columns:
            parts.append(_as_rows(uniqueness(df, r.column, by), by, name, [_result(no, r, F.col("uniqueness"))]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def uniqueness(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose value occurs once, over all rows; nulls never count as unique. [DQ5]"""
    by = keys(by)
    counted = df.groupBy(*dict.fromkeys([*by, column])).agg(_rows().alias("_n"))
    once = F.count_if((F.col("_n") == 1) & F.col(column).isNotNull())
    return counted.groupBy(*by).agg(F.try_divide(once, F.sum("_n")).alias("uniqueness"))


def pass_rates(results: DataFrame, by: str | Sequence[str] = ("ruleset",)) -> DataFrame:
    """Rules passed and failed, and the passing share, per group. [DQ11]"""
    passed = F.count_if("passed")
    return results.groupBy(*keys(by)).agg(
        _rows().alias("rules"),
        passed.alias("passed_rules"),
        (_rows() - passed).alias("failed_rules"),
        F.round(passed / _rows(), 4).alias("pass_rate"),
    )
