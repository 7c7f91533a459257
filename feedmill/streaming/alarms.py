"""Alarms on a stream of metric points: raised once, taken back once. [MET5, MET6]

Windows of a metric are closed by the watermark and go, in order, to one state
per rule: the last window, how many windows in a row have breached, and whether
the alarm is on. A window without points does not breach; while an alarm is on,
an event-time timer stands at the end of the next window, so the alarm ends
there even if no further point ever comes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from feedmill.operators.metrics import FAILED, FINAL_SCORE

# The processor travels with its tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = StructType(
    [StructField("rule", StringType()), StructField("status", StringType()), StructField("window_start", TimestampType())]
)
_STATE = StructType([StructField("last", LongType()), StructField("held", IntegerType()), StructField("on", BooleanType())])


@dataclass(frozen=True)
class Rule:
    """``breach`` is a condition on ``total``, ``average`` and ``points`` of a window of ``metric``."""

    name: str
    metric: str
    breach: str
    periods: int = 1


#: The thresholds of the two alarms.
RULES = (Rule("low-quality", FINAL_SCORE, "average < 70", 3), Rule("failures", FAILED, "total >= 3"))


def _stamp(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc)


class Watch(StatefulProcessor):
    """One rule's windows in order; times are milliseconds."""

    def __init__(self, step: int):
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watch", _STATE)

    def _get(self) -> tuple[int, int, bool]:
        return tuple(self.state.get()) if self.state.exists() else (0, 0, False)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, held, on = self._get()
        if on:
            self.handle.deleteTimer(last + 2 * self.step)
        # The windows of one micro-batch are few; those of later ones are later.
        for start, breach, periods in sorted((r["start"], r["breach"], r["periods"]) for r in rows):
            if start != last + self.step:
                if on:
                    yield Row(rule=key[0], status="OK", window_start=_stamp(last + self.step))
                held, on = 0, False
            held = held + 1 if breach else 0
            if held >= periods and not on:
                on = True
                yield Row(rule=key[0], status="ALARM", window_start=_stamp(start))
            elif on and not breach:
                on = False
                yield Row(rule=key[0], status="OK", window_start=_stamp(start))
            last = start
        self.state.update((last, held, on))
        if on:
            self.handle.registerTimer(last + 2 * self.step)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, _, on = self._get()
        if on:
            self.state.update((last, 0, False))
            yield Row(rule=key[0], status="OK", window_start=_stamp(last + self.step))

    def close(self) -> None:
        pass


def _met(rule: Rule) -> Column:
    return F.when(
        F.col("metric") == rule.metric,
        F.struct(F.lit(rule.name).alias("rule"), F.coalesce(F.expr(rule.breach), F.lit(False)).alias("breach"), F.lit(rule.periods).alias("periods")),
    )


def stream_alarms(points: DataFrame, rules: Sequence[Rule] = RULES, minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    """``rule, status, window_start``: ALARM at the window that completes a run of breaches, OK at the first window after it.

    ``points`` hold ``ts, metric, value``; points later than ``delay`` are
    dropped, as on the dashboard. Start the result with ``state_store`` around it.
    """
    timed = points.filter(F.col("metric").isin(*{r.metric for r in rules})).withColumn("ts", F.col("ts").cast("timestamp"))
    total = F.sum(F.col("value").cast("decimal(28,8)")).cast("double")
    series = timed.withWatermark("ts", delay).groupBy(F.window("ts", f"{minutes} minutes").alias("window"), "metric").agg(
        F.count("value").alias("points"), total.alias("total")
    )
    series = series.withColumn("average", F.col("total") / F.col("points")).withColumn("at", F.window_time("window"))
    met = series.select("at", F.unix_millis("window.start").alias("start"), F.explode(F.array_compact(F.array(*map(_met, rules)))).alias("_r"))
    watched = met.select("at", "start", "_r.*").groupBy("rule")
    return watched.transformWithState(Watch(minutes * 60_000), OUTPUT, "Append", "EventTime")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for queries started inside."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, old)
