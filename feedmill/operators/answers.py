"""Model answers kept by the digest of their request, so that no request is paid for twice. [PRM8]"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators.dialogs import call_model
from feedmill.sinks.runs import read_runs, write_run

ANSWERS = "digest string, response string, error string, at timestamp"
#: Failed calls of one request before it rests, and how long it rests.
TRIES, REST = 3, "1 hour"


def stored_caller(path: str, tries: int = TRIES, rest: str = REST) -> Callable[..., DataFrame]:
    """A ``call_model`` that asks only what the table at ``path`` does not answer, for ``run_dialog(call=...)``.

    Equal requests are asked once. A request that failed is asked again, but
    after ``tries`` failures in a row only when the last one is ``rest`` ago. Answers are
    stored before they are used; a crash loses those of the running call only.
    """

    def call(df: DataFrame, fn: Callable[[list[str]], list], batch: int = 25) -> DataFrame:
        spark = df.sparkSession
        asked = df.withColumn("_digest", F.sha2("request", 256))
        # The newest success wins; without one, failures are counted.
        stored = read_runs(spark, path, ANSWERS)
        known = stored.groupBy("digest").agg(
            F.max_by("response", F.when(F.col("error").isNull(), F.col("at"))).alias("response"),
            F.count_if(F.col("error").isNull()).alias("_good"),
            F.count_if(F.col("error").isNotNull()).alias("_bad"),
            F.max_by("error", F.col("at")).alias("error"),
            F.max("at").alias("_last"),
        )
        resting = (F.col("_bad") >= tries) & (F.col("_last") > F.current_timestamp() - F.expr(f"interval {rest}"))
        settled = known.filter((F.col("_good") > 0) | resting).select("digest")
        wanted = asked.filter("request is not null").select(F.col("_digest").alias("digest"), "request").dropDuplicates(["digest"])
        open_ = wanted.join(settled, "digest", "left_anti")
        answered = call_model(open_, fn, batch).select("digest", "response", "error", F.current_timestamp().alias("at"))
        fresh = write_run(answered, path, uuid.uuid4().hex).withColumnRenamed("at", "_last")
        # The failures of a resting request are its answer for now.
        old = known.join(settled, "digest", "left_semi").select(
            "digest", "response", F.when(F.col("_good") == 0, F.col("error")).alias("error"), "_last"
        )
        answers = old.unionByName(fresh).groupBy("digest").agg(F.max_by(F.struct("response", "error"), "_last").alias("_a"))
        joined = asked.join(answers, F.col("_digest") == F.col("digest"), "left")
        return joined.select(*df.columns, F.col("_a.response").alias("response"), F.col("_a.error").alias("error"))

    return call
