"""Annotators trained on labelled texts, beside the word lists. [NLP4, NLP5]

Language: each language has a profile, its most frequent runs of three
characters with their log probabilities, as a table. A text's runs are joined
with the profiles and summed in log space; runs that no profile has cost every
language its floor. Profiles are bounded by languages times ``PROFILE``.

Sentiment: logistic regression over hashed words. Gradients are summed on the
executors, one weight vector goes out and comes back per step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators.ordering import deal_rows, first_k
from feedmill.session import shared_dir

#: Characters of a run, and runs kept for a language.
RUN, PROFILE = 3, 2000
FEATURES = 1 << 16
#: Chances of a positive text from which a label is given.
POSITIVE, NEGATIVE = 0.6, 0.4


#: Texts whose runs are handed on together.
_TEXTS = 256
#: Stands for all runs of a text.
EVERY = ""


def _letters(text: Column) -> Column:
    """The words of a text, one blank between and around them; null for a null text."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def _counted(rows: DataFrame, by: str, text: str) -> DataFrame:
    """``by, run, n``: all runs of ``RUN`` characters of the words of a text, blanks included.

    Runs are counted inside a text before they become rows; a value of ``by``
    may come several times. The run ``EVERY`` counts all runs of a text that has any.
    """
    size, texts, every = RUN, _TEXTS, EVERY

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, texts):
                part = batch.slice(start, texts)
                own = [Counter([t[i : i + size] for i in range(len(t) - size + 1)]) for t in part.column(1).to_pylist()]
                pairs = [[*c.items(), (every, c.total())] if c else [] for c in own]
                found = pa.array(pairs, pa.map_(pa.string(), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), found], names=["by", "runs"])

    words = deal_rows(rows.filter(F.col(text).isNotNull()), *rows.columns).select(F.col(by), _letters(F.col(text)).alias("_words"))
    schema = T.StructType([T.StructField("by", words.schema[by].dataType), T.StructField("runs", T.MapType(T.StringType(), T.LongType()))])
    return words.mapInArrow(count, schema).select(F.col("by").alias(by), F.explode("runs").alias("run", "n"))


def language_profiles(rows: DataFrame, text: str = "text", lang: str = "lang", most: int = PROFILE) -> DataFrame:
    """``lang, run, gain, floor``: log probability of each run over that of an unknown one, which is ``floor``.

    One count is added to each run, the unknown one included.
    """
    known = rows.filter(F.col(lang).isNotNull()).withColumnRenamed(lang, "lang")
    counts = _counted(known, "lang", text).groupBy("lang", "run").agg(F.sum("n").alias("n"))
    # The count of all runs comes first, so one pass over the texts gives it and the most frequent ones.
    order = [F.col("run") != EVERY, F.desc("n"), F.asc("run")]
    top = first_k(counts, "lang", order, most + 1, "_rank")
    top = top.withColumn("_all", F.first("n").over(Window.partitionBy("lang").orderBy("_rank"))).filter(F.col("_rank") > 1)
    return top.select("lang", "run", F.log(F.col("n") + F.lit(1.0)).alias("gain"), (-F.log(F.col("_all") + F.lit(float(most + 1)))).alias("floor"))


def detect_language(rows: DataFrame, profiles: DataFrame, key: str, text: str = "text", default: str = "en") -> DataFrame:
    """``key, language``: the language of highest probability for each text, of equal ones the first; texts without letters get ``default``.

    Only texts, keys and sums are moved; a task adds up its texts before the shuffle.
    """
    counts = _counted(rows.select(key, text), key, text)
    # All runs of a text cost a language its floor; texts and profiles are each read once.
    cells = F.array(F.struct("lang", "run", "gain"), F.struct("lang", F.lit(EVERY).alias("run"), F.col("floor").alias("gain")))
    costs = profiles.select(F.explode(cells).alias("_c")).select("_c.*").distinct()
    cost, every = F.col("n") * F.col("gain"), F.col("run") == EVERY
    sums = counts.join(F.broadcast(costs), "run").groupBy(key, "lang").agg(
        F.sum(F.when(~every, cost)).alias("_gain"), F.sum(F.when(every, cost)).alias("_floor")
    )
    # A language that shares no run with the text is none.
    scored = sums.filter("_gain is not null").withColumn("_score", F.round(F.col("_gain") + F.col("_floor"), 6))
    best = scored.groupBy(key).agg(F.min_by("lang", F.struct(-F.col("_score"), "lang")).alias("language"))
    return rows.select(key).distinct().join(best, key, "left").select(key, F.coalesce("language", F.lit(default)).alias("language"))


@dataclass(frozen=True)
class Sentiment:
    """A trained model; ``save`` and ``load`` keep its weights in a table."""

    model: PipelineModel

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> "Sentiment":
        return Sentiment(PipelineModel.load(path))

    def annotate(self, segments: DataFrame, text: str = "segment") -> DataFrame:
        """Adds ``label``, ``scores`` and ``error`` as ``annotate_sentiment`` does; blank texts are neutral."""
        names = segments.columns
        done = self.model.transform(segments.withColumn("_text", F.coalesce(text, F.lit(""))))
        blank = F.size("_words") == 0
        chance = F.when(~blank, vector_to_array("_chance")[1])
        label = F.when(chance >= POSITIVE, "POSITIVE").when(chance <= NEGATIVE, "NEGATIVE").otherwise("NEUTRAL")
        # The middle of the scale is neutral, the ends are not.
        middle = F.when(blank, 1.0).otherwise(1.0 - F.abs(2.0 * chance - 1.0))
        scores = F.struct(
            (F.coalesce(chance, F.lit(0.0)) * (1.0 - middle)).alias("Positive"),
            ((1.0 - F.coalesce(chance, F.lit(1.0))) * (1.0 - middle)).alias("Negative"),
            middle.alias("Neutral"),
            F.lit(0.0).alias("Mixed"),
        )
        return done.select(*names, label.alias("label"), scores.alias("scores"), F.lit(None).cast("string").alias("error"))


def train_sentiment(rows: DataFrame, text: str = "text", positive: str = "positive", features: int = FEATURES, steps: int = 40, prior: float = 1e-3) -> Sentiment:
    """Fit on all rows with a text and a ``positive`` of 0 or 1."""
    known = rows.filter(F.col(text).isNotNull() & F.col(positive).isNotNull())
    known = known.select(F.col(text).alias("_text"), F.col(positive).cast("double").alias("_label"))
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+")
    hashed = HashingTF(inputCol="_words", outputCol="_features", numFeatures=features, binary=True)
    fit = LogisticRegression(
        featuresCol="_features", labelCol="_label", probabilityCol="_chance", rawPredictionCol="_raw", predictionCol="_prediction",
        maxIter=steps, regParam=prior,
    )
    # A model just fitted holds its session, which no task can take once a counter was observed in it; a stored one does not.
    path = shared_dir(rows.sparkSession, "sentiment")
    Sentiment(Pipeline(stages=[words, hashed, fit]).fit(known)).save(path)
    return Sentiment.load(path)
