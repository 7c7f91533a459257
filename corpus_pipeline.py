"""From raw documents to piece ids: rules, line dedup, near-dedup, mixing, encoding.

Each stage takes the session, the documents its predecessor kept and the folder
of the tables. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import line_dedup, mixing, pieces, quality, simhash
from feedmill.llm.common import store, table
from feedmill.llm.queries import PIECES

#: The fitted cutoffs and fingerprints have no counterpart in SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the certified cutoffs reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.judge(docs, labels).filter("_kept").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the line chunks of earlier ones; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those full of symbols have lower odds."""
    # A name that no column of the documents has.
    odds = "_odds" + "_" * max([0, *map(len, docs.columns)])
    weighed = docs.withColumn(odds, mixing.tidiness("text"))
    return mixing.repeat(mixing.mix(weighed, weights=[3.0, 1.0, 2.0], share=1.5, weight=odds)).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text again."""
    done = pieces.encode(docs, PIECES)
    round_trip = F.col("decoded") == F.coalesce("text", F.lit(""))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", round_trip.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage{i}")
    return docs
