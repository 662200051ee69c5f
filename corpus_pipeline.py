"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
is written as Parquet and read again before the next one.  All but the last return the
columns of ``documents``, whatever others and however named it has.

Each stage judges a row by its text (near duplicates: by all rows' texts), so rows with a
NULL id are judged like any other and rows that repeat share their fate, but for the near
duplicates, of which one row stays.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billing_guard.llm import decontaminate, jaccard, langid, packing, toxicity
from billing_guard.llm.common import share_package, table, written

TOXIC_FROM = 0.3
#: The least mean probability of the predicted language: below it no language is likely.
LANGUAGE_FROM = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores below ``TOXIC_FROM``.

    NULL and empty texts match no pattern and stay; labels of a NULL id teach nothing.
    """
    share_package(spark)
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(F.struct("*").alias("row"), toxicity.score_column(grammar, F.col("text")).alias("score"))
    return scored.where(F.col("score") < TOXIC_FROM).select("row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language the network can tell.

    NULL texts and texts without a letter go; without any label to learn from all rows stay.
    """
    share_package(spark)
    net = langid.fit(docs)
    if net is None:
        return docs
    found = docs.select(F.struct("*").alias("row"), langid.language_column(net, F.col("text")).alias("language"))
    known = ((F.col("language.lang_pred") != langid.UNDETERMINED)
             & (F.col("language.score") >= LANGUAGE_FROM))
    return found.where(known).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id (a NULL id
    comes last).

    NULL, empty and blank texts are near nothing and stay; of rows with equal id and text
    one stays, the first by its other columns.
    """
    share_package(spark)
    return jaccard.keep_one_of_each_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item; NULL and wordless texts stay."""
    share_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in training sequences; a NULL text is empty and has the place
    of its end id, and rows that repeat are packed each."""
    share_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: No stage but the near-duplicate join is expressible in SQL; tests/llm compares the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
