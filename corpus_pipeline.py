"""A training-data pipeline of five stages, each a table in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.llm import cpsjoin, decontam, gam, langid, spm
from cindergrid.llm.common import drop, id_remainder, scratch, stash, table
from cindergrid.llm.queries import PIECES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more. It learns from labels outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 4) != 2)
    return gam.keep_good(docs, gam.learn(docs, labels.select("doc_id", F.col("quality").alias("label"))))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told with a score of 0.5 or more."""
    return langid.keep_known(docs, langid.learn(docs.filter(id_remainder("doc_id", 3) != 1)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return cpsjoin.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows, without the hit runs of 13 words
    and more that they have."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), cut_words=13)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with whether they decode to its text."""
    back = spm.round_trip(docs, PIECES)
    return back.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))


STAGES = [
    ("quality classifier", quality),
    ("language id", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("sentencepiece", pieces),
]

#: The stages learn and iterate, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table. What a stage wrote on its way, and what it read, goes once its own table stands."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch() as made:
            docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop(spark, before + made[:-1])
        before = made[-1:]
    return docs
