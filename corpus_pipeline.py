"""A training-data pipeline over ``documents``: each stage works on what the one before it kept.

Defined results of every stage: NULL counts as empty text; a NULL id is kept like any other and comes last where ids are
compared; ties and repeated rows as the operator of the stage says; an empty table gives no rows; further columns keep
their values, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import drop, materialise, scratch
from tidemark.llm import mixing, pieces, quality, simhash, trie
from tidemark.llm.text import id_remainder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def filtering(stage: Stage) -> Stage:
    """Returns the columns of the documents. Further ones go by neutral names meanwhile, since an operator replaces
    those that are named like its results."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        further = {c: f"further_{n}" for n, c in enumerate(docs.columns) if c not in OWN}
        kept = stage(spark, docs.select(*[F.col(f"`{c}`").alias(further.get(c, c)) for c in docs.columns]), sf_dir)
        return kept.select(*[F.col(further.get(c, c)).alias(c) for c in docs.columns])

    return run_stage


@filtering
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels outside the held-out third."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, learn=id_remainder(F.col("doc_id"), 3) != 1)
    return quality.score(docs, model).filter("predicted = 1")


@filtering
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return trie.deduplicate(docs, largest=True)


@filtering
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with linked fingerprints (four-word shingles, four bits) the row with the smallest id."""
    return simhash.keep_one(docs)


@filtering
def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. The one document of a source at which its quota ends counts as taken
    once more if at least half of it is."""
    mixed = mixing.mix(docs)
    rest = F.col("taken") % F.greatest(F.col("size"), F.lit(1))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size")) + F.when(2 * rest >= F.col("size"), 1).otherwise(0))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long")))
    return mixed.filter((F.col("size") > 0) & (times >= 1)).select("*", copies.alias("copy"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether they decode to its text."""
    done = pieces.round_trip(docs, pieces.default_model(spark))
    return done.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", target_mix),
    ("tokenize", token_ids),
]

#: The classifier, the fingerprints and the pieces have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stores goes when its result is written, and that when the next one's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            written = materialise(stage(spark, docs, sf_dir), name, outlives=True)
        if before is not None:
            drop(before)
        docs = before = written
    return STAGES[-1][1](spark, docs, sf_dir)
