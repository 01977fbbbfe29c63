"""From raw documents to token ids: quality, exact and near duplicates, mix of sources, BPE.

Each stage takes the documents its predecessor kept and returns documents; the last one returns their token ids. Documents
are rows of ``doc_id, text, lang, source`` and any further columns, which stay with their row, whatever their names. A null text
counts as empty, an empty table gives an empty table, texts of any length are used whole, and rows that are repeated as a whole
are one group of equal texts. What a stage stored on its way is removed when the next one begins, whose documents are stored
by then; a stage whose documents still read such a folder leaves it alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, exact_dedup, mixing, near_dedup, quality
from martloom.llm.common import col, materialize, read
from martloom.llm.queries import vocabulary
from martloom.session import drop_scratch, recorded_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Folders that stages of an application have stored on their way and that are still there.
_left: dict[str, list[str]] = {}


def _stage(build: Stage) -> Stage:
    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = _left.setdefault(spark.sparkContext.applicationId, [])
        files = docs.inputFiles() if left else []
        done = [p for p in left if not any(p in f for f in files)]
        if done:
            drop_scratch(spark, done)
        left[:] = [p for p in left if p not in done]
        with recorded_scratch() as paths:
            out = build(spark, docs, sf_dir)
        left += paths
        return out

    return run_stage


@_stage
def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality and toxic ones go. Those without a source or language count as of one unnamed each."""
    return quality.classify(docs, read(spark, sf_dir, "labels")).filter("kept").select(*map(col, docs.columns))


@_stage
def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays; null texts equal empty ones."""
    return exact_dedup.exact_groups(docs).filter("kept").select(*map(col, docs.columns))


@_stage
def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are linked by a similarity of 0.8 on five-word shingles, the one with the smallest id stays.

    Empty texts have no shingles and are linked with nothing.
    """
    return near_dedup.near_groups(docs, words=5, percent=80).filter("kept").select(*map(col, docs.columns))


@_stage
def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document. The one at a source's cut is taken whole; texts are not cut.

    Documents without words are never taken. Those without a source are a source of their own, the last.
    """
    mixed = mixing.mix(docs)
    copies = F.expr("CASE WHEN size > 0 THEN ceil(taken / size) ELSE 0 END").cast("int")
    return mixed.withColumn(" copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*map(col, docs.columns))


@_stage
def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, repeated ones included, and whether they decode to its text.

    A task decodes what it has encoded, so it has one Python worker; a second one would stay with its executor.
    """
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary("byte_bpe_50k.json"), decodes_col="decodes", keep_text=False)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decodes")


STAGES = [
    ("quality classifier", stage_quality),
    ("exact dedup", stage_exact),
    ("MinHash near-dedup", stage_near),
    ("mixing sources", stage_mix),
    ("BPE encoding", stage_bpe),
]

# A classifier, a hash-drawn mix and an encoder are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
