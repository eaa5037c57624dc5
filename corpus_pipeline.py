"""The corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
a DataFrame; ``run`` writes each result as Parquet in the shared folder that
``spark.checkpoint.dir`` names and reads it back as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import exact_dedup, mixing, packing, quality_gam, simhash_dedup
from tabwright.llm.common import read
from tabwright.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality_gam.quality_filter(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id."""
    return exact_dedup.exact_dedup(docs).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, at most 2 bits apart."""
    return simhash_dedup.simhash_dedup(docs, shingle=simhash_dedup.SHINGLE, radius=simhash_dedup.RADIUS).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, each as often as it is taken."""
    return mixing.mixed_rows(docs).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("simhash near-dedup", simhash_stage),
          ("mixing sources", mixing_stage), ("packing", packing_stage)]
#: The stages need trained scores, 64-bit fingerprints and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
