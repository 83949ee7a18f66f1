"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet and read
again as the next stage's documents, which cuts lineage and survives lost executors. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import classifier, line_dedup, mixing, near_dup, packing
from feedlake.llm.common import Scratch, id_remainder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labels of `sf_dir`; those with crc32(doc_id) % 5 = 0 are left for tests.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier.fit(docs, labels, "quality", use=id_remainder("doc_id", 5) != 0)
    return _kept(docs, classifier.classify(docs, model), F.col("predicted") == 1)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of earlier ones; `n_chars` counts what is left."""
    out = line_dedup.dedup_lines(docs)
    chars = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*(chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id."""
    return _kept(docs, near_dup.near_duplicates(docs), F.col("kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with the probability of their source, language and topic."""
    return _kept(docs, mixing.mix_sources(docs), F.col("selected"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the training sequences."""
    return packing.pack(packing.cut(docs))


def _kept(docs: DataFrame, judged: DataFrame, condition: Column) -> DataFrame:
    return judged.filter(condition).select(*(F.col(f"`{c}`") for c in docs.columns))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-dup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL expresses one stage of five; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number + 1}")
    return docs
