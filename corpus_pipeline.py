"""A training corpus from ``documents``: five stages, each on what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes every stage as Parquet to the shared folder
and reads it again as the next stage's documents, so lineage is cut and a lost
executor costs one stage's task. All stages but the last return the columns of
``documents``; the last gives a row for every repetition that the mix takes of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, line_dedup, mixing, near_dups, toxicity
from tablewright.llm.work import documents, freed, work_dir, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity models accept (the models are fitted on these documents' labels)."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_ordinary(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many documents of their source share."""
    out = line_dedup.drop_boilerplate_lines(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    found = near_dups.near_duplicates(docs, words=5, percent=80)
    gone = written(found.where("NOT kept").select(F.col("doc_id").alias("_gone")), work_dir(spark), "gone")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, none of those it takes nothing of."""
    return mixing.mix_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

# The toxicity stage is a fitted model; tests compare the later stages with brute force and SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    folder = work_dir(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with freed(spark):  # what the stage wrote for itself goes once its result is written
            docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
