"""A corpus pipeline of five operators: reject toxic documents, remove repeated lines, keep one of each group of
near duplicates, drop documents contaminated by the benchmark, and mix the sources to target weights.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and hands it, read again, to the next one. All but the last return the columns of ``documents``. Empty
tables, null and empty texts, repeated rows and extra columns (of any name) pass through every stage as its
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidesync.llm import decontaminate, line_dedup, mixing, simhash
from tidesync.llm import toxicity as tox
from tidesync.llm.text import carried, restored, table
from tidesync.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict as toxic. It is trained on labelled documents of this
    stage's input."""
    model = tox.train(docs, table(spark, sf_dir, "labels"))
    scored = tox.score_documents(carried(docs, "doc_id", "text"), model).filter("predicted = 0")
    return restored(scored, docs.columns, ["doc_id", "text"], [])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; a document that loses all its lines goes with them. ``n_chars`` is
    counted again where lines went."""
    done = line_dedup.remove_lines(carried(docs, "doc_id", "text")) \
        .filter((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" not in docs.columns:
        return restored(done, docs.columns, ["doc_id", "text"], [])
    before = F.col("carried_columns").getField("n_chars")
    counted = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(before)
    return restored(done.withColumn("n_chars", counted), docs.columns, ["doc_id", "text", "n_chars"], [])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of linked fingerprints."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``target`` and ``taken`` (words, repeats counted)."""
    return mixing.mix_documents(docs, mixing.WEIGHTS, mixing.EPOCHS)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix_sources),
]

# boosted trees have no form in SQL; the stages are tested one by one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
