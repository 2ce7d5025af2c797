"""From raw documents to packed training sequences.

Each stage reads what its predecessor kept, as Parquet, and its decisions take
effect. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sightline.llm import decontaminate as D
from sightline.llm import langid, minhash, packing
from sightline.llm.shared import write_once

LEAST_SURE = 0.3  # two even duels (family, language) give 0.25
BATCH_ROWS = 1024  # documents handed to Python at a time


def small_batches(stage):
    """Whole documents go to Python in batches of at most ``BATCH_ROWS`` rows: Spark
    holds a batch outside its heap several times over. The stage sets this for the
    session, unless the session asks for less; results do not depend on it."""
    @wraps(stage)
    def run_stage(spark, docs, sf_dir):
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        now = int(spark.conf.get(key))
        if now <= 0 or now > BATCH_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return run_stage


@small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no recognisable language, go."""
    model = langid.train(docs, langid.learnable("doc_id", "lang"))
    return langid.accepted(docs, model, least=LEAST_SURE)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of smallest id."""
    return minhash.first_of_each(docs)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly such
    passages go."""
    return D.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@small_batches
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language identification", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", sequences),
]

# Language models, near-duplicate components and tokenizer ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
