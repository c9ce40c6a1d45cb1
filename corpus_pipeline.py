"""Training-corpus pipeline: five stages over the documents table, each written as Parquet and read again.

Every stage gets all rows that its predecessor kept.  All but the last return the columns of
``documents``: the classifier drops documents that score as toxic, the join keeps one document of each
component, decontamination drops documents that hold a benchmark item, mixing repeats or drops documents
to reach the source targets.  The last returns packed token rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.decontaminate import without_contaminated
from riskloom.llm.jaccard_join import one_per_component
from riskloom.llm.mixing import mixed_documents
from riskloom.llm.packing import pack
from riskloom.llm.state import checkpoint_folder
from riskloom.llm.toxicity import without_toxic


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", jaccard_join), ("benchmark_decontamination", decontamination),
          ("entropy_mixing", mixing), ("token_packing", packing)]

#: Stages fit a classifier and tokenise; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others' are Parquet files below the checkpoint folder."""
    folder = f"{checkpoint_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
