"""A training-corpus pipeline over ``documents``: toxic documents go, one of
each group of near-duplicates stays, secrets are masked, sources are mixed to
their weights and the mix is packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. :func:`run` writes each stage's
result under the shared checkpoint folder and rereads it for the next.

Each stage reads whole texts of any length. Other columns than ``doc_id``,
``text`` and ``source`` pass through untouched, whatever their names; empty
tables stay empty; what a stage does with nulls, empty texts, ties and repeated
rows is said in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from petalframe.llm.common import ready, table
from petalframe.llm.op2_toxicity import drop_toxic, fit_toxicity
from petalframe.llm.op3_minhash import keep_one
from petalframe.llm.op8_packing import pack_documents
from petalframe.llm.op9_secrets import redact_secrets
from petalframe.llm.op10_mixing import mix_documents
from petalframe.session import delete_folder, scratch, work_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not call toxic. A null or
    empty text is scored like any other; equal texts get equal scores; a null id is
    scored and belongs to no label."""
    ready(spark)
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked at 80 % of its five-word
    shingles. Texts without words are linked with nothing and stay; rows of a null id
    stay; of several rows of one id one stays, the same at every run."""
    ready(spark)
    return keep_one(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked, ``n_chars`` adjusted; a null text
    stays null, every row stays."""
    ready(spark)
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of weighted sources takes them. A null or empty
    text is never taken; a null source is one of its own, ranked last; equal rows are
    decided together."""
    ready(spark)
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed token pieces. A null or empty text is its end id; every row is
    a document of its own."""
    ready(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near-duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Classifier, token ids and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``. Tables that a stage writes for itself go once
    its result is written, a stage's result once the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        kept = work_dir(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(kept)
        docs = spark.read.parquet(kept)
        if before:
            delete_folder(spark, before)
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
