"""From raw documents to token ids, in five stages; each works on all that the one before it kept.

Between stages the documents are a written table in the shared folder, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import toxicity as toxic
from tallymark.llm.common import table
from tallymark.llm.decontamination import clean_documents
from tallymark.llm.mixing import mixed_documents
from tallymark.llm.near_dedup import distinct_documents
from tallymark.llm.tokens import token_digest
from tallymark.sources.scratch import write_through


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxic.civil_documents(docs, toxic.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the least id stays."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the weights of their sources ask for."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids are written to files; what is read back of them is returned: ``doc_id, start, n_tokens, ids_crc32``."""
    return token_digest(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token ids", token_ids),
]
ORACLE_SQL = None  # classifier, mix and tokenizer are beyond SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
