"""The corpus pipeline: each stage calls one operator on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import langid, mixing, pii
from gridloom.llm.common import materialize, table
from gridloom.llm.packing import pack
from gridloom.llm.queries import tokenizer_path
from gridloom.llm.simhash import keep_one_per_group


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a text or a letter go. A document
    without a language gets the predicted one."""
    model = langid.learn(docs.select("doc_id", "text", "lang"))
    found = langid.identify(docs, model).where("lang_pred <> 'und'")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id."""
    return keep_one_per_group(docs, width=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    found = pii.candidates(docs)
    model = pii.fit(pii.spans(found.where(F.size("found") > 0)))
    return pii.redact(docs, model).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for, at least once and at most
    twice, in blocks that hold the sources in their weights."""
    return mixing.repeat_documents(docs, max_repetition=2.0, block_tokens=250_000, seed=42)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, in sequences of 4096, in the order in which
    the documents are read: the mixture's blocks follow each other."""
    return pack(docs, tokenizer_path(), length=4096, end_id=2, with_ids=True)


STAGES = [
    ("language identification", language),
    ("simhash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("source mixing", mixture),
    ("packing", packing),
]

#: Neither language models, components nor token ids can be written in SQL; the pipeline is
#: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
