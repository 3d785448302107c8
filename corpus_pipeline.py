"""A training corpus from the documents: judged, deduplicated, mixed and encoded.

Every stage works on all rows the one before kept, is written as Parquet and read
again.  Rejected documents, and all but one of each group of near copies, are gone
for later stages.  All stages but the last return the columns of ``documents``.

Null and empty texts fail the base check of the rules and go; a null language or source
is a node of its own in the mix.  Texts of any length are read whole; bytes that are no
UTF-8 are judged and encoded as the replacement character.  Of rows with equal
fingerprints the smallest id stays, null ids last; of several rows with that id the one
of smallest hash, so of rows repeated in every column one stays.  A document that the mix
takes twice is two equal rows.  Extra columns stay until the last stage, which returns
``doc_id, lang, source, ids, n_tokens``; columns may have any name.  Without documents
every stage is empty; without labels the classifier gives all documents one score.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import byte_bpe, mixing, quality_classifier, quality_rules, simhash
from tidelog.llm.common import stored, table
from tidelog.llm.queries import BPE_RANKS, MIX_WEIGHTS, mix_levels


def pass_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and are probably good by the rules' votes."""
    return quality_rules.keep_good(docs)


def pass_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labelled documents outside the held-out fold.

    The labels are those of the whole table: the documents that the rules rejected
    are its best examples of bad ones.
    """
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(documents, labels, "quality", quality_classifier.training_rows())
    return quality_classifier.accept(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the budgets of their domain, language and source; a repeated epoch repeats the row."""
    return mixing.mix(docs, mix_levels(), MIX_WEIGHTS).select("_doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ids = byte_bpe.encode(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    return ids.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality rules", pass_rules),
    ("quality classifier", pass_classifier),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: No SQL: the votes' estimate, the trained classifier and BPE cannot be written in it.  Tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return docs
