"""Cleaning of a text corpus in five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns the documents that go on; all but the
last return the columns of ``documents``. ``sf_dir`` holds the tables ``labels`` and
``benchmark`` which stages consult.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wavecount.llm import blob_ledger, decontamination, line_crf, piece_transducer, signature_trees
from wavecount.llm.common import read_table, visible_to_workers
from wavecount.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    visible_to_workers(spark)
    return line_crf.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles the smallest id stays."""
    visible_to_workers(spark)
    return signature_trees.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    visible_to_workers(spark)
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes."""
    visible_to_workers(spark)
    return blob_ledger.redact(docs, blob_ledger.new_ledger(spark))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids beside the documents; ``text`` is what they decode to."""
    visible_to_workers(spark)
    return piece_transducer.with_ids(docs, piece_transducer.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_similar),
    ("decontamination", keep_uncontaminated),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

#: SQL can express neither the trained classifier nor the components of near copies.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
