"""The corpus pipeline: language ID, near-dedup, suffix-array dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's result as Parquet in the shared
checkpoint folder and reads it back as the next one's input.

Nulls: a null or letterless text has no language and goes in the first stage; nulls in other columns stay
(a null source is a source like others). Repeated rows and ids are documents of their own: near-dedup
keeps one of equal texts. Texts of any length pass whole. An empty table gives no row in every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wharf.llm.common import ready
from wharf.llm.langid import label, train
from wharf.llm.mixing import mixed_documents
from wharf.llm.neardup import keep_one
from wharf.llm.packing import pack, pieces
from wharf.llm.queries import tokenizer_path
from wharf.llm.suffix_dedup import without_repeats

# A document is rejected if the network sees no letter in it, or no language in the better part of it.
LEAST_SCORE = 0.4
# Bytes of a repeated string that go: fewer than a passage of more than 50 words has (271 at least, measured
# on the benchmark passages of the given tables), more than lines that clean documents share.
PASSAGE = 200


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network names (``und`` and scores under LEAST_SCORE go)."""
    columns = docs.columns
    kept = label(docs, train(docs)).where(f"lang_pred != 'und' AND score >= {LEAST_SCORE}")
    return kept.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return keep_one(docs, k=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of ``PASSAGE``-byte strings that start in more than one place."""
    return without_repeats(docs, length=PASSAGE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at target weights: documents and parts of documents, repeats included."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece, with its place (ids are checked by their CRC)."""
    return pack(pieces(docs, tokenizer_path())).drop("_hash")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models, hash signatures, suffix arrays and tokenizers are beyond SQL; tests/llm/test_pipeline.py
# holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
