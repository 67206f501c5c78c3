"""A corpus pipeline: toxicity, line dedup, near-dedup, source mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``. An empty table stays empty through all stages;
the operators' docstrings say what they make of nulls, empty and long texts, ties, repeated rows and extra columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, mixing, simhash, toxicity
from tidemark.llm.common import checkpoint_dir, read_table
from tidemark.llm.queries import token_digests


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common lines stay only in the largest document that holds them; n_chars, where there is one, follows the text."""
    out = line_dedup.drop_common_lines(docs)
    counted = [c for c in docs.columns if c.lower() == "n_chars"]
    return out.withColumns({c: F.length("text").cast(docs.schema[c].dataType) for c in counted})


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    return token_digests(bpe.encode_decode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_common_lines),
    ("near dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("tokenizing", tokenize),
]

#: The classifier, the fingerprints and the tokenizer aren't SQL; tests/llm compare run()'s rows with plain Python.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again.

    A stage's folder goes when the next one is written; the last stays for the result to be read from.
    """
    docs, to = read_table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{to}/{k}")
            docs = spark.read.parquet(f"{to}/{k}")
            if k:
                _delete(spark, f"{to}/{k - 1}")
    return docs
