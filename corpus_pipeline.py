"""The corpus pipeline: from raw documents to token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
reads again as the next one's documents. All but the last keep the columns of ``documents``, whatever
others there are; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.llm import decontaminate, mixing, simhash, token_files, toxicity
from railtide.llm.common import id_remainder, read_table
from railtide.session import scratch_path

# The model cannot be written in SQL, so the whole run cannot either.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sentence model, trained on the labelled ones, does not find toxic.

    A null or empty text stays; a null label or id trains nothing; without labels nearly all stay.
    """
    labels = read_table(spark, sf_dir, "labels").where("toxic is not null").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    seen = docs.select("doc_id", "text").where(id_remainder(5) != 0).join(labels, "doc_id")
    return toxicity.keep_clean(docs, toxicity.train(seen))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id, a null id last, ties by the
    hash of the text. Null and empty texts are copies of each other."""
    return simhash.keep_one(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows go or stay
    together; an empty benchmark removes nothing."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources as even as they can be without reading one more than twice.

    The budget is the smallest that reads the largest source once, so no document is left out;
    documents of small sources come up to twice. A null source is one of its own; null texts count as one
    token; repeated rows are rows of their own.
    """
    weights = mixing.source_weights(docs, repeats=2.0, cover=True)
    return mixing.readings(docs, weights).select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the token files. Null ids come
    first, null texts are empty, documents of one id follow each other by text."""
    return token_files.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", remove_toxic), ("simhash near-dedup", remove_near_copies), ("benchmark decontamination", remove_leaks),
    ("temperature mixing", mix_sources), ("token files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
