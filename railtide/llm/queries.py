"""One query per operator of this package, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from railtide.llm import language_id, toxicity
from railtide.llm.common import id_remainder, read_table
from railtide.llm.decontaminate import find_leaks
from railtide.llm.exact_dedup import exact_dedup
from railtide.llm.filter_audit import audit, failures
from railtide.llm.hidden_markov import score_texts
from railtide.llm.mixing import schedule, source_weights
from railtide.llm.resampling import resample
from railtide.llm.sharding import shard_rows
from railtide.llm.simhash import near_duplicates
from railtide.llm.token_files import token_table
from railtide.llm.url_lists import evaluate, url_host
from railtide.llm.vector_dedup import near_vectors

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_hidden_markov(spark, sf):
    docs = read_table(spark, sf, "documents")
    return score_texts(docs.withColumn("held_out", id_remainder(10) == 0))


@query
def op2_toxicity(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    seen = docs.where(id_remainder(5) != 0).join(labels.where("toxic is not null"), "doc_id")
    return toxicity.score_texts(docs, toxicity.train(seen)).select(
        "doc_id", (id_remainder(5) == 0).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("offending").alias("n_offending"),
        "worst_start", "worst_stop", "worst_score")


@query
def op3_language_id(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(id_remainder(4) != 2))
    return language_id.predict(docs, model).select(
        "doc_id", (id_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op4_temperature_mixing(spark, sf):
    """Every reading of every document at weights with 97 % of the entropy of equal ones, but no
    source more than four times; the budget is the number of tokens there are."""
    docs = read_table(spark, sf, "documents")
    weights = source_weights(docs, entropy_part=0.97, repeats=4.0)
    return schedule(docs.select("doc_id", "source", "text"), weights).select(
        "doc_id", "source", "n_tokens", "exponent", "weight", "budget", "pass", "block", "block_rank", "start")


@query
def op5_simhash(spark, sf):
    return near_duplicates(read_table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op6_token_files(spark, sf):
    return token_table(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_rendezvous_sharding(spark, sf):
    return shard_rows(read_table(spark, sf, "documents"), 16)


@query
def op8_golomb_dedup(spark, sf):
    return exact_dedup(read_table(spark, sf, "documents"))


def dated_entries(pages):
    """List entries named after the hosts of the pages: for about a quarter of the hosts and their
    parent domains a block entry, later removed and for some added again, and some allow entries."""
    host = url_host(F.col("url"))
    parent = F.regexp_replace(host, r"^[^.]*\.", "")
    keys = pages.select(F.explode(F.array(host, F.when(parent.contains("."), parent))).alias("key")).dropna().distinct()
    digit = lambda place, width: F.conv(F.substring(F.md5(F.col("key").cast("binary")), place, width), 16, 10).cast("int")
    day = lambda n: F.date_add(F.lit("2023-07-01").cast("date"), n.cast("int"))
    first = digit(2, 4) % 400
    entry = lambda of, action, n: F.struct(
        F.lit(of).alias("list"), F.lit(action).alias("action"), day(n).alias("dated"))
    block = F.array(entry("block", "add", first), entry("block", "remove", first + 10 + digit(6, 4) % 200),
                    entry("block", "add", first + 10 + digit(6, 4) % 200 + digit(10, 4) % 150))
    allow = F.array(entry("allow", "add", digit(14, 4) % 500))
    chosen = F.when(digit(1, 1) < 4, block).when(digit(1, 1) < 6, allow)
    return keys.select("key", F.explode(chosen).alias("e")).select("e.list", "key", "e.dated", "e.action")


@query
def op9_url_lists(spark, sf):
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    captures = pages.withColumn(
        "fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 366).cast("int")))
    return evaluate(captures, dated_entries(pages))


@query
def op10_decontamination(spark, sf):
    """One row per document: the leaked item that is most alike, and how many there are."""
    found = find_leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    best = F.get("leaks", F.lit(0))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").alias("n_items"),
        F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"), best["item_id"].alias("item_id"),
        best["share"].alias("share"), best["answered"].alias("answered"))


@query
def op11_filter_audit(spark, sf):
    return audit(failures(read_table(spark, sf, "documents"), read_table(spark, sf, "labels")))


@query
def op12_vector_dedup(spark, sf):
    return near_vectors(read_table(spark, sf, "embeddings"))


@query
def op13_resampling(spark, sf):
    return resample(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
