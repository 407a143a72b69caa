"""One registered query per operator, over its whole table, with oracle SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, centroids, chat, decontaminate, divergence, licenses, order_minhash, quality, secret_scan, simhash, token_blocks, urls, warc
from tickloom.llm.common import new_folder, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op6_bpe")
def op6_bpe(spark, sf):
    coded = bpe.round_trip(table(spark, sf, "documents"), BPE_RANKS, public_tokenizers.PATTERN)
    return bpe.digests(coded)


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op9_token_blocks")
def op9_token_blocks(spark, sf):
    folder = new_folder(spark)
    token_blocks.write(table(spark, sf, "documents"), folder, WORD_BPE, end_id=2)
    return token_blocks.digests(token_blocks.read(spark, folder))


@query("op5_simhash")
def op5_simhash(spark, sf):
    found = simhash.groups(table(spark, sf, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_quality")
def op8_quality(spark, sf):
    docs = table(spark, sf, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf, "labels")))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@query("op2_decontaminate", decontaminate.sql())
def op2_decontaminate(spark, sf):
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return decontaminate.digests(found)


@query("op7_order_minhash")
def op7_order_minhash(spark, sf):
    return order_minhash.digests(order_minhash.compare(table(spark, sf, "documents")))


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query("op3_chat")
def op3_chat(spark, sf):
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.round_trip(rows.unionByName(more), BYTE_BPE)


# The pages carry no date of their own.
FETCHED = "1970-01-01T00:00:00Z"


@query("op10_warc", warc.sql(FETCHED))
def op10_warc(spark, sf):
    return warc.derive(warc.responses(table(spark, sf, "pages"), FETCHED), "page_id")


@query("op1_licenses", licenses.sql())
def op1_licenses(spark, sf):
    return licenses.digests(licenses.scan(table(spark, sf, "documents")))


URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


@query("op4_urls")
def op4_urls(spark, sf):
    pages = table(spark, sf, "pages")
    # Labelled URLs: those of sampled pages whose text a classifier, trained on the labelled documents, judges.
    good = quality.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    read = urls.sampled(pages.select("url", "html"), "html")
    read = stored(read.select(F.xxhash64("url").alias("doc_id"), "url", warc.plain_text(F.col("html")).alias("text")))
    verdict = F.when(F.col("score") >= quality.THRESHOLD, urls.ALLOW).otherwise(urls.BLOCK)
    labelled = quality.score(read, good).join(read.select("doc_id", "url"), "doc_id").select("url", verdict.alias("verdict"))
    return urls.judge(pages, URL_RULES, urls.fit(stored(labelled)))


@query("op12_centroids", centroids.sql())
def op12_centroids(spark, sf):
    return centroids.clusters(table(spark, sf, "embeddings"))


@query("op11_source_divergence", divergence.sql())
def op11_source_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


@query("op13_secrets")
def op13_secrets(spark, sf):
    return secret_scan.digests(secret_scan.scan(table(spark, sf, "documents")))
