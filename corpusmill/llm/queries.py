"""The registered queries of the training-data operators, one each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import exact, manifest, maxent, minhash, mixing, oracles, packing, pii, quality, repair, simhash, tokens, urls, warc
from corpusmill.llm.common import table

LIMIT, END_ID = 1024, 2
VOCABULARY = "byte_bpe_50k.json"
URL_RULES = (
    urls.UrlRule("allow", "org/"), urls.UrlRule("block", "example.org/es/"), urls.UrlRule("block", "example.org/en/1"),
    urls.UrlRule("allow", "com/fr/"), urls.UrlRule("block", "com/de/"),
)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary(), LIMIT)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base_spans"), k.name).alias(f"n_{k.name}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base_spans")), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), LIMIT, END_ID)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.scratch(spark)
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.assemble(warc.read_records(spark, path))).withColumnRenamed("capture_id", "page_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_lm_scores, op3_personal_data, op4_simhash, op5_quality, op6_packing, op7_warc, op8_mixing,
        op9_url_filter, op10_exact_dedup, op11_manifest, op12_minhash, op13_repair, pipeline,
    )
}
# Tests hold the other operators against brute force.
ORACLES: dict[str, str] = {
    "op5_quality": oracles.quality_rules(), "op7_warc": oracles.warc(), "op10_exact_dedup": oracles.exact_dedup(),
    "op11_manifest": oracles.merkle(), "op13_repair": oracles.conversation_repair(),
}
