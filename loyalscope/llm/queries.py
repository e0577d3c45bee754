"""One query for each operator of this subpackage, over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalscope.llm import decontamination, embedding_join, exact_dedup, jaccard_join, language_id, lexical_search, license_scan, periodic_runs, pii, pitman_yor, sentencepiece_codec, sharding, suffix_dedup
from loyalscope.llm.common import read

SHARDS = 40


def piece_model(path: str | None = None) -> bytes:
    """The vocabulary file of the public tokenizer, or another one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.link(read(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classify(read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(SHARDS)
    return sharding.shard_documents(read(spark, sf_dir, "documents"), tree, sharding.grown(tree, SHARDS))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = language_id.fold(F.col("doc_id"), 5) == 0
    model = language_id.train(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontamination.judge(docs, read(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.col("hit_items").cast("array<string>")))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(read(spark, sf_dir, "documents"), piece_model())


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of which, in one document of ten, a stretch from some word on is repeated to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find(docs, rewrite=planted_period).withColumn("best", periodic_runs.strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classify(read(spark, sf_dir, "documents"), digests=True).withColumnRenamed("digest", "text_sha256")


QUERIES = {f.__name__: f for f in (op1_embedding_join, op2_license_scan, op3_jaccard_join, op4_sharding, op5_pitman_yor, op6_suffix_dedup, op7_language_id, op8_decontamination, op9_pii, op10_sentencepiece, op11_lexical_search, op12_periodic_runs, op13_exact_dedup)}
ORACLES = {"op1_embedding_join": embedding_join.oracle(), "op2_license_scan": license_scan.oracle(), "op3_jaccard_join": jaccard_join.oracle(), "op8_decontamination": decontamination.oracle(), "op11_lexical_search": lexical_search.oracle(), "op13_exact_dedup": exact_dedup.oracle()}
