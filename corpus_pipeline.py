"""The corpus pipeline: language ID, near duplicates, benchmark contamination, personal data, pieces.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents, whatever these are, with the names and types they came with; the last returns token ids (32-bit integers in a row)
and digests. Rows are taken as they are: repeated rows, null ids and null columns other than text are no reason to drop one, but
for what the stage says; an empty table stays empty; columns may have the names that operators use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalscope.llm import decontamination, jaccard_join, language_id, pii, queries, sentencepiece_codec
from loyalscope.llm.common import bounded_batches, read, ship, written


def _ready(spark: SparkSession) -> None:
    ship(spark)
    bounded_batches(spark)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model accepts; null and empty texts and those without a letter go, and all if no row has a lang."""
    _ready(spark)
    model = language_id.train(docs.where(language_id.fold(F.col("doc_id"), 5) != 0))
    return language_id.accepted(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Texts without a word, and rows without an id,
    all stay; of rows repeated under one id one stays."""
    _ready(spark)
    return jaccard_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than a twentieth lie in windows of test items; texts without a word stay."""
    _ready(spark)
    return decontamination.uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by placeholders and n_chars, if there, brought in line; null texts stay null."""
    _ready(spark)
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids: a row for each document, null and empty texts have no ids."""
    _ready(spark)
    return sentencepiece_codec.digests(docs, queries.piece_model(), with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each),
    ("decontamination", uncontaminated),
    ("pii", without_personal_data),
    ("sentencepiece", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
