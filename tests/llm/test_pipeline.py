"""The pipeline against the operators' brute-force versions, stage by stage."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loyalscope.llm import language_id, pii, queries
from test_corpus_operators import brute_texts
from test_row_operators import brute_hits
from odd_rows import odd, nothing  # noqa: F401

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())


def test_run_equals_the_stages_by_brute_force(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train(frame.where(language_id.fold(F.col("doc_id"), 5) != 0))
    accepted = {r.doc_id for r in language_id.identify(frame, model).where("accepted").collect()}
    assert len(accepted) > 0.97 * len(docs)
    docs = {i: t for i, t in docs.items() if i in accepted}
    _, component = brute_texts(list(docs.items()))
    docs = {i: t for i, t in docs.items() if component[i] == i}
    for i in list(docs):
        words, hit, _ = brute_hits(docs[i], items)
        if hit and 20 * hit >= words:
            del docs[i]
    clean = {i: pii.redact_text(t, pii.strict_spans(t)) for i, t in docs.items()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == set(clean)
    for i, text in clean.items():
        ids = library.encode(text)
        assert np.frombuffer(bytes(got[i].token_ids), "<i4").tolist() == ids and got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_stages_take_odd_and_no_rows(spark, odd, nothing):
    frame = odd.withColumn("n_chars", F.length("text").cast("long"))
    for rows in (frame, nothing.withColumn("n_chars", F.lit(0).cast("long"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SMALL)
            assert name == "sentencepiece" or out.columns == rows.columns
            rows = out
        if rows.sparkSession:
            rows.count()
