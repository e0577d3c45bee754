"""Shards and languages worked out again in plain Python."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loyalscope.llm import language_id, queries, sharding

TEST = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def hashed(*parts):
    """Spark's xxhash64 of strings: each one's hash is the seed of the next."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed


def drawn(key, node):
    while node.shard is None:
        draws = [(-math.log(((hashed(key, c.name) >> 12) + 0.5) / 2.0**52) / c.weight, i) for i, c in enumerate(node.children)]
        node = node.children[min(draws)[1]]
    return node.shard


def test_shards_are_those_of_the_tree_drawn_by_hand(spark):
    docs = spark.read.parquet(f"{TEST}/documents.parquet").select("doc_id", "text").collect()
    tree = sharding.even_tree(queries.SHARDS)
    bigger = sharding.grown(tree, queries.SHARDS)
    rows = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()), drawn(str(r.doc_id), tree), drawn(str(r.doc_id), bigger),
             (hashed(str(r.doc_id), "slot") - (1 << 64 if hashed(str(r.doc_id), "slot") >> 63 else 0)) % sharding.BUCKETS) for r in docs]
    want, taken = {}, Counter()
    for doc_id, size, crc, shard, grown, _ in sorted(rows, key=lambda r: (r[3], r[5], r[0], r[2], r[1])):
        want[doc_id] = (size, crc, "key", shard, taken[shard], grown)
        taken[shard] += 1
    got = {r.doc_id: (r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in queries.op4_sharding(spark, TEST).collect()}
    assert got == want


def scored(text, model):
    """Probabilities by the definition: the mean of the vectors of all subwords, a linear layer, a softmax."""
    raw = bytes(b if b >= 128 else b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in text.encode())
    total, n = np.zeros(language_id.DIMENSIONS), 0
    for at, size in enumerate(language_id.SIZES):
        for i in range(len(raw) - size + 1):
            key = int.from_bytes(raw[i : i + size], "little")
            total += model.vectors[at][(key * 2654435761 & 0xFFFFFFFF) >> (32 - language_id.BITS)]
            n += 1
    z = (model.weights @ (total / max(1, n)) + model.bias) / model.temperature
    e = np.exp(z - z.max())
    return e / e.sum()


def test_languages_are_those_of_the_softmax_worked_out_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train(docs.where(language_id.fold(F.col("doc_id"), 5) != 0))
    rows = language_id.identify(docs.where("length(text) < 3000"), model).collect()
    assert len(rows) > 80
    for r in rows:
        p = scored(r.text, model)
        assert r.score == pytest.approx(p.max(), abs=1e-4) and r.lang_pred == model.languages[int(p.argmax())]
        assert r.accepted == (r.score >= model.threshold)


def test_every_label_is_learned_and_two_can_be_rejected(spark):
    letters = "abcdefghijklmnopqrst"
    rows = []
    for k in range(230):
        word = letters[k % 20] + letters[k // 20] + "xyz"[k % 3]
        rows += [(len(rows) + i, f"{word} {word}{word} " * 8, f"label{k}") for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = Counter(r.lang for r in language_id.labelled_sample(docs, 500).collect())
    assert len(sample) == 230 and min(sample.values()) >= 8
    assert len(language_id.train(docs, sample=500, epochs=1).languages) == 230
    two = language_id.train(docs.where("lang IN ('label1', 'label200')"))
    assert two.threshold > 0.5 and language_id.accepted(docs.where("lang = 'label1'"), two).count() == 25


def test_learned_redactions_reach_the_pipeline_s_stage(spark):
    """A looser span that only the trees know is replaced as well."""
    import random

    import corpus_pipeline
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    rows = [(i, f"{word()} {word()} please write to {word()}{i}@{word()}.example.com {word()} {word()} and {word()} again", "en") for i in range(1500)]
    rows += [(5000 + i, f"{word()} {word()} please write to {word()} (at) {word()} (dot) example (dot) com {word()} {word()}", "en") for i in range(40)]
    rows += [(6000 + i, f"{word()} {word()} we met at the {word()} and {word()} dot {word()}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n_chars", F.length("text").cast("long"))
    clean = {r.doc_id: r for r in corpus_pipeline.without_personal_data(spark, docs, SMALL).collect()}
    assert all("<EMAIL>" in clean[i].text and "@" not in clean[i].text for i in range(1500))
    assert sum("<EMAIL>" in clean[5000 + i].text for i in range(40)) >= 30
    texts = {r[0]: r[1] for r in rows}
    assert all(clean[6000 + i].text == texts[6000 + i] for i in range(40)) and all(r.n_chars == len(r.text) for r in clean.values())
    assert len(clean) == len(rows)
