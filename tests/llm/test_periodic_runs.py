"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalscope.llm import periodic_runs, queries
from odd_rows import odd, nothing  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least=24, exponent=3):
    """All stretches that agree with themselves q words on, for every q; of equal stretches the smallest q."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join("%d,%d,%d\n" % r for r in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = sorted(brute_row(r.doc_id, split(r.text)) for r in docs)
    assert sum(r[1] > 0 for r in want) > 10
    got = queries.op12_periodic_runs(spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for n, t in got.dtypes if "sha256" not in n} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("least", [3, 8, 24])
def test_random_rows(least):
    dice = random.Random(least)
    total = 0
    for _ in range(150):
        texts = []
        for _ in range(dice.randrange(1, 6)):
            words = [dice.randrange(dice.choice([1, 2, 30])) for _ in range(dice.choice([0, 1, 40, 150]))]
            base = [dice.randrange(dice.choice([1, 2, 9])) for _ in range(dice.randrange(1, 30))]
            words += (base * 12)[: dice.randrange(0, 250)] + words[-dice.randrange(1, 40) :] * dice.randrange(0, 5)
            texts.append(words)
        want = [brute_runs(t, least) for t in texts]
        total += sum(map(len, want))
        assert periodic_runs.runs_of([np.array(t, np.int32) for t in texts], 60, least) == want
    assert total > 300


def test_extensions_equal_plain_comparison():
    dice = np.random.default_rng(5)
    for names in (1, 2, 5):
        inner = [dice.integers(0, names, n) for n in (300, 1, 300)]
        row = np.concatenate([[names], inner[0], [names + 1], inner[1], [names + 2], inner[0], [names + 3]])
        grammar = periodic_runs.Grammar(row, names + 4)
        i = dice.integers(1, len(row) - 1, 500)
        j = dice.integers(1, len(row) - 1, 500)
        i, j = i[i != j], j[i != j]
        ahead, behind = grammar.ahead(i, j), grammar.behind(i, j)
        for a, b, f, g in zip(i, j, ahead, behind):
            assert (row[a : a + f] == row[b : b + f]).all() and row[a + f] != row[b + f]
            assert (row[a - g : a] == row[b - g : b]).all() and row[a - g - 1] != row[b - g - 1]


def test_long_periodic_texts_are_found_whole():
    for n, base in ((200_000, [0]), (200_000, [0, 1]), (100_001, list(range(17)))):
        text = np.array((base * (n // len(base) + 1))[:n])
        assert periodic_runs.runs_of([text], 20) == [[(0, n, len(base))]]


def test_odd_rows(odd, nothing):
    got = periodic_runs.find(odd.withColumns({"runs": F.lit("clash"), "collapsed": F.lit(1)}))
    assert {"score", "shard", "chunk"} < set(got.columns)
    rows = {r.doc_id: r for r in got.collect()}
    assert [tuple(r) for r in rows[9].runs] == [(0, 30_000, 1)] and rows[9].collapsed == "word" and rows[9].n_words == 30_000
    assert rows[2].n_words == rows[4].n_words == 0 and rows[2].collapsed == "" and rows[3].runs == []
    assert rows[6].collapsed == "É ß 日本語 𝒳 ' \" ; -- %"
    assert got.where("doc_id = 8").count() == 2 and got.where("doc_id IS NULL").first()["n_words"] == 16
    assert periodic_runs.find(nothing).count() == 0
    assert periodic_runs.find(odd.select("text"), rewrite=queries.planted_period).count() == odd.count()


def test_strongest_run_is_exact(spark):
    runs = [[(5, 3_000_001, 1_000_000), (9, 3_000_004, 1_000_001)], [(0, 30, 10), (3, 60, 20), (4, 24, 8)], []]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "i int, runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = {r.i: r.b and tuple(r.b) for r in rows.select("i", periodic_runs.strongest(F.col("runs")).alias("b")).collect()}
    assert got == {0: (9, 3_000_004, 1_000_001) if Fraction(3_000_004, 1_000_001) > Fraction(3_000_001, 1_000_000) else (5, 3_000_001, 1_000_000), 1: (0, 30, 10), 2: None}


def test_one_word_of_a_million_letters(spark):
    docs = spark.createDataFrame([(1, "x" * 1_000_000), (2, ("y" * 100_000 + " ") * 24)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.find(docs).collect()}
    assert got[1].n_words == 1 and got[1].runs == [] and tuple(got[2].runs[0]) == (0, 24, 1) and got[2].collapsed == "y" * 100_000
