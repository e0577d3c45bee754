"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalscope.llm import lexical_search
from odd_rows import odd, nothing  # noqa: F401


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item_id, text in items:
        wanted[item_id] |= set(terms(text))
    out = []
    for item_id, ts in wanted.items():
        found = []
        for (doc_id, c), size in zip(counts, sizes):
            m = 10 + 90 * size * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id string, text string"))


@pytest.mark.parametrize("segment_bytes, block_terms, task_postings", [(8 << 20, 4096, 4 << 20), (900, 7, 500)])
def test_random_texts(spark, monkeypatch, segment_bytes, block_terms, task_postings):
    # the segments are cut in workers, so their size goes there with the rows: few rows an Arrow batch
    monkeypatch.setattr(lexical_search, "TASK_POSTINGS", task_postings)
    dice = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["É", "日本"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(dice.choices(words, odds, k=dice.choice([0, 1, 5, 40, 300])))) for i in range(700)]
    docs += [(1000 + i, "w3 w9 W11, w30") for i in range(60)] + [(5, None), (5, "w50 w51"), (None, "w50 w52 w52")]
    items = [(f"i{i}", " ".join(dice.choices(words, k=dice.choice([0, 1, 6, 30])))) for i in range(25)]
    items += [("i0", "w50 w52"), (None, "w3 w30"), (None, "W9"), ("none", "absent words only"), ("null", None)]
    frame, asked = frames(spark, docs, items)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if segment_bytes > 900 else "37")
    try:
        got = lexical_search.search(lexical_search.index(frame), asked)
        assert rows_of(got) == brute(docs, items)
        assert rows_of(lexical_search.search(lexical_search.index(frame), asked, 3)) == brute(docs, items, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ties_are_settled_by_id(spark):
    docs = [(i, "equal texts here") for i in random.Random(1).sample(range(10**6), 400)] + [(7, "other")] * 300
    frame, asked = frames(spark, docs, [("a", "equal"), ("b", "here and texts")])
    assert rows_of(lexical_search.search(lexical_search.index(frame), asked)) == brute(docs, [("a", "equal"), ("b", "here and texts")])


def test_odd_rows(odd, nothing, spark):
    given = [(r.doc_id, r.text) for r in odd.collect()]
    items = [("q", "fox word row"), ("w", "w" * 100_000), ("é", "É 日本語")]
    asked = spark.createDataFrame(items, "item_id string, text string").withColumn("term", F.lit("clash"))
    clash = odd.withColumns({"term": F.lit(1), "segment": F.lit("x"), "docs": F.lit(2), "counts": F.lit(3)})
    assert rows_of(lexical_search.search(lexical_search.index(clash), asked)) == brute(given, items)
    assert lexical_search.search(lexical_search.index(nothing), asked).count() == 0
    assert lexical_search.search(lexical_search.index(odd), asked.where("1 = 0")).count() == 0
    numbered = asked.withColumn("item_id", F.lit(3).cast("long"))
    assert dict(lexical_search.search(lexical_search.index(odd), numbered).dtypes)["item_id"] == "bigint"


def segment_of(dice, n_terms=12, n_docs=300):
    lists = [np.sort(dice.choice(n_docs, dice.integers(1, n_docs), replace=False)) for _ in range(n_terms)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    impacts = dice.integers(1, 1000, starts[-1])
    return lists, starts, impacts, lexical_search._Segment(np.arange(n_terms), np.concatenate(lists), impacts, starts, n_docs)


def test_bounds_are_sums_of_range_maxima():
    dice = np.random.default_rng(2)
    lists, starts, impacts, segment = segment_of(dice)
    chosen = np.array([0, 3, 4, 9])
    low = dice.integers(0, 300, 400)
    high = np.minimum(300, low + dice.integers(1, 300, 400))
    bound, split = segment.bound(chosen, low, high)
    for a, b, x, d in zip(low, high, bound, split):
        inside = [[(int(impacts[starts[t] + i]), int(doc)) for i, doc in enumerate(lists[t]) if a <= doc < b] for t in chosen]
        tops = [max(p)[0] if p else 0 for p in inside]
        assert x == sum(tops)
        assert not x or (max(tops), d) in [p for ps in inside for p in ps]
    whole = segment.score(chosen, np.arange(300))
    assert whole.tolist() == [sum(int(impacts[starts[t] + np.flatnonzero(lists[t] == d)[0]]) for t in chosen if d in lists[t]) for d in range(300)]


def test_search_leaves_intervals_that_cannot_win():
    dice = np.random.default_rng(4)
    lists, starts, impacts, segment = segment_of(dice, 3, 4000)
    impacts[:10] = 10**6
    segment = lexical_search._Segment(np.arange(3), np.concatenate(lists), impacts, starts, 4000)
    scored = []
    score = segment.score
    segment.score = lambda terms, docs: scored.append(len(docs)) or score(terms, docs)
    none = lexical_search._Best(np.zeros(0, np.int64), np.zeros(0, np.int64))
    best = lexical_search._search(segment, np.arange(3), np.arange(4000) * 2, none, 10)
    whole = score(np.arange(3), np.arange(4000))
    order = np.lexsort((np.arange(4000), -whole))[:10]
    assert best.ids.tolist() == (order * 2).tolist() and best.scores.tolist() == whole[order].tolist()
    assert sum(scored) < 500


def test_index_lists_every_posting(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    made = lexical_search.index(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert made.where("term IS NOT NULL").agg(F.sum(F.size("docs"))).first()[0] == sum(len(set(terms(t))) for _, t in docs)
    whole = made.where("term IS NULL").select(F.explode(F.arrays_zip("docs", "counts")).alias("d")).select("d.docs", "d.counts").collect()
    assert sorted(map(tuple, whole)) == sorted((i, len(terms(t))) for i, t in docs)
