"""Exact duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from loyalscope.llm import exact_dedup
from odd_rows import odd, nothing  # noqa: F401


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        named = sorted(i for i in ids if i is not None)
        keep = named[0] if named else None
        kept = [True] + [False] * (len(ids) - 1)
        ordered = named + [None] * (len(ids) - len(named))
        out += [(i, keep, len(ids), k, hashlib.sha256(text.encode()).hexdigest()) for i, k in zip(ordered, kept)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()), key=repr)


def test_odd_rows(odd, nothing):
    given = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(exact_dedup.classify(odd, digests=True)) == brute(given)
    assert exact_dedup.classify(nothing).count() == 0 and exact_dedup.keep_one(nothing).count() == 0
    clash = odd.withColumns({"keep_id": F.lit("x"), "group_size": F.lit("y"), "digest": F.lit("z"), "kept": F.lit(0)})
    assert rows_of(exact_dedup.classify(clash, digests=True)) == brute(given)
    stay = exact_dedup.keep_one(clash)
    assert stay.columns == clash.columns
    firsts = {(keep, plain(t)) for t in {t for _, t in given} for keep in [min((i for i, u in given if plain(u) == plain(t)), key=lambda i: (i is None, i))]}
    assert sorted(((r.doc_id, plain(r.text)) for r in stay.collect()), key=repr) == sorted(firsts, key=repr)


def test_random_texts_of_few_lengths_and_one_beginning(spark):
    dice = random.Random(3)
    rows = []
    for i in range(3000):
        body = dice.choice(["", "same beginning " * 6, "x"]) + "".join(dice.choice("ab") for _ in range(dice.choice([2, 3, 9])))
        rows.append((dice.randrange(2500) if i % 50 else None, dice.choice([body, body + " \n\t", body + " ", None])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert rows_of(exact_dedup.classify(docs, digests=True)) == brute(rows)
    lazy = exact_dedup.classify(docs)
    assert lazy.where("digest IS NULL AND group_size > 1").count() == 0
    four = lambda rows: sorted((tuple(r)[:4] for r in rows), key=repr)
    assert four(lazy.select("doc_id", "keep_id", "group_size", "kept").collect()) == four(brute(rows))
    assert exact_dedup.keep_one(docs).count() == len({plain(t) for _, t in rows})


def test_content_of_lone_texts_is_not_hashed(spark, monkeypatch):
    rows = [(1, "a"), (2, "bb"), (3, "bc"), (4, "dd" * 40 + "x"), (5, "dd" * 40 + "y"), (6, "ee"), (7, "ee")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r.doc_id for r in exact_dedup.classify(docs).where("digest IS NOT NULL").collect()}
    assert hashed == {4, 5, 6, 7}
    monkeypatch.setattr(exact_dedup, "SLOTS", 1)  # all in one slot: more is hashed, the classes are the same
    assert rows_of(exact_dedup.classify(docs, digests=True)) == brute(rows)


def test_hot_text_is_counted_before_the_shuffle(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup.classify(docs)
    assert out.where("kept").count() == 20_001
    assert out.where("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.max("keep_id")).first() == (10_000, 0, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
