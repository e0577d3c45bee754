"""Whole-row duplicates by fingerprint and by comparison."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loyalscope.operators import duplicates, quality

COLUMNS = "`a.b` string, `c``d` double, _bucket int, list array<int>, day date"


def table(spark, n=400, seed=5):
    import datetime
    dice = random.Random(seed)
    rows = [(dice.choice([None, "", "x", "y"]), dice.choice([None, 0.0, -0.0, float("nan"), 1.5, dice.random()]), dice.choice([None, 1, 2]),
             dice.choice([None, [], [1], [1, None]]), dice.choice([None, datetime.date(2020, 1, 1)])) for _ in range(n)]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def counted(df):
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
    return sorted((str(tuple(r)) for r in df.groupBy(*columns).count().collect()))


def test_rows_are_told_apart_as_grouping_does(spark):
    df = table(spark)
    plain = df.groupBy(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).count().where("count > 1")
    assert sorted(str(tuple(r)) for r in duplicates.copies(df).collect()) == sorted(str(tuple(r)) for r in plain.collect())
    once = duplicates.drop_duplicates(df)
    assert once.columns == df.columns and counted(once) == counted(df.dropDuplicates())
    assert quality.duplicate_count(df).first()[0] == df.count() - df.dropDuplicates().count()
    listed = Counter(counted(quality.duplicate_rows(df)))
    assert sum(listed.values()) == plain.count()


def test_nulls_in_other_columns_are_other_rows(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("a", "a")], "x string, y string")
    assert duplicates.flagged(df).where("_copied").count() == 0
    assert duplicates.copies(df).count() == 0 and duplicates.drop_duplicates(df).count() == 4


@pytest.mark.parametrize("forged", ["same for all", "few bits"])
def test_agreeing_fingerprints_do_not_change_results(spark, monkeypatch, forged):
    df = table(spark)
    want = counted(df.dropDuplicates()), quality.duplicate_count(df).first()[0], sorted(map(str, duplicates.copies(df).collect()))
    if forged == "few bits":
        monkeypatch.setattr(duplicates, "BITS", 3)
    else:
        monkeypatch.setattr(duplicates, "fingerprint", lambda df: [F.lit(7).cast("bigint"), F.lit(7).cast("bigint")])
    assert (counted(duplicates.drop_duplicates(df)), quality.duplicate_count(df).first()[0], sorted(map(str, duplicates.copies(df).collect()))) == want


def test_single_rows_are_not_shuffled(spark):
    ids = spark.range(20_000).select("id", F.concat(F.lit("row "), F.col("id")).alias("text"))
    df = ids.unionByName(ids.where("id < 30")).repartition(4)
    assert duplicates.flagged(df).where("_copied").count() < 70
    found = duplicates.copies(df)
    assert found.count() == 30
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the only exchanges of whole rows come after the filter on the flag; before it there are fingerprints and bits
    exchanges = re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan)
    whole = [e for e in exchanges if "text" in e]
    assert len(whole) == 1 and any("first" in e and "text" not in e for e in exchanges)
    assert "getbit" in plan.lower()


def test_no_rows_and_hot_rows(spark):
    df = table(spark)
    for empty in (df.where("1 = 0"),):
        assert duplicates.drop_duplicates(empty).count() == 0 and quality.duplicate_count(empty).first()[0] == 0
    hot = spark.range(50_000).select((F.col("id") % 3 == 0).alias("hot"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"))
    assert quality.duplicate_count(hot).first()[0] == 16_666
    assert duplicates.drop_duplicates(hot).count() == 50_000 - 16_666
