"""Whole-row duplicates: fingerprints first, rows second.

Every row gets a 128-bit fingerprint, and fingerprints alone are counted across the cluster. Those met more than once set
bits in a bitmap of fixed size that goes to every task; a row whose bit is not set has no copy for sure, and only the others are
shuffled and compared as they are. Bits and fingerprints that agree by chance cost time and never change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loyalscope.functions import quoted

#: Bits of the bitmap: 8 MB for every task. With more repeated fingerprints than that more single rows are shuffled as well.
BITS = 1 << 26


def fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of the whole row, of different seeds. Nulls count: a hash alone would skip them."""
    parts = [part for c in df.columns for part in (F.col(quoted(c)), F.col(quoted(c)).isNull())]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def repeated_bits(df: DataFrame) -> DataFrame:
    """(bucket, bits): a bitmap of the fingerprints that more than one row has, at most BITS bits in all."""
    first, second = fingerprint(df)
    counts = df.select(first.alias("first"), second.alias("second")).groupBy("first", "second").agg(F.count("*").alias("n"))
    place = _place(F.col("first"))
    return counts.where("n > 1").groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def _place(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(BITS)) + 1  # bitmaps are numbered from 1


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def flagged(df: DataFrame, out: str = "_copied") -> DataFrame:
    """All rows with a flag: false only for rows that have no copy for sure. Reads df twice."""
    place = _place(fingerprint(df)[0])
    bucket, position, bits = (unused(df, name) for name in ("_bucket", "_position", "_bits"))
    known = repeated_bits(df).withColumnsRenamed({"bucket": bucket, "bits": bits})
    rows = df.select("*", F.bitmap_bucket_number(place).alias(bucket), F.bitmap_bit_position(place).alias(position))
    rows = rows.join(F.broadcast(known), bucket, "left")
    return rows.select(*_columns(df), F.coalesce(_is_set(F.col(bits), F.col(position)), F.lit(False)).alias(out))


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]


def copies(df: DataFrame, out: str = "_copies") -> DataFrame:
    """The distinct rows that occur more than once, and how often. Others are not shuffled, but for chance hits."""
    flag = unused(df, "_copied")
    return flagged(df, flag).where(F.col(flag)).groupBy(*_columns(df)).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each row, whole. Rows without a copy stay where they are."""
    flag = unused(df, "_copied")
    rows = flagged(df, flag)
    return rows.where(~F.col(flag)).select(*_columns(df)).unionByName(rows.where(F.col(flag)).select(*_columns(df)).dropDuplicates())
