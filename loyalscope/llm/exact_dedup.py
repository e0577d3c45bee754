"""Documents with equal texts, by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

DataFrame functions only. What a step finds to be alone is settled: its content is hashed no further and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import written

#: Bytes of the beginning that the second step hashes.
HEAD = 64
#: Lengths, and lengths with beginnings, that occur more than once are handed to the scans as hash slots: so many at most,
#: which bounds what is broadcast. Rows in a slot by chance are refined once more than needed, and come out right.
SLOTS = 1 << 18


def normalised(text: Column) -> Column:
    """Text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """docs with the normalised text, its length in bytes and the hash of its beginning."""
    rows = docs.withColumn("_whole", normalised(F.col(f"`{text}`")))
    return rows.withColumns({"_n": F.octet_length("_whole"), "_head": F.xxhash64(F.substring("_whole", 1, HEAD))})


def _slot(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Slots of the keys that more than one row has. Rows are counted before they are shuffled."""
    more = rows.groupBy(*keys).count().where("count > 1")
    return written(more.select(_slot(*keys).alias("_slot"), F.lit(True).alias("_open")).distinct(), "slots")


def _open(rows: DataFrame, slots: DataFrame, *keys: str) -> DataFrame:
    """rows with `_open`: whether they may share their keys with another row. The broadcast holds at most SLOTS rows."""
    rows = rows.withColumn("_slot", _slot(*keys)).join(F.broadcast(slots), "_slot", "left")
    return rows.withColumn("_open", F.coalesce("_open", F.lit(False))).drop("_slot")


def _survivors(docs: DataFrame, text: str) -> DataFrame:
    """Slots of the lengths with beginnings that more than one document has."""
    short = written(_measured(docs, text).select("_n", "_head"), "lengths")
    second = _open(short, _repeated(short, "_n"), "_n").where("_open")
    return _repeated(second, "_n", "_head")


def classify(docs: DataFrame, text: str = "text", digests: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when they are after every run of white space is replaced by one space; null counts as empty. keep_id is
    the smallest doc_id of the equal texts, null ids last (null if none has one). Exactly one row of a group is kept, also
    where its id is repeated. digest is the SHA-256 of the normalised text, in hexadecimal, which decides; rows that are known
    to be alone have none unless `digests` asks for all. An empty table gives no rows; other columns are left behind.
    """
    rows = _open(_measured(docs, text), _survivors(docs, text), "_n", "_head")
    digest = F.sha2("_whole", 256)
    rows = written(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "_n", "_open", F.monotonically_increasing_id().alias("_row"),
                               (digest if digests else F.when(F.col("_open"), digest)).alias("digest")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row"))
    classes = rows.where("_open").groupBy("_n", "digest").agg(first.alias("_first"), F.count("*").alias("group_size"))
    classes = written(classes.where("group_size > 1").select("digest", "_first", "group_size"), "classes")
    alone = rows.where("NOT _open").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                           F.lit(True).alias("kept"), "digest")
    found = rows.where("_open").join(classes, "digest", "left")
    grouped = F.col("group_size").isNotNull()
    return alone.unionByName(found.select(
        "doc_id", F.when(grouped, F.col("_first.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(grouped, F.col("_first._row") == F.col("_row")).otherwise(True).alias("kept"), "digest"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the row with the smallest doc_id.

    Of rows that share even that id one stays, whichever. Rows known to be alone pass without a shuffle; of the others each
    task hands on one row a group. Columns may have any names but `_n`, `_head`, `_whole`, `_slot`, `_open` and `_digest`.
    """
    rows = _open(_measured(docs, text), _survivors(docs, text), "_n", "_head")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    alone = rows.where("NOT _open").select(*columns)
    same = rows.where("_open").select(*columns, "_n", F.sha2("_whole", 256).alias("_digest"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    firsts = same.groupBy("_n", "_digest").agg(F.min_by(F.struct(*columns), order).alias("_first"))
    return alone.unionByName(firsts.select("_first.*"))


def oracle() -> str:
    """classify() as DuckDB SQL, for tables without repeated ids."""
    return r"""WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)"""
