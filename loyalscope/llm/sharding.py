"""Shards by a hierarchical weighted hash tree.

A row descends from the root to a region, a rack and a shard. At each level every child draws an exponential number from
a hash of the key and the child's name, divided by the child's weight, and the smallest draw wins. A child's draw depends
on nothing but the key, its name and its weight, so when weights change, rows move only into children that have become
heavier and out of those that have become lighter; whatever lies below an unchanged child keeps its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalscope.llm.common import written

#: Rows of one shard are numbered in so many separately ordered buckets.
BUCKETS = 1024


@dataclass(frozen=True)
class Node:
    """A subtree: its name, its weight, and its children or its shard number."""

    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"shard{shard}", weight, shard=shard)


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def even_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> Node:
    """Shards of weight 1, filled into racks and regions in order."""
    racks = [inner(f"rack{i // per_rack}", [leaf(s) for s in range(i, min(i + per_rack, shards))])
             for i in range(0, shards, per_rack)]
    regions = [inner(f"region{i // racks_per_region}", racks[i : i + racks_per_region])
               for i in range(0, len(racks), racks_per_region)]
    return inner("root", regions)


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own: rows move to it and nowhere else."""
    fresh = inner(f"region-of-{shard}", [inner(f"rack-of-{shard}", [leaf(shard, weight)])])
    return inner(tree.name, [*tree.children, fresh])


def _table(tree: Node) -> tuple[Column, Column, int]:
    """Constants: the children (name, weight, number) of every numbered node, the shard of each, and the depth."""
    nodes, depth, level = [tree], 0, [tree]
    while level := [c for n in level for c in n.children if c.weight > 0]:
        nodes += level
        depth += 1
    number = {id(n): i for i, n in enumerate(nodes)}
    entry = lambda n: F.struct(F.lit(n.name).alias("name"), F.lit(float(n.weight)).alias("weight"), F.lit(number.get(id(n), 0)).alias("at"))
    children = F.array(*[F.array(*[entry(c) for c in n.children if c.weight > 0]) if n.children else F.slice(F.array(entry(n)), 1, 0) for n in nodes])
    return children, F.array(*[F.lit(-1 if n.shard is None else n.shard) for n in nodes]), depth


def place(key: Column, tree: Node) -> Column:
    """The shard of a key. A null key is a key like any other.

    A draw is -ln(u) / weight, with u from 52 bits of a hash of the key and the child's name; equal draws go to the child
    that stands first. Only the children of the node reached draw.
    """
    key = F.coalesce(key.cast("string"), F.lit(""))
    children, shards, depth = _table(tree)

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 12).cast("double")
        return F.struct((-F.log((bits + 0.5) / F.lit(2.0**52)) / child["weight"]).alias("draw"), child["at"].alias("at"))

    at = F.lit(0)
    for _ in range(depth):
        at = F.coalesce(F.array_min(F.transform(children[at], draw))["at"], F.lit(0))
    return shards[at]


def shard_documents(docs: DataFrame, tree: Node, bigger: Node | None = None, key: str = "doc_id") -> DataFrame:
    """All rows with shard, slot (from 0 without gaps in each shard) and, for a larger tree, grown_shard.

    Rows: doc_id, size (UTF-8 bytes of the text plus 16; null text: 16), text_crc32 (null text: that of no bytes), law,
    shard, slot, grown_shard. Other columns are left behind. Repeated rows each get a slot of their own, rows with a null
    doc_id too; an empty table gives no rows. Rows of a shard are numbered bucket by bucket of a hash of the doc_id; the
    table of bucket sizes has at most shards x BUCKETS rows, so it is broadcast. Written once, so both uses of the rows
    see the same ones.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        place(F.col(key), tree).cast("int").alias("shard"),
        (place(F.col(key), bigger) if bigger else F.lit(None)).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("slot")), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    rows = written(rows, "sharded")
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "bucket", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    numbered = rows.withColumn("at", F.row_number().over(
        Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")))
    return numbered.join(F.broadcast(before), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.coalesce("before", F.lit(0)) + F.col("at") - 1).cast("long").alias("slot"), "grown_shard")
