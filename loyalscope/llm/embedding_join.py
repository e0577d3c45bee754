"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of at least t are at most eps = sqrt(2 - 2t) apart, and so are their projections on any
direction. Projected on leading principal directions, vectors fall into grid cells of side eps. Sorted by cells, the
sequence is cut into blocks; two blocks are joined only if their cells come within one of each other in every direction,
and inside a task the join halves its two intervals again and again, leaving out halves that are provably distant.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import components, written

DIRECTIONS = 6
BLOCK = 2048  # vectors of a block
LEAF = 256  # intervals of up to so many vectors are compared outright
SAMPLE = 4096  # vectors that the directions are worked out from; they decide about speed, never about results


def directions(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Leading principal directions of the unit vectors of each length in a bounded sample, picked by a hash."""
    rows = classes.select("vector").orderBy(F.xxhash64("vector")).limit(sample).collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    out = {}
    for length, vectors in by_length.items():
        unit = normal(np.array(vectors, dtype=np.float64))
        _, _, axes = np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)
        out[length] = np.ascontiguousarray(axes[:DIRECTIONS])
    return out


def normal(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(unit: np.ndarray, axes: np.ndarray | None, eps: float) -> np.ndarray:
    """Grid cells, a row of DIRECTIONS for each vector; lengths that the sample lacks are cut along their first axes."""
    seen = unit @ axes.T if axes is not None else unit[:, :DIRECTIONS]
    out = np.zeros((len(unit), DIRECTIONS), dtype=np.int32)
    out[:, : seen.shape[1]] = np.floor(seen / (eps * (1 + 1e-9)))
    return out


def distant(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether no cell of a comes within one of a cell of b in some direction."""
    return bool(((a.min(axis=0) > b.max(axis=0) + 1) | (b.min(axis=0) > a.max(axis=0) + 1)).any())


class Forest:
    """Which of some numbered things are linked; only links that join two trees are kept."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))


def join_intervals(x: np.ndarray, cx: np.ndarray, wx: np.ndarray, y: np.ndarray | None, cy: np.ndarray | None, wy: np.ndarray | None,
                   least: float, leaf: int = LEAF) -> tuple[np.ndarray, Forest]:
    """Weights of the partners of every row, and the links as a forest, of two sequences (or of one with itself: y None).

    Rows of y are numbered behind those of x. A pair is compared once."""
    own = y is None
    if own:
        y, cy, wy, shift = x, cx, wx, 0
    else:
        shift = len(x)
    partners = np.zeros(len(x) + (0 if own else len(y)), dtype=np.int64)
    forest = Forest(len(partners))

    def recurse(a: int, b: int, c: int, d: int) -> None:
        same = own and a == c
        if a >= b or c >= d or (not same and distant(cx[a:b], cy[c:d])):
            return
        if b - a <= leaf and d - c <= leaf:
            near = x[a:b] @ y[c:d].T >= least
            if same:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            if not len(i):
                return
            np.add.at(partners, i + a, wy[j + c])
            np.add.at(partners, j + c + shift, wx[i + a])
            # one link to each row and column is enough where rows share columns; the forest sorts out the rest
            for p, q in zip((i + a).tolist(), (j + c + shift).tolist()):
                if forest.parent[p] != forest.parent[q]:
                    forest.join(p, q)
            return
        m, n = (a + b) // 2, (c + d) // 2
        if same:
            recurse(a, m, a, m)
            recurse(a, m, m, b)
            recurse(m, b, m, b)
        elif b - a >= d - c:
            recurse(a, m, c, d)
            recurse(m, b, c, d)
        else:
            recurse(a, b, c, n)
            recurse(a, b, n, d)

    recurse(0, len(x), 0, len(y))
    return partners, forest


def link(vectors: DataFrame, threshold: float = 0.93, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null, their lengths are equal and their cosine, in double
    precision, reaches the threshold. Vectors that are null, empty or zero, or hold null or non-finite components, and rows
    without a vec_id, link with nothing: n_links 0, component_id the vec_id itself. Equal vectors are compared once, as
    one vector with their number, so large groups of copies cost nothing; each row counts all its partners, rows repeated
    under one id included. kept: vec_id is its component's smallest. Other columns are left behind, an empty table gives no
    rows. Nothing grows with a group in one task: what a task holds is two blocks.
    """
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.coalesce(F.size("vector"), F.lit(0)) > 0) & finite
              & F.exists("vector", lambda v: v != 0.0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = written(rows.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors")
    eps = float(np.sqrt(2 - 2 * threshold))
    axes = spark.sparkContext.broadcast(directions(classes))

    def place(batches):
        for batch in batches:
            vectors_, keys = batch.column("vector"), []
            for row in vectors_:
                v = np.array(row.values.to_numpy(zero_copy_only=False))[None]
                keys.append(cells(normal(v), axes.value.get(v.shape[1]), eps)[0].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    ordered = classes.mapInArrow(place, "label string, vector array<double>, rep long, weight long, cells array<int>").withColumn("length", F.size("vector"))
    ordered = ordered.repartitionByRange("label", "length", "cells", "rep").sortWithinPartitions("label", "length", "cells", "rep")

    def cut(batches):
        """Blocks of neighbours in the order; a block never mixes labels or lengths, nor crosses a partition."""
        held: list[dict] = []

        def emit():
            x = np.array([r["vector"] for r in held], dtype=np.float64)
            c = np.array([r["cells"] for r in held], dtype=np.int32)
            ids = np.array([r["rep"] for r in held], dtype=np.int64)
            weights = np.array([r["weight"] for r in held], dtype=np.int64)
            out = (held[0]["label"], held[0]["length"], int(ids[0]), c.min(axis=0).tolist(), c.max(axis=0).tolist(),
                   normal(x).tobytes(), c.tobytes(), ids.tobytes(), weights.tobytes())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) >= block or (row["label"], row["length"]) != (held[0]["label"], held[0]["length"])):
                    yield emit()
                held.append(row)
        if held:
            yield emit()

    blocks = written(ordered.mapInArrow(cut, "label string, length int, block long, low array<int>, high array<int>, vectors binary, cells binary, ids binary, weights binary"), "blocks")
    found = written(_pairs(blocks).mapInArrow(_joined(threshold, leaf), "a long, b long, n long"), "links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b IS NOT NULL").select("a", "b")).withColumnsRenamed({"node": "rep", "component": "group"})
    known = classes.join(counts, "rep", "left").join(groups, "rep", "left")
    answered = rows.where("usable").join(known, ["label", "vector"]).select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("group", "rep").alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return answered.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


BLOCK_NAMES = ["label", "length", "block", "low", "high", "vectors", "cells", "ids", "weights"]
BLOCK_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _pairs(blocks: DataFrame) -> DataFrame:
    """Blocks of one label and length whose cells come within one of each other, each pair once, with their contents.

    The pairs are found on the blocks' bounds alone: blocks meet in the cells of the first direction that the one touches
    and the other reaches, and are checked in all directions there.
    """
    bounds = blocks.select("label", "length", "block", "low", "high")
    left = bounds.withColumn("cell", F.explode(F.sequence(F.col("low")[0], F.col("high")[0])))
    right = bounds.select("label", "length", F.col("block").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2"),
                          F.explode(F.sequence(F.col("low")[0] - 1, F.col("high")[0] + 1)).alias("cell"))
    near = (F.col("block") <= F.col("other")) & (F.col("cell") == F.greatest(F.col("low")[0], F.col("low2")[0] - 1))
    for k in range(1, DIRECTIONS):
        near = near & (F.col("low")[k] <= F.col("high2")[k] + 1) & (F.col("low2")[k] <= F.col("high")[k] + 1)
    pairs = left.join(right, ["label", "length", "cell"]).where(near).select("block", "other")
    pairs = pairs.repartition(F.xxhash64("block", "other"))
    content = blocks.select("block", "length", "vectors", "cells", "ids", "weights")
    second = content.select(F.col("block").alias("other"), *[F.col(c).alias(f"{c}2") for c in ("vectors", "cells", "ids", "weights")])
    return pairs.join(content, "block").join(second, "other")


def _joined(threshold: float, leaf: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                read = lambda end: (np.frombuffer(row[f"vectors{end}"]).reshape(-1, row["length"]), np.frombuffer(row[f"cells{end}"], np.int32).reshape(-1, DIRECTIONS),
                                    np.frombuffer(row[f"weights{end}"], np.int64), np.frombuffer(row[f"ids{end}"], np.int64))
                x, cx, wx, ids = read("")
                if row["block"] == row["other"]:
                    partners, forest = join_intervals(x, cx, wx, None, None, None, threshold, leaf)
                else:
                    y, cy, wy, more = read("2")
                    partners, forest = join_intervals(x, cx, wx, y, cy, wy, threshold, leaf)
                    ids = np.concatenate([ids, more])
                some = np.flatnonzero(partners)
                a = np.concatenate([ids[some], ids[[p for p, _ in forest.links]] if forest.links else ids[:0]])
                b = pa.array([None] * len(some) + ids[[q for _, q in forest.links]].tolist() if forest.links else [None] * len(some), pa.int64())
                n = pa.array(partners[some].tolist() + [None] * len(forest.links), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, n], names=["a", "b", "n"])

    return run


def oracle(threshold: float = 0.93) -> str:
    """link() as DuckDB SQL, for tables without repeated ids."""
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, cast(embedding AS double[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= {threshold}),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT m.vec_id, cast((SELECT count(*) FROM e WHERE e.a = m.vec_id) AS bigint) AS n_links, coalesce(least(m.vec_id, (SELECT min(b) FROM r WHERE r.a = m.vec_id)), m.vec_id) AS component_id,
  coalesce(m.vec_id <= (SELECT min(b) FROM r WHERE r.a = m.vec_id), true) AS kept
FROM embeddings AS m"""
