"""Near-duplicate texts: an exact Jaccard join in the metric space of shingle sets, by pivots.

The Jaccard distance d is a metric. Documents that share a rare shingle make up a region; a pivot of the region is compared
with its other members, and by the triangle inequality what is learned there settles most other pairs:

* members within 0.2 of the pivot are in one class with it, and need no comparing with each other;
* of the rest, x and y can only be linked if |d(x, pivot) - d(y, pivot)| <= 0.2, so a member is compared in its own window
  of distances and, as a boundary document, in the neighbouring ones;
* a region whose members are all in one class is done; the others are joined again, with the next pivot.

Unrelated texts are all at distance 1, where no pivot can tell them apart. So the first regions come from the prefix
theorem: two sets with J >= 0.8 share enough of their smallest shingle hashes that each may forget its most frequent ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalscope.llm.common import NOT_SPACE, Words, appended, components, groups, mix, release, small_batches, text_bytes, written

WORDS = 5
PER_CENT = 80
#: A set of n lists n // SPARE more of its shingles than the prefix theorem asks for; as many shared ones may then be forgotten.
SPARE = 10
#: Pivots that a region is split by before what is left of it is compared window by window.
PIVOTS = 2
#: Ids of candidates are broadcast up to this many rows (8 bytes each); beyond, the join is shuffled.
BROADCAST_ROWS = 1_000_000

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The sorted 64-bit hashes of the distinct shingles of each text: words end at ASCII white space, A-Z lower-cased; of
    fewer than five words, the whole sequence is one shingle; without words the set is empty."""
    words = Words(data, starts, NOT_SPACE)
    h, count = words.hash, words.counts()
    rolled = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k, factor in enumerate(_FACTORS):
        rolled += h[k : len(h) - WORDS + 1 + k] * factor if len(rolled) else rolled
    rolled = mix(rolled)
    out = []
    for first, n in zip(words.first[:-1].tolist(), count.tolist()):
        if n >= WORDS:
            out.append(np.unique(rolled[first : first + n - WORDS + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for k in range(n):
                whole += h[first + k : first + k + 1] * _FACTORS[k]
            out.append(mix(whole ^ np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit key of a set: equal for equal sets, and unequal for unequal ones but for a chance of 2^-64 a pair."""
    if not len(hashes):
        return 0
    powers = np.full(len(hashes), 0x9FB21C651E98DF25, np.uint64).cumprod()
    return int(mix((hashes * powers).sum(keepdims=True, dtype=np.uint64) ^ np.uint64(len(hashes)))[0].astype(np.int64))


def listed(n: int, spare: int) -> int:
    """How many of its n shingles a set lists, smallest hashes first.

    Two linked sets share at least 1 + m // spare of those that both list, m being the size of the smaller.
    """
    return n - -(-n * PER_CENT // 100) + 1 + n // spare


def _sets(batches):
    for batch in batches:
        data, starts = text_bytes(batch.column("text"))
        for first, last in groups(starts):
            a, b = starts[first], starts[last]
            yield batch, first, last, shingle_sets(data[a:b], starts[first : last + 1] - a)
    release()


def keys(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, set_key)."""

    def run(batches):
        for batch, first, last, sets in _sets(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([set_key(s) for s in sets], pa.int64())], names=["doc_id", "n_shingles", "set_key"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key long")


def entries(docs: DataFrame, spare: int = SPARE) -> DataFrame:
    """Rows (h, x, n): the shingles that each distinct set lists, its key and size. A task lists a set once."""

    def run(batches):
        done: set[int] = set()
        for _, _, _, sets in _sets(batches):
            fresh = []
            for s in sets:
                if len(s) and (key := set_key(s)) not in done:
                    done.add(key)
                    fresh.append((s[: listed(len(s), spare)], key, len(s)))
            if fresh:
                sizes = [len(p) for p, _, _ in fresh]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([p for p, _, _ in fresh]).view(np.int64)), pa.array(np.repeat([k for _, k, _ in fresh], sizes), pa.int64()),
                    pa.array(np.repeat([n for _, _, n in fresh], sizes), pa.int32())], names=["h", "x", "n"])

    return docs.select("text").mapInArrow(run, "h long, x long, n int")


def _exploded(sets: DataFrame) -> DataFrame:
    """Rows (h, x, n): all shingles of the sets (x, hashes)."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                hashes = [np.frombuffer(b.as_buffer(), np.int64) for b in part.column("hashes")]
                sizes = [len(h) for h in hashes]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.repeat(part.column("x").to_numpy(), sizes)), pa.array(np.repeat(sizes, sizes), pa.int32())], names=["h", "x", "n"])

    return sets.mapInArrow(run, "h long, x long, n int")


def _shared(batches):
    """Of entries sorted by (h, x), those whose h is listed by two different sets at least, each once."""
    last = None  # the entry not yet given out: alone so far in its h
    for batch in batches:
        h, x, n = (batch.column(c).to_numpy() for c in ("h", "x", "n"))
        if last is not None:
            h, x, n = (np.concatenate([[a], b]) for a, b in zip(last[:3], (h, x, n)))
        if not len(h):
            continue
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[1:] != h[:-1]) | (x[1:] != x[:-1])
        before = last is not None and last[3]  # whether the carried entry's h has been given out already
        h, x, n = h[fresh], x[fresh], n[fresh]
        same = h[1:] == h[:-1]
        out = np.zeros(len(h), dtype=bool)
        out[1:] |= same
        out[:-1] |= same
        given = bool(out[-1])
        if before:
            out[0] = False  # it went out with the batch before
            given = given or len(h) == 1
        last = (h[-1], x[-1], n[-1], given)
        yield pa.RecordBatch.from_arrays([pa.array(h[out], pa.int64()), pa.array(x[out], pa.int64()), pa.array(n[out], pa.int32())], names=["h", "x", "n"])


def _overlap(batches):
    """Jaccard distances of pairs of sorted sets of hashes."""
    for batch in batches:
        common = []
        for a, b in zip(batch.column("sx"), batch.column("sp")):
            a, b = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64)
            if len(a) > len(b):
                a, b = b, a
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            common.append(int((b[at] == a).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("x", "p", "nx", "np")] + [pa.array(common, pa.int64())], names=["x", "p", "nx", "np", "common"])


def _possible(n: str, other: str, c: str, shared: str) -> Column:
    """Whether sets of these sizes, and with so many shingles that any other set has, can be linked."""
    a, b, most = F.col(n), F.col(other), F.least(c, shared, n, other)
    return most * 100 >= (a + b - most) * PER_CENT


def _measured(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Pairs (x, p, nx, np) with d, their exact distance, and linked."""
    left = sets.select(F.col("x"), F.col("hashes").alias("sx"))
    right = sets.select(F.col("x").alias("p"), F.col("hashes").alias("sp"))
    rows = pairs.select("x", "p", "nx", "np").join(left, "x").join(right, "p").mapInArrow(_overlap, "x long, p long, nx int, np int, common long")
    union = F.col("nx") + F.col("np") - F.col("common")
    return written(rows.select("x", "p", (1 - F.col("common") / union).alias("d"), (F.col("common") * 100 >= union * PER_CENT).alias("linked")), name)


def links(docs: DataFrame, spare: int = SPARE) -> DataFrame:
    """Rows (a, b): keys of linked sets, enough of them to connect every class. `docs` has doc_id and text."""
    spark = docs.sparkSession
    # what the smallest set that can be linked with one of n lists to spare
    least = lambda n: F.floor(F.ceil(n * PER_CENT / 100) / spare)
    # Lists: shingles listed by two sets at least. A set that shares too few of those it lists has no partner.
    lists = written(entries(docs, spare).repartition("h").sortWithinPartitions("h", "x").mapInArrow(_shared, "h long, x long, n int"), "lists")
    enough = lists.groupBy("x").agg(F.count("*").alias("c"), F.first("n").alias("n")).where(F.col("c") >= 1 + least(F.col("n"))).select("x")
    lists = lists.join(enough, "x", "left_semi")
    sizes = lists.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    # A set of shingles that many others hold is near the middle of its group: the best pivot.
    own = Window.partitionBy("x")
    lists = lists.join(sizes, "h").withColumns({"rank": F.row_number().over(own.orderBy(F.desc("df"), "h")), "middle": F.sum("df").over(own) / F.col("n")})
    lists = lists.where(F.col("rank") > least(F.col("n"))).select("h", "x", "n", "middle")
    regions = written(lists, "regions")
    members = written(regions.select("x").distinct(), "members")
    # The sets of all members, once each.
    wanted = members.count()
    chosen = keys_and_sets(docs, members if wanted <= BROADCAST_ROWS else None)
    if wanted > BROADCAST_ROWS:
        chosen = chosen.join(members, "x", "left_semi")
    sets = written(chosen.groupBy("x").agg(F.first("hashes").alias("hashes")), "sets")
    # c: how many of all its shingles a set shares with any other; no two sets share more than the smaller c.
    shared = _exploded(sets).repartition("h").sortWithinPartitions("h", "x").mapInArrow(_shared, "h long, x long, n int")
    likely = written(shared.groupBy("x").agg(F.count("*").cast("int").alias("c"), F.first("n").alias("n")).where(F.col("c") * 100 >= F.col("n") * PER_CENT).select("x", "c"), "members")
    regions = written(regions.join(likely, "x"), "regions")
    found = spark.createDataFrame([], "a long, b long")
    classes = None
    best = F.max(F.struct("middle", F.xxhash64("x"), F.col("x").alias("p"), F.col("n").alias("np"), F.col("c").alias("cp")))
    for _ in range(PIVOTS):
        if classes is not None:
            regions = _open(regions, classes, "regions")
        pivots = regions.groupBy("h").agg(best.alias("best")).select("h", "best.p", "best.np", "best.cp")
        met = regions.join(pivots, "h").where("x <> p")
        pairs = met.where(_possible("n", "np", "c", "cp")).groupBy("x", "p").agg(F.first("n").alias("nx"), F.first("np").alias("np"))
        if classes is not None:
            pairs = _apart(pairs, classes)
        pairs = _measured(pairs, sets, "measured")
        found = found.unionByName(pairs.where("linked").select(F.col("x").alias("a"), F.col("p").alias("b")))
        # pivots are done; the others keep their first one
        if "pivot" not in met.columns:
            met = met.withColumn("pivot", F.col("p"))
        regions = written(met.select("h", "x", "n", "middle", "c", "pivot"), "regions")
        classes = components(found, "classes")
    pairs = _measured(_rest(_open(regions, classes, "regions"), classes, sets), sets, "measured")
    return found.unionByName(pairs.where("linked").select(F.col("x").alias("a"), F.col("p").alias("b")))


def _rest(regions: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (x, p, nx, np) of different classes that share a region and may still be linked, each once.

    Let x and y be in the region of pivot q, with o = |x & q| and the like. They share min(o_x, o_y) shingles of q at most.
    Either that is enough by itself, and they lie in each other's window of distances from q; or they share shingles
    outside q as well, and meet in one of those. How many shingles of q both lack is bounded bucket by bucket, and with it
    how far apart x and y are.
    """
    at = _class_of(regions.select("x", "n", "c", "pivot").distinct(), classes, "x", "class")
    left, right = sets.withColumnRenamed("hashes", "sx"), sets.select(F.col("x").alias("pivot"), F.col("hashes").alias("sp"))
    kinds = "x long, n int, c int, pivot long, class long, o int, np int, outside array<bigint>, lacking array<int>"
    at = written(at.join(left, "x").join(right, "pivot").select("x", "n", "c", "pivot", "class", "sx", "sp").mapInArrow(_against_pivot, kinds), "outside")
    at = at.withColumn("d", 1 - F.col("o") / (F.col("n") + F.col("np") - F.col("o"))).withColumn("off", F.col("n") + F.col("np") - 2 * F.col("o"))
    names = ["x", "n", "c", "o", "d", "off", "lacking", "class"]

    def other(rows):
        return rows.withColumnsRenamed({k: f"{k}2" for k in names})

    def enough(common):
        return common * (100 + PER_CENT) >= (F.col("n") + F.col("n2")) * PER_CENT

    def near(common):
        """Whether sets that share so many shingles outside the pivot can be within the distance."""
        lacked = F.aggregate(F.zip_with("lacking", "lacking2", lambda a, b: F.least(a, b)), F.lit(0), lambda n, k: n + k)
        return (F.col("off") + F.col("off2") - 2 * (common + lacked)) * (100 + PER_CENT) <= (F.col("n") + F.col("n2")) * (100 - PER_CENT)

    apart = (F.col("x") < F.col("x2")) & (F.col("class") != F.col("class2")) & (F.abs(F.col("d") - F.col("d2")) <= 1 - PER_CENT / 100 + 1e-9)
    within = at.drop("outside", "np")
    inside = within.join(other(within), "pivot").where(apart & enough(F.least("o", "o2")) & near(F.lit(0)))
    # outside shingles that nobody else in the region has join nothing
    ends = at.select("pivot", "x", F.explode("outside").alias("h"))
    met = ends.join(ends.groupBy("pivot", "h").count().where("count > 1").select("pivot", "h"), ["pivot", "h"])
    met = met.withColumn("s", F.count("*").over(Window.partitionBy("pivot", "x")).cast("int")).join(within, ["pivot", "x"])
    names = [*names, "s"]
    shared = F.least("s", "s2")
    outside = met.join(other(met), ["pivot", "h"]).where(apart & enough(F.least("o", "o2") + shared) & near(shared))
    outside = outside.groupBy("pivot", "x", "x2").agg(*[F.first(k).alias(k) for k in ("n", "n2", "o", "o2", "off", "off2", "lacking", "lacking2")], F.count("*").cast("int").alias("e"))
    outside = outside.where(enough(F.least("o", "o2") + F.col("e")) & near(F.col("e")))
    pairs = inside.select("x", "x2", "n", "n2").unionByName(outside.select("x", "x2", "n", "n2"))
    return pairs.groupBy("x", F.col("x2").alias("p")).agg(F.first("n").alias("nx"), F.first("n2").alias("np"))


BUCKETS = 128


def _against_pivot(batches):
    """How many shingles a set shares with its pivot, the pivot's size, the shingles that it has besides, and how many of
    the pivot's it lacks, in buckets by the last bits of their hashes."""
    for batch in batches:
        common, sizes, outside, lacking = [], [], [], []
        for a, b in zip(batch.column("sx"), batch.column("sp")):
            a, b = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64)
            same = np.isin(a, b, assume_unique=True)
            common.append(int(same.sum()))
            sizes.append(len(b))
            outside.append(a[~same])
            lacking.append(np.bincount(np.setdiff1d(b, a, assume_unique=True) & (BUCKETS - 1), minlength=BUCKETS).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("x", "n", "c", "pivot", "class")] + [
            pa.array(common, pa.int32()), pa.array(sizes, pa.int32()), pa.array(outside, pa.list_(pa.int64())), pa.array(lacking, pa.list_(pa.int32()))],
            names=["x", "n", "c", "pivot", "class", "o", "np", "outside", "lacking"])


def _class_of(rows: DataFrame, classes: DataFrame, key: str, name: str) -> DataFrame:
    return rows.join(classes.select(F.col("node").alias(key), F.col("component").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs not yet in one class."""
    return _class_of(_class_of(pairs, classes, "x", "cx"), classes, "p", "cp").where("cx <> cp").drop("cx", "cp")


def _open(regions: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """Regions that hold members of more than one class."""
    rows = _class_of(regions, classes, "x", "class")
    several = rows.groupBy("h").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("h")
    return written(rows.join(several, "h", "left_semi").drop("class"), name)


def keys_and_sets(docs: DataFrame, members: DataFrame | None) -> DataFrame:
    """Rows (x, hashes): of the members alone, if they are given (then they are few enough to broadcast)."""
    chosen = None
    if members is not None:
        ids = np.sort(members.toArrow().column(0).to_numpy())
        chosen = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        done: set[int] = set()
        for _, _, _, sets in _sets(batches):
            keys_, hashes = [], []
            for s in sets:
                if not len(s) or (key := set_key(s)) in done:
                    continue
                done.add(key)
                if chosen is not None:
                    ids = chosen.value
                    at = int(np.searchsorted(ids, key))
                    if at == len(ids) or ids[at] != key:
                        continue
                keys_.append(key)
                hashes.append(np.sort(s.view(np.int64)).tobytes())
            if keys_:
                yield pa.RecordBatch.from_arrays([pa.array(keys_, pa.int64()), pa.array(hashes, pa.binary())], names=["x", "hashes"])

    return docs.select("text").mapInArrow(run, "x long, hashes binary")


def classify(docs: DataFrame, spare: int = SPARE) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Documents are linked if the Jaccard similarity of their sets of distinct five-word shingles is at least 0.8;
    component_id is the smallest doc_id reachable by links. Null and empty texts and those without words have no shingles
    and are linked with nothing, nor are rows without a doc_id (their component_id is null). Repeated rows all stay. Equal
    sets are one class from the start and are compared as one. An empty table gives no rows; other columns are left behind.
    Shingles are compared by 64-bit hashes.
    """
    return _classified(docs, spare).select("doc_id", "n_shingles", F.when(_linkable(), F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _linkable() -> Column:
    return (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()


def _classified(docs: DataFrame, spare: int = SPARE) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, set_key and the first (doc_id, set_key) of its class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    with small_batches(docs.sparkSession):
        rows = written(keys(docs), "keys")
        linked = links(docs, spare)
    groups_ = components(linked, "classes").select(F.col("node").alias("set_key"), F.col("component").alias("class"))
    firsts = rows.where(_linkable()).groupBy("set_key").agg(F.min("doc_id").alias("doc_id")).join(groups_, "set_key", "left")
    firsts = firsts.withColumn("class", F.coalesce("class", "set_key"))
    smallest = firsts.groupBy("class").agg(F.min(F.struct("doc_id", "set_key")).alias("first"))
    named = written(firsts.join(smallest, "class").select("set_key", "first"), "named")
    return rows.join(named, "set_key", "left")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, the first by doc_id and then by its set's key, with all its columns.

    Rows without a doc_id or without words all stay. Of equal sets under the class's first id one row stays, whichever. Texts
    are shuffled only where one id stands on several rows; otherwise the ids that go are joined, by broadcast if they are few.
    """
    rows = _classified(docs).where("doc_id IS NOT NULL").withColumn(
        "stays", ~_linkable() | ((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.set_key") == F.col("set_key"))))
    ids = written(rows.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if("stays").alias("stay")).where("rows > 1 OR stay = 0"), "ids")
    several = ids.where("rows > 1 AND stay > 0").select("doc_id")
    out = _without(docs, ids.select("doc_id"))
    if several.limit(1).count():
        first = written(rows.where("stays AND n_shingles > 0").join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct(), "firsts")
        out = out.unionByName(_several(docs.join(several, "doc_id", "left_semi").select(*docs.columns), first))
    return out.select(*docs.columns)


def _several(docs: DataFrame, first: DataFrame) -> DataFrame:
    """Of rows that share their ids: those without words, and one for each (doc_id, set_key) of `first`."""

    def compute(batch):
        found = [s for _, _, _, sets in _sets([batch]) for s in sets]
        return [pa.array([set_key(s) if len(s) else None for s in found], pa.int64())]

    keyed = appended(docs, compute, "_set_key long")
    one = keyed.join(first.withColumnRenamed("set_key", "_set_key"), ["doc_id", "_set_key"], "left_semi").dropDuplicates(["doc_id", "_set_key"])
    return keyed.where("_set_key IS NULL").unionByName(one).select(*docs.columns)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left_anti")


def oracle() -> str:
    """classify() as DuckDB SQL, for tables without repeated ids."""
    return r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct([array_to_string(ws[p:p + 4], ' ') for p in range(1, len(ws) - 3)]) END AS s FROM w),
u AS (SELECT doc_id, unnest(s) AS t FROM g),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM u AS a JOIN u AS b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT o.a, o.b FROM o JOIN g AS x ON x.doc_id = o.a JOIN g AS y ON y.doc_id = o.b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT g.doc_id, cast(len(s) AS bigint) AS n_shingles, coalesce(least(g.doc_id, m.b), g.doc_id) AS component_id FROM g LEFT JOIN m ON m.a = g.doc_id"""
