"""Ranked lexical search with range-maximum tables over posting lists.

index() cuts the documents into segments where they are read and lists, for each segment and term, the documents that hold it
and how often. search() gives every posting its impact on the score and every posting list a sparse table of range
maxima. The documents of a segment are searched best first: an interval's bound is the sum of its terms' maxima, the best intervals
are split at the document with the greatest impact, which is scored, and what is bound below the best found is left.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalscope.llm.common import WORD_CHARS, Words, groups, text_bytes, written

SEGMENT_BYTES = 8 << 20  # text in a segment
SEGMENT_ROWS = 4096  # documents in a segment
TASK_POSTINGS = 4 << 20  # postings searched by one task
BLOCK_TERMS = 4096  # terms looked at together
WIDTHS = (8, 32, 128, 256)  # intervals split at once, round by round
NAMELESS = np.iinfo(np.int64).max  # stands for a null doc_id: sorts last

INDEX = "segment long, term long, docs array<long>, counts array<int>"


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of every word, and how many words each text has."""
    data, starts = text_bytes(column)
    hashes, of, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, last in groups(starts):
        a, b = starts[first], starts[last]
        words = Words(data[a:b], starts[first : last + 1] - a, WORD_CHARS)
        hashes.append(words.hash)
        of.append(words.text_of() + first)
        counts.append(words.counts())
    return np.concatenate(hashes), np.concatenate(of), np.concatenate(counts)


def _segments(batch: pa.RecordBatch):
    """Ranges of rows that make a segment."""
    _, starts = text_bytes(batch.column("text"))
    for first, last in groups(starts, SEGMENT_BYTES):
        for at in range(first, last, SEGMENT_ROWS):
            yield at, min(last, at + SEGMENT_ROWS)


def _listed(segment: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of one segment: its documents, by length, and the postings of each of its terms."""
    hashes, of, counts = _words(rows.column("text"))
    order = np.argsort(counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_place = np.argsort(place[of], kind="stable")
    hashes, docs = hashes[by_place], place[of][by_place]
    by_term = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[by_term], docs[by_term]
    new_term = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
    first = np.flatnonzero(new_term | np.concatenate([[True], docs[1:] != docs[:-1]])[: len(docs)])
    often = np.diff(first, append=len(docs))
    starts = np.flatnonzero(new_term[first])
    n = len(order)
    offsets = pa.array(np.concatenate([[0, n], n + starts[1:], [n + len(first)]] if len(starts) else [[0, n]]), pa.int32())
    terms = pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(hashes[first][starts].view(np.int64))])
    names = rows.column("doc_id").take(pa.array(order))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(terms), segment), pa.int64()), terms,
        pa.ListArray.from_arrays(offsets, pa.concat_arrays([names, pa.array(docs[first])])),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([counts[order], often]), pa.int32()))], ["segment", "term", "docs", "counts"])


def index(docs: DataFrame) -> DataFrame:
    """Rows (segment, term, docs, counts) over all documents, written to the shared folder: segments are numbered where they
    are read, so that a search must not work them out anew. Save them elsewhere to search them in another session.

    Terms are letters A to Z, digits and non-ASCII characters in a row, A to Z lower-cased, as 64-bit hashes. A segment's row
    without a term has the doc_id of its documents and their numbers of terms; the others have places among these documents, and
    how often the term stands there. Nothing is shuffled. Null texts have no terms; rows with repeated or null doc_id are
    documents of their own, other columns are left behind, an empty table gives no rows.
    """

    def run(batches):
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last in _segments(batch):
                yield _listed(made, batch.slice(first, last - first))
                made += 1
        pa.default_memory_pool().release_unused()

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, INDEX), "index")


def _terms(items: DataFrame) -> DataFrame:
    """Rows (item_id, term): the distinct terms of each item."""

    def run(batches):
        for batch in batches:
            hashes, of, _ = _words(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(of)), pa.array(hashes.view(np.int64))], ["item_id", "term"])

    item_id = items.select("item_id").schema
    return items.select("item_id", F.col("text")).mapInArrow(run, f"item_id {item_id[0].dataType.simpleString()}, term long").distinct()


class _Segment:
    """Posting lists of some terms in one segment, with impacts and range maxima."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, starts: np.ndarray, n_docs: int):
        self.docs, self.impacts, self.n_docs, self.starts = docs, impacts, n_docs, starts[:-1]
        #: rank[t, d]: postings of term t in documents before d
        self.rank = np.zeros((len(terms), n_docs + 1), np.uint16)
        self.rank[np.repeat(np.arange(len(terms)), np.diff(starts)), docs + 1] = 1
        np.cumsum(self.rank, axis=1, out=self.rank)
        #: best[k, i]: the posting of greatest impact among i up to i + 2**k, of use inside one list
        longest = int(np.diff(starts).max(initial=1))
        levels = [np.arange(len(docs), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            half = 1 << (len(levels) - 1)
            one, other = levels[-1], levels[-1].copy()
            other[:-half] = one[half:]
            levels.append(np.where(impacts[other] > impacts[one], other, one))
        self.best = np.stack(levels)

    def bound(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval of documents: the sum of its terms' greatest impacts, and the document with the greatest one."""
        a, b = self.rank[terms[:, None], low].astype(np.int64), self.rank[terms[:, None], high].astype(np.int64)
        some = b > a
        level = _LOG[b - a]
        base = self.starts[terms][:, None]
        left = self.best[level, np.where(some, base + a, 0)]
        right = self.best[level, np.where(some, base + b - (1 << level), 0)]
        x, y = self.impacts[left], self.impacts[right]
        most = np.where(some, np.maximum(x, y), 0)
        top = most.argmax(axis=0), np.arange(len(low))
        return most.sum(axis=0), self.docs[np.where(x >= y, left, right)[top]]

    def score(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        a = self.rank[terms[:, None], docs].astype(np.int64)
        there = self.rank[terms[:, None], docs + 1] > a
        return np.where(there, self.impacts[np.where(there, self.starts[terms][:, None] + a, 0)], 0).sum(axis=0)


_LOG = np.zeros(SEGMENT_ROWS + 1, np.int64)
_LOG[2:] = np.log2(np.arange(2, SEGMENT_ROWS + 1)).astype(np.int64)


class _Best(NamedTuple):
    """The best documents so far: scores and ids, the best one first."""

    scores: np.ndarray
    ids: np.ndarray

    def least(self, k: int) -> int:
        """What a document must score to count; equal scores may still win by their id."""
        return int(self.scores[k - 1]) if len(self.scores) == k else 1

    def joined(self, scores: np.ndarray, ids: np.ndarray, k: int) -> _Best:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:k]
        return _Best(scores[order], ids[order])


def _search(segment: _Segment, terms: np.ndarray, ids: np.ndarray, best: _Best, k: int) -> _Best:
    """The k best documents of those found so far and this segment's."""
    low, high = np.zeros(1, np.int64), np.full(1, segment.n_docs)
    bound, split = segment.bound(terms, low, high)
    turn = 0
    while True:
        open_ = bound >= best.least(k)
        low, high, bound, split = low[open_], high[open_], bound[open_], split[open_]
        if not len(low):
            return best
        width = WIDTHS[min(turn, len(WIDTHS) - 1)]
        turn += 1
        now = np.zeros(len(low), bool)
        now[np.argpartition(-bound, width - 1)[:width] if len(low) > width else slice(None)] = True
        at = split[now]
        scores = segment.score(terms, at)
        good = scores >= best.least(k)
        best = best.joined(scores[good], ids[at[good]], k)
        begin, end = np.concatenate([low[now], at + 1]), np.concatenate([at, high[now]])
        some = end > begin
        begin, end = begin[some], end[some]
        more, where = segment.bound(terms, begin, end)
        low, high = np.concatenate([low[~now], begin]), np.concatenate([high[~now], end])
        bound, split = np.concatenate([bound[~now], more]), np.concatenate([split[~now], where])


def _blocks(questions: list[np.ndarray]):
    """Ranges of items whose distinct terms are at most BLOCK_TERMS; an item with more is a range of its own."""
    first, seen = 0, np.zeros(0, np.int64)
    for at, terms in enumerate(questions):
        joined = np.union1d(seen, terms)
        if len(joined) > BLOCK_TERMS and at > first:
            yield first, at, seen
            first, joined = at, terms
        seen = joined
    if len(questions) > first:
        yield first, len(questions), np.unique(seen)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and starts of lists."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten()
    if values.null_count:
        values = values.fill_null(NAMELESS)
    return values.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])


def _searcher(n_docs: int, n_terms: int, k: int):
    def search(lists: pa.Table, asked: pa.Table) -> pa.Table:
        names = asked.column("item_id").to_pylist()
        terms, starts = _flat(asked.column("terms"))
        weights, _ = _flat(asked.column("weights"))
        items = [(terms[a:b], weights[a:b]) for a, b in zip(starts, starts[1:])]
        weight = dict(zip(terms.tolist(), weights.tolist()))
        best = [_Best(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        lists = lists.sort_by([("segment", "ascending"), ("term", "ascending")])  # the row of documents comes last
        segments = lists.column("segment").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(segments)) + 1, [len(segments)]])
        for first, last in zip(cuts, cuts[1:]) if len(segments) and items else ():
            part = lists.slice(first, last - first)
            docs, at = _flat(part.column("docs"))
            counts, _ = _flat(part.column("counts"))
            known = part.column("term").slice(0, len(part) - 1).to_numpy()
            ids, lengths = docs[at[-2] :], counts[at[-2] :].astype(np.int64)
            worth = np.repeat(np.array([weight[t] for t in known.tolist()], np.int64), np.diff(at[:-1]))
            often = counts[: at[-2]].astype(np.int64)
            places = docs[: at[-2]]
            impacts = worth * (1_000_000_000 * often // (1000 * often + 8 * (10 + 90 * lengths[places] * n_docs // n_terms)))
            for from_, to, some in _blocks([t for t, _ in items]):
                mine = np.flatnonzero(np.isin(known, some))
                if not len(mine):
                    continue
                pick = np.concatenate([np.arange(at[i], at[i + 1]) for i in mine])
                segment = _Segment(known[mine], places[pick], impacts[pick], np.concatenate([[0], np.cumsum(at[mine + 1] - at[mine])]), len(ids))
                for i in range(from_, to):
                    here = np.flatnonzero(np.isin(known[mine], items[i][0]))
                    if len(here):
                        best[i] = _search(segment, here, ids, best[i], k)
        out = [pa.array([name for name, b in zip(names, best) for _ in b.ids], asked.schema.field("item_id").type)]
        ids = np.concatenate([b.ids for b in best]) if best else np.zeros(0, np.int64)
        scores = np.concatenate([b.scores for b in best]) if best else np.zeros(0, np.int64)
        return pa.Table.from_arrays([*out, pa.array(ids, pa.int64(), mask=ids == NAMELESS), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    return search


def search(made: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each item its k documents with the highest scores above 0 in index `made`.

    A document scores weight * (1e9 * often div (1000 * often + 8 * m)) for each distinct term of the item that it holds, where
    weight = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + 90 n N div L: N documents with terms, L terms in all, n in
    this document, df documents with the term. Equal scores rank by doc_id, null last. Rows of one item_id, null too, are
    one item; items without terms, and terms that no document holds, find nothing. An empty table on either side gives no
    rows. The items go to every task that searches; each task holds some segments' lists of their terms.
    """
    asked = written(_terms(items), "asked")
    wanted = written(asked.select("term").distinct(), "wanted")
    totals = made.where("term IS NULL").select(F.filter("counts", lambda n: n > 0).alias("counts")).agg(
        F.sum(F.size("counts")).alias("docs"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n)).alias("terms")).first()
    n_docs, n_terms = int(totals["docs"] or 0), int(totals["terms"] or 0)
    lists = written(made.where("term IS NOT NULL").join(wanted, "term", "left_semi").select("segment", "term", "docs", "counts"), "lists")
    held = written(lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df")), "held")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    pairs = asked.join(held, "term").select("item_id", F.struct("term", weight.alias("weight")).alias("pair"))
    questions = pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("pair")).alias("pairs"))
    questions = questions.select("item_id", F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("weights"))
    tasks = max(1, -(-(held.agg(F.sum("df")).first()[0] or 0) // TASK_POSTINGS))
    share = F.pmod(F.xxhash64("segment"), F.lit(tasks)).cast("int").alias("task")
    parts = lists.unionByName(made.where("term IS NULL").select("segment", "term", "docs", "counts")).withColumn("task", share)
    everywhere = questions.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    found = parts.groupBy("task").cogroup(everywhere.groupBy("task")).applyInArrow(
        _searcher(n_docs, n_terms, k), f"item_id {items.select('item_id').schema[0].dataType.simpleString()}, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def oracle(k: int = 10) -> str:
    """search() of all documents for the benchmark as DuckDB SQL."""
    terms = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
    return f"""WITH q AS (SELECT DISTINCT item_id, unnest({terms}) AS t FROM benchmark),
d AS (SELECT doc_id, {terms} AS ts FROM documents),
a AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, cast(sum(len(ts)) AS bigint) AS n_terms FROM d),
p AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, cast(len(ts) AS bigint) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS bigint) AS w FROM p, a GROUP BY t, n_docs),
s AS (SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS bigint) AS score
  FROM q JOIN w USING (t) JOIN p USING (t), a GROUP BY ALL),
r AS (SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {k}"""
