"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton recognises every run of words of every item. Training words stream through it, and the length of the longest
run that ends at each word tells which words lie in a whole window of an item.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import WORD_CHARS, Words, appended, groups, text_bytes

WINDOW = 13
#: Items are put into automata of about this much text each; every automaton is one pass of the documents.
BLOCK_BYTES = 4 << 20


class Automaton:
    """All runs of words of the items of one block."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int = WINDOW):
        """items: (item_id, hashes of its words); those without words are no items."""
        items = [(i, w) for i, w in items if len(w)]
        self.window = window
        self.vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
        self.following: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        words = [(i, np.searchsorted(self.vocabulary, w).tolist()) for i, w in items]
        for _, run in words:
            state = 0
            for word in run:
                state = self._extend(state, word)
        self.items: list[set[int]] = [set() for _ in self.link]
        self.whole: dict[int, list[tuple[int, int]]] = {}  # state: short items that end there, with their length
        for item, run in words:
            state = 0
            for word in run:
                state = self.following[state][word]
                up = state
                while up > 0 and item not in self.items[up]:
                    self.items[up].add(item)
                    up = self.link[up]
            if len(run) < window:
                self.whole.setdefault(state, []).append((len(run), item))
        #: No run of words that is shorter than this holds a window.
        self.least = min([window, *(len(run) for _, run in words)])
        self.found = lru_cache(1 << 14)(self._found)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "found"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.found = lru_cache(1 << 14)(self._found)

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.following.append(following)
        return len(self.length) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """A copy of the state for the shorter runs alone, to which the shorter ways now lead."""
        copy = self._new(self.length[before] + 1, self.link[state], dict(self.following[state]))
        self.link[state] = copy
        while before >= 0 and self.following[before].get(word) == state:
            self.following[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        there = self.following[last].get(word)
        if there is not None:  # another item already went this way
            return there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
        new, before = self._new(self.length[last] + 1, 0, {}), last
        while before >= 0 and word not in self.following[before]:
            self.following[before][word] = new
            before = self.link[before]
        if before >= 0:
            there = self.following[before][word]
            self.link[new] = there if self.length[there] == self.length[before] + 1 else self._split(before, word, there)
        return new

    def _found(self, state: int, matched: int) -> tuple[int, frozenset[int]]:
        """Of the run of `matched` words that ends in the state: length of its longest window, items with such windows."""
        longest, items = 0, set()
        at, length = state, matched
        while at > 0:
            if min(length, self.length[at]) >= self.window > self.length[self.link[at]]:
                longest = self.window
                items |= self.items[at]
            for size, item in self.whole.get(at, ()):
                if size <= length:
                    longest = max(longest, size)
                    items.add(item)
            at = self.link[at]
            length = self.length[at]
        return longest, frozenset(items)

    def scan(self, run: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of the run's words (numbers in the vocabulary) that lie in windows, and the items they are of."""
        following, link, length = self.following, self.link, self.length
        state, matched, spans, items = 0, 0, [], set()
        for i, word in enumerate(run):
            after = following[state].get(word)
            while after is None and state > 0:
                state = link[state]
                matched = length[state]
                after = following[state].get(word)
            if after is None:
                continue
            state, matched = after, matched + 1
            if matched >= self.least:
                longest, of = self.found(state, matched)
                if longest:
                    items |= of
                    if spans and spans[-1][1] >= i + 1 - longest:
                        start = spans[-1][0]
                        while spans and spans[-1][1] >= i + 1 - longest:
                            start = min(spans.pop()[0], i + 1 - longest)
                        spans.append((start, i + 1))
                    else:
                        spans.append((i + 1 - longest, i + 1))
        return spans, items

    def texts(self, words: Words) -> tuple[list[list[tuple[int, int]]], list[set[int]]]:
        """Spans and items for each text."""
        n = len(words.first) - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        items: list[set[int]] = [set() for _ in range(n)]
        if not len(self.vocabulary) or not len(words.hash):
            return spans, items
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words.hash
        new = np.zeros(len(known), dtype=bool)
        firsts = words.first[:-1][words.counts() > 0]
        new[firsts] = True
        begin = np.flatnonzero(known & (new | ~np.concatenate([[False], known[:-1]])))
        last = np.flatnonzero(known & np.concatenate([new[1:] | ~known[1:], [True]]))
        long = last - begin + 1 >= self.least
        text = np.searchsorted(words.first, begin[long], "right") - 1
        for a, b, t in zip(begin[long].tolist(), last[long].tolist(), text.tolist()):
            found, of = self.scan(at[a : b + 1].tolist())
            base = a - int(words.first[t])
            spans[t] += [(base + x, base + y) for x, y in found]
            items[t] |= of
        return spans, items


def blocks(benchmark: DataFrame, size: int = BLOCK_BYTES) -> list[list[tuple[int, bytes]]]:
    """The items in blocks of about `size` bytes of text. Items without an id or text are no items."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-total // size))
    block = F.pmod(F.xxhash64("item_id"), F.lit(count))
    for k in range(count):
        yield [(r["item_id"], r["text"]) for r in rows.where(block == k).orderBy("item_id", "text").collect()]


def item_words(items: list[tuple[int, str]]) -> list[tuple[int, np.ndarray]]:
    data, starts = text_bytes(pa.array([t for _, t in items], pa.string()))
    words = Words(data, starts, WORD_CHARS)
    return [(i, words.hash[a:b]) for (i, _), a, b in zip(items, words.first, words.first[1:])]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_BYTES) -> DataFrame:
    """All columns of docs with n_words, hit_spans (array of word spans, end exclusive) and hit_items (array of item ids).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is `window` consecutive words of
    an item, or the whole of a shorter item. Whole texts stream through the automaton; null and empty texts have no words.
    Items are used once per id, items with equal texts are all reported. An empty benchmark hits nothing, an empty table
    gives no rows, columns with the three names are replaced. A large benchmark is cut into automata of bounded size,
    which the documents pass one after the other, without a shuffle.
    """
    return _public(_matched(docs, benchmark, window, size), ["n_words", "hit_spans", "hit_items"])


def _public(rows: DataFrame, names: list[str]) -> DataFrame:
    """Columns that were worked out under names of their own take the place of any that have these."""
    return rows.drop(*names).withColumnsRenamed({f"_{n}": n for n in names})


def _matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_BYTES) -> DataFrame:
    context = docs.sparkSession.sparkContext
    rows = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_hit_spans": F.array().cast("array<struct<begin:int,end:int>>"),
                             "_hit_items": F.array().cast("array<bigint>")})
    for items in blocks(benchmark, size):
        rows = _pass(rows, context.broadcast(Automaton(item_words(items), window)))
    return rows


def _pass(rows: DataFrame, shared) -> DataFrame:
    def compute(batch):
        data, starts = text_bytes(batch.column("text"))
        counts, spans, items = [], [], []
        for first, last in groups(starts):
            a, b = starts[first], starts[last]
            words = Words(data[a:b], starts[first : last + 1] - a, WORD_CHARS)
            counts += words.counts().tolist()
            found = shared.value.texts(words)
            spans += found[0]
            items += found[1]
        before = [[(s["begin"], s["end"]) for s in x] for x in batch.column("_given__hit_spans").to_pylist()]
        merged = [[{"begin": a, "end": b} for a, b in _union(x + y)] for x, y in zip(before, spans)]
        known = [sorted(set(x) | y) for x, y in zip(batch.column("_given__hit_items").to_pylist(), items)]
        return [counts, merged, known]

    return appended(rows, compute, "_n_words long, _hit_spans array<struct<begin:int,end:int>>, _hit_items array<bigint>")


def _judged(docs: DataFrame, benchmark: DataFrame, per_cent: int) -> DataFrame:
    hit = F.aggregate("_hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]).cast("long"))
    rows = _matched(docs, benchmark).withColumn("_n_hit", hit).withColumn("_n_items", F.size("_hit_items").cast("long"))
    return rows.withColumn("_contaminated", (F.col("_n_hit") > 0) & (F.col("_n_hit") * 100 >= F.col("_n_words") * per_cent))


def judge(docs: DataFrame, benchmark: DataFrame, per_cent: int = 5) -> DataFrame:
    """match() with n_hit (words inside windows), n_items and contaminated (n_hit is at least `per_cent` of the words)."""
    return _public(_judged(docs, benchmark, per_cent), ["n_words", "hit_spans", "hit_items", "n_hit", "n_items", "contaminated"])


def uncontaminated(docs: DataFrame, benchmark: DataFrame, per_cent: int = 5) -> DataFrame:
    """The rows of docs that judge() calls clean, with just their own columns."""
    return _judged(docs, benchmark, per_cent).where("NOT _contaminated").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of docs, the text without the words that lie in windows (one space in place of each span)."""
    rows = _matched(docs, benchmark)

    def compute(batch):
        out = []
        for text, spans in zip(batch.column("_given_text").to_pylist(), batch.column("_hit_spans").to_pylist()):
            if spans:
                raw = text.encode()
                words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), WORD_CHARS)
                parts, at = [], 0
                for s in spans:
                    parts.append(raw[at : words.begin[s["begin"]]])
                    at = words.end[s["end"] - 1]
                text = b" ".join([*parts, raw[at:]]).decode()
            out.append(text)
        return [out]

    return appended(rows, compute, "text string").select(*docs.columns)


def oracle(window: int = WINDOW, per_cent: int = 5) -> str:
    """judge() as DuckDB SQL, with the digest of the item ids."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    grams = "[{'p': p, 'g': array_to_string(ws[p:p + k - 1], ' ')} for p in range(1, len(ws) - k + 2)]"
    return f"""WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
b AS (SELECT item_id, {words} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item_id, k, x.g AS g FROM (SELECT item_id, k, unnest({grams}) AS x
  FROM (SELECT item_id, ws, least({window}, len(ws)) AS k FROM b WHERE len(ws) > 0))),
m AS (SELECT s.doc_id, s.k, s.x.p AS p, win.item_id FROM (SELECT doc_id, k, unnest({grams}) AS x
  FROM d, (SELECT DISTINCT k FROM win) AS ks WHERE len(ws) >= k) AS s JOIN win ON win.k = s.k AND win.g = s.x.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n, string_agg(t, ',' ORDER BY t) AS ids FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS t FROM m) GROUP BY 1)
SELECT d.doc_id, cast(len(ws) AS bigint) AS n_words, cast(coalesce(h.n, 0) AS bigint) AS n_hit, cast(coalesce(i.n, 0) AS bigint) AS n_items,
sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND coalesce(h.n, 0) * 100 >= len(ws) * {per_cent} AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id"""
