"""Stretches of words that repeat with a period, found in the grammar that recompression makes of the texts.

Some texts are laid in a row, each between separators of its own, and recompressed: runs of one symbol become one symbol, then
symbols are parted into left and right ones by a coin and each left one followed by a right one becomes one symbol, and so on in
turns. Equal stretches are compressed alike but for a symbol at their ends a level, so climbing the levels and coming down
again tells how far two places agree, forwards or backwards, in steps as many as there are levels. What could be a run of
period q shows equal words on the grid of every q-th place, from which both extensions give its exact ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import appended, groups, mix, text_bytes

LEAST = 24  # words in a run
EXPONENT = 3  # periods in a run
TEXT_BYTES = 4 << 20  # texts split into words at once
ROW_WORDS = 1 << 17  # words recompressed at once; a longer text is a row of its own
ASKED = 1 << 14  # places extended at once

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class Level(NamedTuple):
    """One round: the symbols before it, and which of them each symbol after it stands for."""

    symbols: np.ndarray
    above: np.ndarray  # the symbol after the round that holds each one before
    start: np.ndarray  # the first that each symbol after the round holds, and the end
    right: np.ndarray | None  # by symbol: to the right in pairs; None for a round of blocks


class Grammar:
    """Rounds of block and pair compression until no symbol is left twice. The row begins and ends with symbols of their own."""

    def __init__(self, row: np.ndarray, names: int):
        self.levels: list[Level] = []
        blocks, turn = True, 0
        while self._repeats(row, names):
            if blocks:
                right = None
                begins = np.concatenate([[True], row[1:] != row[:-1]])
            else:
                turn += 1
                right = (mix(row.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)).astype(bool)
                begins = np.concatenate([[True], right[:-1] | ~right[1:]])
            blocks = not blocks
            start = np.flatnonzero(begins)
            if len(start) == len(row):
                continue
            held = np.diff(start, append=len(row))
            after = row[start]
            joint = np.flatnonzero(held > 1)
            second = held[joint] if right is None else row[start[joint] + 1]
            kinds, which = np.unique((after[joint] << np.int64(32)) | second, return_inverse=True)
            after[joint] = names + which
            names += len(kinds)
            self.levels.append(Level(row, (np.cumsum(begins) - 1).astype(np.int32), np.append(start, len(row)).astype(np.int32), right))
            row = after
        self.mirrored = [Level(x.symbols[::-1], (len(x.start) - 2 - x.above)[::-1], (len(x.symbols) - x.start)[::-1],
                               None if x.right is None else ~x.right[::-1]) for x in self.levels]

    @staticmethod
    def _repeats(row: np.ndarray, names: int) -> bool:
        seen = np.zeros(names, bool)
        seen[row] = True
        return np.count_nonzero(seen) < len(row)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on are those from j on (i and j differ)."""
        return _agree(self.levels, i, j)

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i are those before j."""
        n = len(self.levels[0].symbols) if self.levels else 0
        return _agree(self.mirrored, n - i, n - j)


def _agree(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    p, q = i.astype(np.int64), j.astype(np.int64)
    top = np.full(len(p), len(levels))  # the level at which p and q are known to differ
    going = np.arange(len(p))
    for h, level in enumerate(levels):  # climb over what agrees
        a, b = p[going], q[going]
        same = level.symbols[a] == level.symbols[b]
        top[going[~same]] = h
        going, a, b = going[same], a[same], b[same]
        if not len(going):
            break
        if level.right is None:
            above, over = level.above[a], level.above[b]
            inside = (level.start[above] != a) | (level.start[over] != b)
            left, rest = level.start[above + 1] - a, level.start[over + 1] - b
            step = np.where(inside, np.minimum(left, rest), 0)
            a, b = a + step, b + step
            ended = inside & (left != rest)
            p[going[ended]], q[going[ended]], top[going[ended]] = a[ended], b[ended], h
            going, a, b = going[~ended], a[~ended], b[~ended]
        else:
            step = level.right[a]  # what stands to the right may be half a pair
            a, b = a + step, b + step
        p[going], q[going] = level.above[a], level.above[b]
    for h in range(len(levels) - 1, -1, -1):  # come down to the first difference
        level = levels[h]
        on = np.flatnonzero(top > h)
        if not len(on):
            continue
        above, over = p[on], q[on]
        a, b = level.start[above].astype(np.int64), level.start[over].astype(np.int64)
        same = level.symbols[a] == level.symbols[b]
        step = same if level.right is not None else np.where(same, np.minimum(level.start[above + 1] - a, level.start[over + 1] - b), 0)
        p[on], q[on] = a + step, b + step
    return p - i


def _grid(row: np.ndarray, period: int, least: int, exponent: int) -> np.ndarray:
    """Places on the grid of every period-th one from which on as many agree as a run covers at least."""
    on = row[::period]
    same = on[1:] == on[:-1]
    more = max(exponent, least // period) - 1  # equal neighbours on the grid
    if len(same) < more:
        return np.zeros(0, np.int64)
    if more == 2:
        return np.flatnonzero(same[1:] & same[:-1]) * period
    total = np.concatenate([[0], np.cumsum(same)])
    return np.flatnonzero(total[more:] - total[:-more] == more) * period


class _Found:
    """The runs of a row so far."""

    def __init__(self, row: np.ndarray, names: int, least: int, exponent: int):
        self.row, self.names, self.least, self.exponent = row, names, least, exponent
        self.grammar: Grammar | None = None
        self.runs: dict[tuple[int, int], int] = {}
        self.period = np.zeros(len(row), np.int32)  # of a run known to hold a place, and where that ends
        self.end = np.zeros(len(row), np.int32)

    def unknown(self, place: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Not inside a known run of a period that divides this one: there the same run would be found again."""
        known = self.period[place]
        return (known == 0) | (period % np.maximum(known, 1) != 0) | (place + period >= self.end[place])

    def extend(self, place: np.ndarray, period: np.ndarray) -> None:
        self.grammar = self.grammar or Grammar(self.row, self.names)
        while len(place):
            now, later = slice(None, ASKED), slice(ASKED, None)
            at, by = place[now], period[now]
            begin, end = at - self.grammar.behind(at, at + by), at + by + self.grammar.ahead(at, at + by)
            long = end - begin >= np.maximum(self.least, self.exponent * by)
            for b, e, q in np.unique(np.stack([begin[long], end[long], by[long]], axis=1), axis=0).tolist():
                if q < self.runs.get((b, e), q + 1):
                    self.runs[b, e] = q
                    self.period[b:e], self.end[b:e] = q, e
            place, period = place[later], period[later]
            if len(place):
                new = self.unknown(place, period)
                place, period = place[new], period[new]


def runs_of(texts: list[np.ndarray], names: int, least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, a text being an array of word numbers below `names`."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    separators = names + np.arange(len(texts) + 1)
    row = np.concatenate([separators[:1], *chain.from_iterable((t, separators[k + 1 : k + 2]) for k, t in enumerate(texts))]).astype(np.int64)
    found = _Found(row, names + len(texts) + 1, least, exponent)
    places: list[np.ndarray] = []
    periods: list[np.ndarray] = []
    waiting = 0
    for period in range(1, max(map(len, texts), default=0) // exponent + 1):
        place = _grid(row, period, least, exponent)
        if len(place):
            by = np.full(len(place), period)
            new = found.unknown(place, by)
            places.append(place[new])
            periods.append(by[new])
            waiting += len(places[-1])
            if waiting >= ASKED:
                found.extend(np.concatenate(places), np.concatenate(periods))
                places, periods, waiting = [], [], 0
    if waiting:
        found.extend(np.concatenate(places), np.concatenate(periods))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (b, e), q in sorted(found.runs.items(), key=lambda x: (x[0][0], x[1])):
        k = int(np.searchsorted(ends, b))  # text k takes the places after ends[k - 1] up to ends[k]
        out[k].append((b - 1 - (int(ends[k - 1]) if k else 0), e - b, q))
    return out


def _rows(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Texts to lay in one row: of like length, about ROW_WORDS words in all."""
    order = np.argsort(sizes, kind="stable")
    total = np.cumsum(sizes[order])
    first = 0
    while first < len(order):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + ROW_WORDS, "right")))
        yield order[first:last]
        first = last


def find(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """docs with n_words, runs (array of start, length, period; by start, then period) and collapsed.

    Words are what stands between white space (x20, x09 to x0D) of the whole text, as they are; null has none. A run is a
    stretch of words, `least` of them and `exponent` times its smallest period at least, that no neighbouring word extends
    with that period. collapsed is the words joined by one space, without those that a run holds after its first period.
    `rewrite` may change a document's words first. Texts don't matter to one another; repeated rows have equal answers,
    columns with the new names are replaced (`rewrite` sees doc_id; without that column, None), an empty table gives no rows.
    A text is held by one task, at about a hundred bytes a word.
    """
    ids = "doc_id" in docs.columns

    def compute(batch):
        data, starts = text_bytes(batch.column("text"))
        raw = data.tobytes()
        names = batch.column("doc_id").to_pylist() if ids else [None] * batch.num_rows
        counts: list[int] = []
        runs: list[list[dict]] = []
        left: list[str] = []
        for first, last in groups(starts, TEXT_BYTES):
            words = [raw[starts[k] : starts[k + 1]].split() for k in range(first, last)]
            if rewrite:
                words = [rewrite(names[first + k], w) for k, w in enumerate(words)]
            for found, own in zip(_runs(words, least, exponent), words):
                counts.append(len(own))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                left.append(_collapsed(own, found))
        return [counts, runs, left]

    return appended(docs, compute, "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def _runs(words: list[list[bytes]], least: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    sizes = np.array([len(w) for w in words])
    coded = pa.array(chain.from_iterable(words), pa.large_binary()).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for chosen in _rows(sizes):
        chosen = chosen[sizes[chosen] >= least]
        if len(chosen):
            for k, found in zip(chosen, runs_of([numbers[cuts[k] : cuts[k + 1]] for k in chosen], len(coded.dictionary), least, exponent)):
                out[k] = found
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    parts, at = [], 0
    for start, length, period in runs:  # by start: what earlier runs dropped ends at `at` at the latest
        if start + period > at:
            parts += words[at : start + period]
        at = max(at, start + length)
    return b" ".join(parts + words[at:]).decode()


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. Null without runs."""
    better = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(better(best, run), run).otherwise(best))


def lines(runs: Column) -> Column:
    """`start,length,period` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
