"""Repeated passages removed by a distributed, common-prefix-aware merge sort of suffixes.

Every window of WINDOW bytes holds an anchor: the leftmost of its grams with the smallest hash. Equal windows have their
anchor at the same place, so it is enough to sort the suffixes that begin at anchors, each with the stretch of text of the
windows it stands for. Anchors whose gram occurs once in the corpus are left out beforehand.

Each chunk of documents sorts its suffixes into a run, front-codes it (length of the prefix shared with the entry before,
then the rest) and cuts it at splitters. A task merges the runs of its range with a loser tree whose nodes know the length
of the prefix shared with the last winner, so that no known prefix is ever compared again, and the order's common prefixes
come out with it. Entries with equal stretches are repeats as a whole; of those that share a gram only, windows are matched
one by one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import chunk_count, groups, mix, pack, text_bytes, unpack

WINDOW = 100
GRAM = 24
_SPAN = WINDOW - GRAM + 1  # grams of a window
SAMPLE = 400  # documents that the splitters are worked out from; they balance the tasks, and never change a result

_rng = np.random.default_rng(5)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the gram that begins at each byte, but for the last GRAM - 1."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers(len(data), _BASE), out=sums[1:])
    return mix((sums[GRAM:] - sums[:-GRAM]) * _powers(n, _INVERSE))


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash) of all anchors in some texts, as byte positions in data."""
    out = []
    for first, last in groups(starts):
        base, end = int(starts[first]), int(starts[last])
        value = gram_hashes(data[base:end])
        if len(value) < _SPAN:
            continue
        # smallest hash in ever longer stretches, and where it is; of equal ones the leftmost
        low, at, width = value, np.arange(len(value), dtype=np.int32), 1
        while width * 2 <= _SPAN:
            left = low[:-width] <= low[width:]
            low, at = np.where(left, low[:-width], low[width:]), np.where(left, at[:-width], at[width:])
            width *= 2
        rest = _SPAN - width
        if rest:
            at = np.where(low[:-rest] <= low[rest:], at[:-rest], at[rest:])
        # windows inside one text
        begins, ends = starts[first:last] - base, starts[first + 1 : last + 1] - base
        whole = np.repeat(ends, ends - begins)[: len(at)] - np.arange(len(at)) >= WINDOW
        window = np.flatnonzero(whole)
        if not len(window):
            continue
        at = at[window]
        new = np.ones(len(window), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
        i0 = np.flatnonzero(new)
        i1 = np.append(i0[1:], len(window)) - 1
        a = at[i0]
        out.append((a.astype(np.int64) + base, window[i0] + base, window[i1] + base, value[a]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)


def key_of(raw: bytes, a: int, i0: int, i1: int) -> bytes:
    """What an entry is sorted by: the gram, how far the stretch reaches, the rest of it, and what stands before, backwards."""
    return raw[a : a + GRAM] + bytes((i1 + WINDOW - a, a - i0)) + raw[a + GRAM : i1 + WINDOW] + raw[i0:a][::-1]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    low, high = known, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def front_coded(keys: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted keys as lengths of the prefix shared with the key before, and the rests."""
    shared, rests, before = [], [], b""
    for key in keys:
        n = common_prefix(before, key, 0)
        shared.append(n)
        rests.append(key[n:])
        before = key
    return shared, rests


class LoserTree:
    """Merges front-coded sorted runs. Equal keys come in the order of their runs."""

    def __init__(self, runs: list[tuple[list[int], list[bytes]]]):
        self.runs = runs
        self.width = 1
        while self.width < len(runs):
            self.width *= 2
        self.at = [0] * self.width
        self.key: list[bytes | None] = [r[1][0] if r[1] else None for r in runs] + [None] * (self.width - len(runs))
        self.shared = [0] * self.width  # of a run's head: length of the prefix it shares with the last winner
        self.loser = [0] * self.width
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        winner, self.loser[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser). The loser then knows the prefix it shares with the winner."""
        x, y = self.key[a], self.key[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.shared[a], self.shared[b]
        if p != q:  # the one that shares more with the last winner is the smaller; the other shares just as little with it
            return (a, b) if p > q else (b, a)
        n = common_prefix(x, y, p)
        if n == len(x) and n == len(y):
            a, b = min(a, b), max(a, b)
        elif n == len(x) or (n < len(y) and x[n] < y[n]):
            pass
        else:
            a, b = b, a
        self.shared[b] = n
        return a, b

    def __iter__(self) -> Iterator[tuple[int, int, bytes, int]]:
        """(run, place in it, key, prefix shared with the key before)."""
        key, shared, loser, runs, match = self.key, self.shared, self.loser, self.runs, self._match
        while (head := key[self.winner]) is not None:
            w = self.winner
            place = self.at[w]
            yield w, place, head, shared[w]
            prefixes, rests = runs[w]
            place += 1
            if place < len(rests):
                n = prefixes[place]
                key[w], shared[w], self.at[w] = head[:n] + rests[place], n, place
            else:
                key[w] = None
            node = (w + self.width) // 2
            while node:
                w, loser[node] = match(w, loser[node])
                node //= 2
            self.winner = w


def _bundle(**columns) -> bytes:
    import zstandard

    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _opened(body: bytes) -> pa.Table:
    import zstandard

    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)) as stream:
        return stream.read_all()


def _rows(schema: pa.Schema, columns: list[list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


HASHES = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("body", pa.binary())])
MARKS = pa.schema([("chunk", pa.int32()), ("body", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _hashes(parts: int):
    def run(key, blobs):
        """The grams at a chunk's anchors, dealt by value; those met twice here are marked in the last bit."""
        *_, value = anchors(*text_bytes(unpack(blobs).column("text")))
        value, counts = np.unique(value & ~np.uint64(1), return_counts=True)
        value |= (counts > 1).astype(np.uint64)
        part = (mix(value >> np.uint64(1)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(bounds))
        return _rows(HASHES, [full.tolist(), [key[0].as_py()] * len(full), [value[order[bounds[p] : bounds[p + 1]]].tobytes() for p in full]])

    return run


def _repeated(key, rows):
    """Of grams dealt here, those that occur twice in the corpus, for every chunk that holds them."""
    bodies = [np.frombuffer(b, np.uint64) for b in rows.column("body").to_pylist()]
    all_ = np.concatenate(bodies)
    value, inverse, counts = np.unique(all_ >> np.uint64(1), return_inverse=True, return_counts=True)
    twice = counts > 1
    twice[inverse[(all_ & np.uint64(1)) == 1]] = True
    keep, at, out = twice[inverse], 0, []
    for b in bodies:
        out.append((b[keep[at : at + len(b)]] & ~np.uint64(1)).tobytes())
        at += len(b)
    names = rows.column("chunk").to_pylist()
    return _rows(MARKS, [[n for n, o in zip(names, out) if o], [o for o in out if o]])


def _intervals(body_rows) -> pa.Table:
    """Rows (chunk, body) of marks (row, start, end)."""
    return _rows(MARKS, [[c for c, _ in body_rows], [np.ascontiguousarray(np.stack(m, axis=1).astype(np.int64)).tobytes() for _, m in body_rows]])


def _runs(splitters: list[bytes]):
    def run(key, blobs, hashes):
        """A chunk's suffixes as front-coded runs, one for each range that it has suffixes of; entries equal to an earlier
        one of the chunk go no further: their windows are marked at once (a row whose part is negative)."""
        chunk = key[0].as_py()
        table = unpack(blobs)
        data, starts = text_bytes(table.column("text"))
        if not hashes.num_rows:
            return _rows(HASHES, [[], [], []])
        wanted = np.sort(np.concatenate([np.frombuffer(b, np.uint64) for b in hashes.column("body").to_pylist()]))
        a, i0, i1, value = anchors(data, starts)
        value &= ~np.uint64(1)
        at = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
        some = wanted[at] == value
        a, i0, i1 = a[some], i0[some], i1[some]
        doc = np.searchsorted(starts, a, "right") - 1
        raw = data.tobytes()
        earliest: dict[bytes, int] = {}
        repeats = []
        for k, (x, y, z) in enumerate(zip(a.tolist(), i0.tolist(), i1.tolist())):
            if earliest.setdefault(key_of(raw, x, y, z), k) != k:
                repeats.append(k)
        out: list[list] = [[], [], []]
        if repeats:
            r = np.array(repeats)
            base = starts[doc[r]]
            out = [[-1 - chunk], [chunk], [np.ascontiguousarray(np.stack([doc[r], i0[r] - base, i1[r] + WINDOW - base], axis=1).astype(np.int64)).tobytes()]]
        keys = sorted(earliest)
        order = np.array([earliest[k] for k in keys], dtype=np.int64)
        ids = table.column("doc_id").fill_null(2**63 - 1).to_numpy()
        bounds = [0, *(bisect_left(keys, s) for s in splitters), len(keys)]
        for part, (x, y) in enumerate(zip(bounds, bounds[1:])):
            if x == y:
                continue
            shared, rests = front_coded(keys[x:y])
            k = order[x:y]
            base = starts[doc[k]]
            out[0].append(part)
            out[1].append(chunk)
            out[2].append(_bundle(shared=pa.array(shared, pa.int16()), rest=pa.array(rests, pa.binary()), doc_id=ids[doc[k]],
                                  row=doc[k].astype(np.int32), a=(a[k] - base).astype(np.int32)))
        return _rows(HASHES, out)

    return run


def _merged(key, rows):
    """The marks of one range: runs are merged and repeats found. Marks made earlier pass through."""
    part = key[0].as_py()
    if part < 0:
        return _rows(MARKS, [rows.column("chunk").to_pylist(), rows.column("body").to_pylist()])
    chunks = rows.column("chunk").to_pylist()
    # runs in order of their chunks: the order that the rows came in must not matter
    order = sorted(range(len(chunks)), key=chunks.__getitem__)
    chunks = [chunks[i] for i in order]
    tables = [_opened(rows.column("body")[i].as_py()) for i in order]
    runs = [(t.column("shared").to_pylist(), t.column("rest").to_pylist()) for t in tables]
    ids, doc_rows, at = ([t.column(c).to_numpy() for t in tables] for c in ("doc_id", "row", "a"))
    marks: list[tuple[int, int, int, int]] = []  # chunk, row, start, end
    group: list[tuple[int, int, int, int, bytes]] = []  # the entries that share a gram, each stretch once, by its earliest entry
    matched: list[list[tuple[int, int, int, int, bytes]]] = []

    def whole(entry) -> tuple[int, int, int, int]:
        _, row, a, chunk, k = entry
        return chunk, row, a - k[GRAM + 1], a + k[GRAM]

    for run, place, k, shared in LoserTree(runs):
        entry = (int(ids[run][place]), int(doc_rows[run][place]), int(at[run][place]), chunks[run], k)
        if group and shared >= GRAM:
            if shared == len(k) == len(group[-1][4]):
                first, second = (group[-1], entry) if group[-1][:3] < entry[:3] else (entry, group[-1])
                group[-1] = first
                marks.append(whole(second))
            else:
                group.append(entry)
            continue
        if len(group) > 1:
            matched.append(group)
        group = [entry]
    if len(group) > 1:
        matched.append(group)
    found = [np.array(marks, dtype=np.int64).reshape(-1, 4)]
    for batch in _batches(matched, 20_000):
        found.append(match_windows(batch))
    found = np.concatenate(found)
    found = found[np.argsort(found[:, 0], kind="stable")]
    names, first = np.unique(found[:, 0], return_index=True)
    return _rows(MARKS, [names.tolist(), [np.ascontiguousarray(found[x:y, 1:]).tobytes() for x, y in zip(first, [*first[1:], len(found)])]])


def _batches(groups_: list[list], size: int) -> Iterator[list[list]]:
    """Whole groups, of about `size` entries together."""
    held, n = [], 0
    for g in groups_:
        held.append(g)
        n += len(g)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def match_windows(matched: list[list[tuple[int, int, int, int, bytes]]]) -> np.ndarray:
    """Rows (chunk, row, start, end) of the windows that an earlier entry of their group has as well.

    Windows are compared by the group, the anchor's place in them, and 64-bit hashes of what stands before and behind it.
    """
    entries = [e for g in matched for e in g]
    group = np.repeat(np.arange(len(matched)), [len(g) for g in matched]).astype(np.uint64)
    reach = np.array([e[4][GRAM] for e in entries])
    back = np.array([e[4][GRAM + 1] for e in entries])
    right = np.zeros((len(entries), WINDOW), np.uint8)
    left = np.zeros((len(entries), _SPAN), np.uint8)
    for i, (_, _, _, _, k) in enumerate(entries):
        n = k[GRAM]
        right[i, :n] = np.frombuffer(k[:GRAM] + k[GRAM + 2 : n + 2], np.uint8)
        left[i, : k[GRAM + 1]] = np.frombuffer(k[n + 2 :], np.uint8)
    powers = _powers(WINDOW, _BASE)
    ahead = np.zeros((len(entries), WINDOW + 1), np.uint64)
    np.cumsum(_VALUE[right] * powers, axis=1, out=ahead[:, 1:])
    behind = np.zeros((len(entries), _SPAN + 1), np.uint64)
    np.cumsum(_VALUE[left] * powers[:_SPAN], axis=1, out=behind[:, 1:])
    count = reach + back - WINDOW + 1  # windows from a - back up to a + reach - WINDOW
    entry = np.repeat(np.arange(len(entries)), count)
    step = np.arange(len(entry)) - np.repeat(count.cumsum() - count, count)
    before = back[entry] - step  # bytes of the window before the anchor
    value = mix(ahead[entry, WINDOW - before]) + mix(behind[entry, before] ^ np.uint64(0x51ED270B)) * np.uint64(3)
    value = mix(value ^ mix(group[entry] * np.uint64(128) + before.astype(np.uint64)))
    doc, row, a, chunk = (np.array([e[c] for e in entries], dtype=np.int64)[entry] for c in range(4))
    start = a - before
    order = np.lexsort((start, row, doc))
    _, first = np.unique(value[order], return_index=True)
    again = np.ones(len(order), dtype=bool)
    again[first] = False
    hit = order[again]
    hit = hit[np.lexsort((start[hit], row[hit], chunk[hit]))]
    if not len(hit):
        return np.zeros((0, 4), dtype=np.int64)
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (chunk[hit][1:] != chunk[hit][:-1]) | (row[hit][1:] != row[hit][:-1]) | (start[hit][1:] > start[hit][:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(hit)) - 1
    return np.stack([chunk[hit[begin]], row[hit[begin]], start[hit[begin]], start[hit[last]] + WINDOW], axis=1)


def _spans(marks: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Maximal marked stretches of each row."""
    out: dict[int, list[tuple[int, int]]] = {}
    for row, a, b in marks[np.lexsort((marks[:, 1], marks[:, 0]))].tolist():
        spans = out.setdefault(row, [])
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return out


def _kept(with_text: bool):
    def run(key, blobs, marks):
        table = unpack(blobs)
        data, starts = text_bytes(table.column("text"))
        bodies = [np.frombuffer(b, np.int64).reshape(-1, 3) for b in marks.column("body").to_pylist()]
        spans = _spans(np.concatenate(bodies)) if bodies else {}
        out: list[list] = [[], [], [], []]
        texts = []
        for row, (a, b) in enumerate(zip(starts.tolist(), starts[1:].tolist())):
            raw = data[a:b].tobytes()
            cut = spans.get(row, [])
            rest, end = [], 0
            for x, y in cut:
                rest.append(raw[end:x])
                end = y
            rest = b"".join([*rest, raw[end:]])
            for column, value in zip(out, (len(raw), len(raw) - len(rest), len(cut), hashlib.sha256(rest).hexdigest())):
                column.append(value)
            texts.append(rest.decode("utf-8", "ignore") if cut else table.column("text")[row].as_py())
        made = pa.Table.from_arrays([table.column("doc_id").cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(out, list(OUT)[1:])]], schema=OUT)
        return made.append_column("clean_text", pa.array(texts, pa.string())) if with_text else made

    return run


def splitters(docs: DataFrame, parts: int, sample: int = SAMPLE) -> list[bytes]:
    """Grams that cut the sorted suffixes of a bounded sample of documents, picked by a hash, into equal ranges."""
    rows = docs.where("text IS NOT NULL").select("text", F.xxhash64("doc_id").alias("o")).orderBy("o").limit(sample).select("text").toArrow()
    data, starts = text_bytes(rows.column("text"))
    raw = data.tobytes()
    keys = sorted({raw[x : x + GRAM] for x in anchors(data, starts)[0].tolist()})
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []


def deduplicate(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, clean_text.

    Each byte covered by a string of WINDOW bytes that also starts earlier (in a smaller doc_id, or earlier in the same
    document) is removed; overlaps count, and all is judged on the given texts. Null and empty texts are zero bytes and
    lose none. Of rows repeated under one doc_id the one with the smaller text comes first, rows without a doc_id come
    last. An empty table gives no rows; other columns are left behind. clean_text drops bytes that a cut leaves of a
    character. Grams and windows are compared by 64-bit hashes, suffixes byte by byte.
    """
    docs = docs.select("doc_id", "text")
    chunks = chunk_count(docs)
    cuts = splitters(docs, chunks)
    blobs = pack(docs, chunks)
    dealt = blobs.groupBy("chunk").applyInArrow(_hashes(chunks), "part int, chunk int, body binary")
    repeated = dealt.groupBy("part").applyInArrow(_repeated, "chunk int, body binary")
    runs = blobs.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(_runs(cuts), "part int, chunk int, body binary")
    marks = runs.groupBy("part").applyInArrow(_merged, "chunk int, body binary")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", clean_text string" if with_text else "")
    return blobs.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(_kept(with_text), kinds)
