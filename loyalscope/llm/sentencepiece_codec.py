"""SentencePiece encoding by a table of prefixes, and decoding.

BPE pieces of a text are found without merging: for every prefix of a word, the last piece of the prefix's encoding is the
one automaton match ending there that is compatible with the last piece of what stands before it. Two pieces are compatible
if the two, put together, are encoded as just these two. The ids are then read off backwards from the end of the word. The words
of some texts are worked out together, each distinct one once.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import appended, groups, release, text_bytes

SPACE = "▁"
#: Words in the younger of two generations of known ones; when it is full it becomes the older one, which is forgotten then.
REMEMBERED = 80_000
LONGEST = 64  # letters of a word that is remembered
PAIRS = 400_000  # tests of pairs that a worker keeps
TEXT_BYTES = 1 << 19  # text whose words are worked out together; a worker holds them and their ids at once
#: Runs of spaces with the characters behind them; no piece joins a character and a space behind it. A line break stands alone.
_UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


class Numbers:
    """Numbers by non-negative 63-bit keys, looked up many at a time: an open hash table of a fixed number of places."""

    def __init__(self, bits: int, dtype=np.int32):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, dtype)
        self.used = 0

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._first(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):  # taken by others: the next place
            at[todo] = (at[todo] + 1) & self.mask
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are not there yet, each once."""
        self.used += len(keys)
        at = self._first(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = keys[todo[free]]  # of several that want one place one gets it
            won = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[won]]] = values[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    def clear(self) -> None:
        self.keys.fill(-1)
        self.used = 0


class Codec:
    """Encoder and decoder for a SentencePiece BPE model with byte fallback and no normalisation but a leading space."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or proto.trainer_spec.model_type != 2:
            raise ValueError("only BPE models without normalisation are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        normal = {p.piece: (p.score, i) for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece joins a character and a space behind it")
        self.score = {p: s for p, (s, _) in normal.items()}
        self.id = {p: i for p, (_, i) in normal.items()}
        self.chars = {p for p in normal if len(p) == 1}
        self._plan_unions()
        # a piece that merging never reaches can't stand in an encoding; one with an unknown character neither
        reached = {p: i for p, i in self.id.items() if p in self.chars or p in self.halves}
        self.automaton = ahocorasick.Automaton()
        for piece, i in reached.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self._plan_steps(reached)
        self.length = [len(p) for p in self.pieces]
        self.lengths = np.array(self.length)
        self.digits = [str(i) for i in range(len(self.pieces))]
        self.utf8 = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if p.type == 3 else p.piece.replace(SPACE, " ").encode()
                     for i, p in enumerate(proto.pieces)]
        self.pairs = Numbers(20, np.int8)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The definition: of all neighbours whose union is a piece, the best-scored, leftmost pair is united, again and again."""
        return self._united(text)[0]

    def _united(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """merged(), and the two parts that were united last."""
        parts, last = list(text), None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _plan_unions(self) -> None:
        """When each piece is made: by rank, if none is made before its parts and no two have one score. Pieces of spaces alone may."""
        longer = sorted((p for p in self.score if len(p) > 1), key=lambda p: -self.score[p])
        words = [p for p in longer if p.strip(SPACE)]
        self.rank = {p: i for i, p in enumerate(longer)}
        self.halves = {}
        for piece in longer:
            if set(piece) <= self.chars:
                parts, last = self._united(piece)
                if parts == [piece]:
                    self.halves[piece] = last
        made = lambda p: self.rank.get(p, -1)
        self.ranked = len(set(map(self.score.get, words))) == len(words) and all(made(p) > max(map(made, self.halves[p])) for p in words if p in self.halves)
        self.sides: dict[tuple[str, int], list[tuple[str, float, float]]] = {}

    def _side(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """What stands at the piece's left (0) or right (1) end while it is made, from which rank on and until which."""
        got = self.sides.get((piece, side))
        if got is None:
            got, until, part = [], math.inf, piece
            while part in self.halves:
                got.append((part, self.rank[part], until))
                until, part = self.rank[part], self.halves[part][side]
            got.append((part, -1, until))
            self.sides[piece, side] = got
        return got

    def apart(self, left: str, right: str) -> bool:
        """Whether two pieces stay two when put together: what stands at either side of the border is never united.

        Unions go by rank. Parts that exist at one time are united if they make a piece, unless the left one is used up at that
        very rank, which comes first; the right one being used up at that rank comes later.
        """
        if not self.ranked or not left.strip(SPACE):
            return self.merged(left + right) == [left, right]
        if right[0] == SPACE:
            return True
        for x, from_x, to_x in self._side(left, 1):
            for y, from_y, to_y in self._side(right, 0):
                if from_y < to_x and from_x <= to_y:
                    rank = self.rank.get(x + y)
                    if rank is not None:
                        at = max(rank, from_x, from_y)
                        if at < to_x and at <= to_y:
                            return False
        return True

    def _compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether pieces a and b stay apart, for pairs a << 20 | b."""
        answers = self.pairs.find(pairs)
        new = np.unique(pairs[answers < 0])
        if len(new):
            if self.pairs.used + len(new) > PAIRS:
                self.pairs.clear()
                new = np.unique(pairs)
            pieces = self.pieces
            tested = np.array([self.apart(pieces[k >> 20], pieces[k & 0xFFFFF]) for k in new.tolist()], np.int8)
            if len(new) > PAIRS:  # more than the table takes: for these texts alone
                return tested[np.searchsorted(new, pairs)] == 1
            self.pairs.add(new, tested)
            answers = self.pairs.find(pairs)
        return answers == 1

    def _plan_steps(self, pieces: dict[str, int]) -> None:
        """The automaton's steps from node to node as a table, for many words at a time."""
        nodes: dict[tuple[int, str], int] = {}
        ends = [-1]
        for piece, i in pieces.items():
            at = 0
            for c in piece:
                step = nodes.get((at, c))
                if step is None:
                    step = nodes[at, c] = len(ends)
                    ends.append(-1)
                at = step
            ends[at] = i
        self.piece_at = np.array(ends, np.int32)
        self.steps = Numbers(max(4, (4 * len(nodes)).bit_length()))
        self.steps.add(np.array([a << 21 | ord(c) for a, c in nodes], np.int64), np.array(list(nodes.values()), np.int32))
        self.longest = max(map(len, pieces), default=0)

    def _segment_all(self, words: list[str]) -> list[bytes]:
        """The ids of each word as 32-bit integers in a row; all characters are known. The prefix tables of all words are filled
        side by side, from the shortest prefixes to the longest."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        begin, end = np.repeat(begins, sizes), np.repeat(ends, sizes)
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        starts, stops, pieces = [], [], []
        for k in range(self.longest):  # all matches, by their length
            node = self.steps.find(node << 21 | codes[at + k])
            on = node >= 0
            at, node = at[on], node[on].astype(np.int64)
            piece = self.piece_at[node]
            hit = piece >= 0
            starts.append(at[hit])
            stops.append(at[hit] + k + 1)
            pieces.append(piece[hit])
            on = at + k + 1 < end[at]
            at, node = at[on], node[on]
            if not len(at):
                break
        start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(pieces).astype(np.int64)
        prefix = stop - begin[start]  # letters of the prefix that the match ends
        order = np.argsort(prefix, kind="stable")
        start, stop, piece = start[order], stop[order], piece[order]
        cuts = np.cumsum(np.bincount(prefix))
        last = np.full(len(codes) + 1, -1, np.int64)  # the last piece of the prefix that ends with a letter
        for a, b in zip(cuts, cuts[1:]):
            s, p = start[a:b], piece[a:b]
            fits = s == begin[s]
            inner = np.flatnonzero(~fits)
            fits[inner] = self._compatible(last[s[inner] - 1] << 20 | p[inner])
            last[stop[a:b][fits] - 1] = p[fits]
        if (last[:-1] < 0).any():
            raise AssertionError("a prefix without a last piece")
        steps, whose = [], []
        at, word = ends - 1, np.arange(len(words))
        while len(at):
            found = last[at]
            steps.append(found)
            whose.append(word)
            at = at - self.lengths[found]
            on = at >= begins[word]
            at, word = at[on], word[on]
        counts = np.bincount(np.concatenate(whose), minlength=len(words)) if whose else np.zeros(0, np.int64)
        firsts = np.cumsum(counts) - counts
        ids = np.empty(counts.sum(), "<i4")
        for k, (found, word) in enumerate(zip(steps, whose)):
            ids[firsts[word] + counts[word] - 1 - k] = found
        raw = ids.tobytes()
        return [raw[4 * a : 4 * (a + n)] for a, n in zip(firsts.tolist(), counts.tolist())]

    def _segment(self, text: str) -> list[int]:
        """Ids of characters that are all known, by the prefix table."""
        last: list[int] = []  # the last piece of each prefix
        done, pairs = 0, {}
        for end, (length, piece) in self.automaton.iter(text):
            if end == done:
                start = end - length
                if start >= 0:
                    pair = last[start], piece
                    answer = pairs.get(pair)
                    if answer is None:
                        answer = pairs[pair] = self.apart(self.pieces[pair[0]], self.pieces[piece])
                    if not answer:
                        continue
                last.append(piece)
                done += 1
        if done < len(text):
            raise AssertionError(f"no piece ends at {done} of {text!r}")
        ids, end = [], done - 1
        while end >= 0:
            piece = last[end]
            ids.append(piece)
            end -= self.length[piece]
        ids.reverse()
        return ids

    def _unit(self, unit: str) -> list[int]:
        if self.chars.issuperset(unit):
            return self._segment(unit)
        ids, known = [], ""
        for c in unit:
            if c in self.chars:
                known += c
                continue
            ids += self._segment(known) if known else []
            ids += [self.bytes[b] for b in c.encode()]
            known = ""
        return ids + (self._segment(known) if known else [])

    def known(self, units: set[str]) -> dict[str, bytes]:
        """The ids of each unit as 32-bit integers in a row."""
        young, old = self.young, self.old
        out = {unit: young[unit] for unit in units & young.keys()}
        rest = units - out.keys()
        again = {unit: old[unit] for unit in rest & old.keys()}
        rest -= again.keys()
        plain = [unit for unit in rest if len(unit) <= LONGEST and self.chars.issuperset(unit)]
        if plain:
            again.update(zip(plain, self._segment_all(plain)))
        for unit in rest - again.keys():  # long, or with characters that no piece has
            ids = self._unit(unit)
            out[unit] = struct.pack(f"<{len(ids)}i", *ids)
        out.update(again)
        young.update(again)
        if len(young) >= REMEMBERED:
            self.old, self.young = young, {}
        return out

    def units(self, text: str) -> list[str]:
        return _UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        units = self.units(text)
        return np.frombuffer(b"".join(map(self.known(set(units)).__getitem__, units)), "<i4").tolist()

    def raw(self, ids: Iterable[int]) -> bytes:
        """The UTF-8 bytes of ids, spaces restored; control ids stand for nothing."""
        return b"".join(map(self.utf8.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, without the leading space that encoding adds. Bytes that are no UTF-8 become U+FFFD."""
        out = self.raw(ids).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


@lru_cache(1)
def _codec(model: bytes) -> Codec:
    return Codec(model)


def _digested(codec: Codec, batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    texts = [codec.units(value or "") for value in batch.column("text").to_pylist()]
    known = codec.known(set(chain.from_iterable(texts)))
    counts, hashes, decoded, packed = [], [], [], []
    for units in texts:
        row = b"".join(map(known.__getitem__, units))
        ids = np.frombuffer(row, "<i4").tolist()
        counts.append(len(ids))
        hashes.append(hashlib.sha256(",".join(map(codec.digits.__getitem__, ids)).encode()).hexdigest())
        decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        if "token_ids" in schema.names:
            packed.append(row)
    columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
    return pa.RecordBatch.from_arrays(columns + [pa.array(packed, pa.binary())] * (len(schema) - 4), schema=schema)


def digests(docs: DataFrame, model: bytes, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (ids joined by commas), decoded_sha256 and, if asked for, token_ids:
    the ids as little-endian 32-bit integers, one behind the other.

    Whole texts; null text is empty and has no ids. Repeated rows stay, other columns are left behind, an empty table gives
    no rows. The model file (a few hundred kilobytes) goes to the tasks with the function.
    """
    schema = OUT.append(pa.field("token_ids", pa.binary())) if with_ids else OUT

    def run(batches):
        codec = _codec(model)
        for batch in batches:
            for first, last in groups(text_bytes(batch.column("text"))[1], TEXT_BYTES):
                yield _digested(codec, batch.slice(first, last - first), schema)
        release()

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "token_ids") -> DataFrame:
    """All columns of docs with the ids of each text as an array (null text: no ids). An existing column `into` is replaced."""
    return _mapped(docs, text, into, "array<int>", lambda codec: lambda value: codec.encode(value or ""), model)


def decode(docs: DataFrame, model: bytes, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """All columns of docs with the text of each array of ids (null: null)."""
    return _mapped(docs, ids, into, "string", lambda codec: lambda value: None if value is None else codec.decode(value), model)


def _mapped(docs: DataFrame, source: str, into: str, kind: str, make: Callable, model: bytes) -> DataFrame:
    def compute(batch):
        call = make(_codec(model))
        name = source if source in batch.schema.names else f"_given_{source}"
        return [[call(v.as_py()) for v in batch.column(name)]]

    return appended(docs, compute, f"`{into}` {kind}")
