"""Language-model scores from a hierarchical Pitman-Yor process over trigrams, seated by Gibbs sampling.

Three levels of restaurants: a leaf for the two words before a token, its parent for the one word before, and the root,
which all contexts share; a dish is a word. Every context of the training texts has its restaurant. Customers of a leaf are
the tokens; each table of a restaurant is a customer of its parent. The state is the number of tables of each dish in each
restaurant; how customers sit at them is integrated out with generalised Stirling numbers. A sweep draws the tables of every
dish from their distribution given all else, restaurants side by side. Predictive probabilities use averages over the samples
behind the burn-in.

Chunks of documents name their words by hashes once, and get numbers for them, in the order of the hashes. They count their
trigrams and send each to the part that the word before belongs to. So a part holds whole restaurants, leaves and parents,
keeps the trigrams of all chunks merged, and counts their totals; the root's customers are summed word by word over all parts
after each round of sweeps and handed to the next. A part answers every chunk with the customers and tables behind its own
trigrams; a chunk then scores its documents. Each step is written, and its shuffle files and what no later step reads are
removed.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalscope.llm.common import NOT_SPACE, Words, chunk_count, groups, mix, pack, text_bytes, unpack, written
from loyalscope.session import last_written, remove, shuffles_removed, written_apart

CHUNK_BYTES = 4 << 20
#: Sweeps of a round, and rounds: after each, the root's customers are summed over all parts.
BURN_IN, SAMPLES = 4, 4
ROUNDS = 2
#: Discount and strength of leaf, parent and root restaurants.
DISCOUNT = (0.8, 0.75, 0.6)
STRENGTH = (2.0, 2.0, 2.0)
#: The hash of the token that ends every text.
END = np.uint64(0xE7D0F7E47)
#: What stands before the first token of a text, as a context: number 0; words are numbered from 1 on.
START = np.uint64(0x57A27)
#: Stirling numbers are tabulated up to so many tables and customers.
TABLE, CUSTOMERS = 192, 8192
#: Weights drawn from at once.
BLOCK = 1 << 18

OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                 ("base_score", pa.float64()), ("score", pa.float64())])
#: Messages between chunks, parts and the root's parts: a body each. Kinds of each table: words or texts; trigrams, the numbers of a
#: chunk's among them, or tables; tables or answers. A negative source or target is part -1 - it.
TEXTS, WORDS = 0, 1
TRIGRAMS, PLACES, TABLES, ANSWERS = 0, 1, 2, 3
MAIL = "kind int, target int, source int, body binary"
SUMS = "target int, source int, body binary, customers double, words long, tokens long"


def held_out(doc_id: int | None, folds: int = 7, fold: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first token of each text and the end) of all tokens; an end token stands behind every text."""
    hashes, firsts = [], []
    total = 0
    for first, last in groups(starts):
        a, b = starts[first], starts[last]
        words = Words(data[a:b], starts[first : last + 1] - a, NOT_SPACE)
        n = last - first
        h = np.full(len(words.hash) + n, END, np.uint64)
        inner = np.ones(len(h), dtype=bool)
        inner[words.first[1:] + np.arange(n)] = False
        h[inner] = words.hash
        hashes.append(h)
        firsts.append(words.first[:-1] + np.arange(n) + total)
        total += len(h)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(hashes, np.uint64), np.append(join(firsts, np.int64), total).astype(np.int64)


def trigrams(before: np.ndarray, second: np.ndarray, word: np.ndarray, n: int, n_before: int) -> tuple[np.ndarray, ...]:
    """Distinct trigrams of word numbers below n (the word before: below n_before), ordered by the word before, the second before
    and the word: (before, second, word, number of each given one's trigram)."""
    if n_before * n * n < 1 << 63:
        found, number = np.unique((before * n + second) * n + word, return_inverse=True)
        context, word = np.divmod(found, n)
        return context // n, context % n, word, number
    context, at = np.unique(before * n + second, return_inverse=True)
    both, number = np.unique(at * n + word, return_inverse=True)
    context = context[both // n]
    return context // n, context % n, both % n, number


def root_part(h: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of hashes, so that words ordered by hash are ordered by part."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


@dataclass
class Chunk:
    """A chunk's distinct trigrams, as numbers of its own words, ordered by part; and the number of each token's trigram."""

    part: np.ndarray
    words: tuple[np.ndarray, np.ndarray, np.ndarray]  # the word before, the second before, the word
    number: np.ndarray


def _chunk(text: dict[str, np.ndarray]) -> Chunk:
    word = text["word"].astype(np.int64)
    before, second = np.empty_like(word), np.empty_like(word)
    first = np.cumsum(text["n_tokens"]) - text["n_tokens"]
    for out, given in ((before, word), (second, before)):
        out[1:] = given[:-1]
        out[first] = 0
    by = np.argsort(text["part"], kind="stable")
    rank = np.empty_like(by)
    rank[by] = np.arange(len(by))
    v, x, w, number = trigrams(rank[before], second, word, len(by), len(by))
    return Chunk(text["part"][by[v]], (by[v], x, w), number)


def _stirling(discount: float, customers: int, tables: int) -> np.ndarray:
    """[c, t]: the logarithm of the generalised Stirling number, the weight of all ways to seat c customers at t tables."""
    log = np.full((customers + 1, tables + 2), -np.inf)
    log[0, 0] = 0
    t = np.arange(1, tables + 2)
    for c in range(1, customers + 1):
        with np.errstate(divide="ignore"):
            log[c, 1:] = np.logaddexp(log[c - 1, :-1], log[c - 1, 1:] + np.log(np.maximum(c - 1 - discount * t, 0)))
    return log


def _alone(discount: float) -> np.ndarray:
    """[c, t]: the chance that a given one of c customers has one of the dish's t tables to himself."""
    log = _stirling(discount, TABLE, TABLE)
    out = np.zeros((TABLE + 1, TABLE + 2))
    with np.errstate(invalid="ignore"):
        out[1:, 1:] = np.where(np.isfinite(log[1:, 1:]), np.exp(log[:-1, :-1] - log[1:, 1:]), 0)
    return out


_LOGS: dict[float, np.ndarray] = {}


def _log_weights(discount: float, c: np.ndarray, most: int) -> np.ndarray:
    """Rows of log Stirling weights of 1 up to `most` tables (at most TABLE), but for a constant a row.

    They are exact up to CUSTOMERS customers; beyond, the ratio of neighbours goes to its limit 1 / (discount t) as c**-discount does.
    """
    if discount not in _LOGS:
        _LOGS[discount] = _stirling(discount, CUSTOMERS, TABLE)
    log = _LOGS[discount][np.minimum(c, CUSTOMERS), 1 : most + 1]
    far = c > CUSTOMERS
    if far.any():
        limit = 1 / (discount * np.arange(1, most))
        known = np.exp(np.diff(_LOGS[discount][CUSTOMERS, 1 : most + 1]))
        ratio = limit - (limit - known) * ((CUSTOMERS / c[far]) ** discount)[:, None]
        log[far, 0] = 0
        log[far, 1:] = np.log(ratio).cumsum(axis=1)
    return log


def _many(c: np.ndarray, discount: float, weight) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the tables of c customers, for many of both.

    Tables of all sizes are Poisson variables conditioned on their sum c: with weight a of a new table, a x (1 - x)**(d - 1) = c
    gives x, and a (1 - (1 - x)**d) / d tables are expected. weight(t) is a and the slope of its logarithm at t tables.
    """
    t = np.sqrt(c)
    for _ in range(60):
        a = weight(t)[0]
        ratio = np.log(a / c)
        y = np.minimum(np.maximum(ratio / (1 - discount), -700.0), -c / (a + c))  # log(1 - x), by Newton's steps
        for _ in range(60):
            e = np.exp(y)
            step = (ratio + np.log1p(-e) + (discount - 1) * y) / (discount - 1 - e / (1 - e))
            y = np.clip(y - step, -700.0, y / 64)
            if (np.abs(step) <= 1e-9 * np.abs(y)).all():
                break
        after = np.clip(a * -np.expm1(discount * y) / discount, 1, c)
        done = (np.abs(after - t) <= 1e-5 * t).all()
        t = after
        if done:
            break
    a, slope = weight(t)
    x = -np.expm1(y)
    spread = c + a * (1 - discount) * x**2 * np.exp((discount - 2) * y)
    own = np.maximum(t - c**2 / spread, 1e-9)
    return t, np.sqrt(1 / np.maximum(1 / own - slope, 0.1 / own))


def draw(rng, c, others, level, customers, tables, rest_chance, total):
    """Tables of dishes with c customers each, drawn from their distribution given all else; it does not depend on tables so far.

    others: tables of the restaurant's other dishes. customers, tables: those of the dish in the restaurant above, of `total`
    customers there, without its customers from here; each table here adds one. rest_chance: what its tables there leave to the dish.
    """
    discount, strength = DISCOUNT[level], STRENGTH[level]
    taken = DISCOUNT[level + 1] * np.maximum(tables, 1)
    t = np.ones(len(c), dtype=np.int64)
    rest = np.flatnonzero(c > 1)
    large = rest[c[rest] > TABLE]
    if len(large):
        o, n, g = others[large], customers[large] - taken[large], STRENGTH[level + 1] + total[large]
        left = rest_chance[large]

        def weight(t):
            a = (strength + discount * (o + t)) * (np.maximum(n + t, 0) + left) / (g + t)
            return a, discount / (strength + discount * (o + t)) + 1 / (np.maximum(n + t, 0) + left) - 1 / (g + t)

        mean, deviation = _many(c[large].astype(np.float64), discount, weight)
        many = mean > TABLE / 3
        t[large[many]] = np.clip(np.rint(rng.normal(mean[many], deviation[many])), 1, c[large[many]])
        rest = np.concatenate([rest[c[rest] <= TABLE], large[~many]])
    wide = np.minimum(c[rest], TABLE)
    for low, most in zip((1, 2, 4, 8, 16, 32, 64), (2, 4, 8, 16, 32, 64, TABLE)):
        rows = rest[(wide > low) & (wide <= most)]
        if most == 2:  # one table or two
            log = _log_weights(discount, np.array([2]), 2)[0]
            above = np.maximum(customers[rows] + 1 - taken[rows], 0) + rest_chance[rows]
            two = np.exp(log[1] - log[0]) * (strength + discount * (others[rows] + 1)) * above / (STRENGTH[level + 1] + total[rows] + 1)
            t[rows] = 1 + (1 < rng.random(len(rows)) * (1 + two))
            continue
        for first in range(0, len(rows), BLOCK // most):
            r = rows[first : first + BLOCK // most]
            i = np.arange(most)
            above = np.maximum(customers[r, None] + i - taken[r, None], 0) + rest_chance[r, None]
            ratio = (strength + discount * (others[r, None] + i)) * above / (STRENGTH[level + 1] + total[r, None] + i)
            log = _log_weights(discount, c[r], most)
            if most <= 8:  # without logarithms nothing this small overflows
                w = (ratio.cumprod(axis=1) * np.exp(log)).cumsum(axis=1)
            else:
                log = np.log(ratio).cumsum(axis=1) + log
                w = np.exp(log - log.max(axis=1, keepdims=True)).cumsum(axis=1)
            t[r] = 1 + (w < rng.random((len(r), 1)) * w[:, -1:]).sum(axis=1)
    return np.minimum(t, c)


def root_chance(customers: np.ndarray, total: float | np.ndarray, words: int) -> np.ndarray:
    """The root's chance of words with so many customers there, of `total` over all `words` words; one word is unknown."""
    return (np.maximum(customers - DISCOUNT[2], 0) + unknown(words)) / (STRENGTH[2] + total)


def unknown(words: int) -> float:
    """What the root's tables, one a word, leave to each word and to the unknown one."""
    return (STRENGTH[2] + DISCOUNT[2] * words) / (words + 1)


def seat(restaurant: np.ndarray, word: np.ndarray, c: np.ndarray, start: int | np.ndarray, seed: int, up: np.ndarray | None = None, given: tuple[np.ndarray, float, int] | None = None) -> dict[str, np.ndarray]:
    """Sample the tables of the pairs (leaf restaurant, word number) with c customers each; they start with `start` tables at most.

    up: the parent restaurant of each leaf restaurant (half its number unless given); all leaves of a parent must be here, so
    totals of restaurants are counted. given: the root's customers of each word, of all words, and the number of words, when
    other pairs of these words are elsewhere.
    Returns the averages over the samples: t of each pair, the parent's c and t (`mid`: the parent dish of each pair), and
    the root's c of each word.
    """
    rng = np.random.default_rng(seed)
    words, n = int(word.max()) + 1, int(restaurant.max()) + 1
    up = np.arange(n) // 2 if up is None else up
    c = c.astype(np.int64)
    middle, mid = np.unique(up[restaurant].astype(np.int64) * words + word, return_inverse=True)
    above, mid_word = middle // words, middle % words
    m = int(above.max()) + 1
    # a single customer has a single table: only the others, and their dishes in the parent, are drawn again and counted anew
    t = np.minimum(c, start)
    drawn = np.flatnonzero(c > 1)
    moving = np.flatnonzero(np.bincount(mid, c) > 1)
    still = np.ones(len(middle), dtype=bool)
    still[moving] = False
    leaf_t = np.bincount(restaurant[c <= 1], t[c <= 1], n)
    parent_t, root_t = np.bincount(above[still], minlength=m), np.bincount(mid_word[still], minlength=words)
    at = np.searchsorted(moving, mid[drawn])  # the parent dish of each drawn one
    mid_fixed = np.bincount(mid[c <= 1], t[c <= 1], len(middle))[moving]
    restaurants, turn, above_moving, word_moving = restaurant[drawn], restaurant[drawn] % 2, above[moving], mid_word[moving]
    c_drawn, t_drawn = c[drawn], t[drawn].astype(np.int64)
    mid_c = (mid_fixed + np.bincount(at, t_drawn, len(moving))).astype(np.int64)
    mid_t = np.ones(len(moving), dtype=np.int64)
    root = root_t + np.bincount(word_moving, mid_t, words)
    # the leaves of a parent take turns
    turns = [np.flatnonzero(turn == k) for k in (0, 1)]
    sums = [np.zeros(len(drawn)), np.zeros(len(moving)), np.zeros(len(moving)), np.zeros(words)]
    one = np.ones(len(moving))
    for sweep in range(BURN_IN + SAMPLES):
        top, total, known = (root, root.sum(), words) if given is None else given
        for several in turns:
            r, dish = restaurants[several], at[several]
            own = t_drawn[several]
            without = mid_c[dish] - own
            tables = np.minimum(mid_t[dish], without)
            gone = mid_t[dish] - tables
            a = above_moving[dish]
            all_t, all_c = (parent_t + np.bincount(above_moving, mid_t, m))[a], (parent_t + np.bincount(above_moving, mid_c, m))[a]
            p = root_chance(np.maximum(top[word_moving[dish]] - gone, 0), np.maximum(total - gone, 0), known)
            t_drawn[several] = draw(rng, c_drawn[several], (leaf_t + np.bincount(restaurants, t_drawn, n))[r] - own, 0, without, tables, (STRENGTH[1] + DISCOUNT[1] * (all_t - gone)) * p, all_c - own)
            mid_c = (mid_fixed + np.bincount(at, t_drawn, len(moving))).astype(np.int64)
            mid_t = np.minimum(mid_t, mid_c)
        own = np.minimum(mid_t, mid_c)
        others = (parent_t + np.bincount(above_moving, own, m))[above_moving] - own
        mid_t = draw(rng, mid_c, others, 1, np.maximum(top[word_moving] - own, 0), one, one * unknown(known), np.maximum(total - own, 0))
        root = root_t + np.bincount(word_moving, mid_t, words)
        if sweep >= BURN_IN:
            for s, x in zip(sums, (t_drawn, mid_c, mid_t, root)):
                s += x / SAMPLES
    out = [t.astype(np.float64), np.ones(len(middle)), np.ones(len(middle)), sums[3]]
    for whole, part, of in zip(out, sums, (drawn, moving, moving)):
        whole[of] = part
    return {"t": out[0], "mid": mid, "mid_c": out[1], "mid_t": out[2], "mid_restaurant": above, "root": out[3]}


def _bundle(**columns) -> bytes:
    """Arrays, whole numbers in as few bytes as hold all of them; first bytes side by side, then second ones: those compress better."""
    import zstandard

    head, planes = [], []
    for name, a in columns.items():
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0:
            a = a.astype(np.min_scalar_type(a.max()))
        head.append((name, a.dtype.str, len(a)))
        planes.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join([json.dumps(head).encode(), b"\n", *planes]))


def _opened(body: bytes) -> dict[str, np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(body)
    at = data.index(b"\n") + 1
    out = {}
    for name, kind, n in json.loads(data[:at]):
        kind = np.dtype(kind)
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out[name] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        at += n * kind.itemsize
    return out


def _steps(a: np.ndarray, base: int = 0) -> np.ndarray:
    """Ascending numbers as differences; np.cumsum() undoes it."""
    return np.diff(a, prepend=base)


def _folded(v: np.ndarray, x: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """Ordered trigrams as differences: of the second word before within the word before, of the word within both."""
    v_step, x_step, w_step = _steps(v), _steps(x), _steps(w)
    fresh = v_step != 0
    fresh[:1] = True
    x_step = np.where(fresh, x, x_step)
    fresh |= x_step != 0
    return {"v": v_step, "x": x_step, "w": np.where(fresh, w, w_step)}


def _within(step: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Sums of steps that begin anew wherever it says so."""
    total = np.cumsum(step, dtype=np.int64)
    starts = np.flatnonzero(fresh)
    return total - np.repeat(total[starts] - step[starts], np.diff(starts, append=len(step)))


def _unfolded(several: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """The trigrams of some bundles, and which of them begin a parent and a leaf."""
    begin = np.cumsum([0, *(len(f["v"]) for f in several)])
    v, x, w = (np.concatenate([f[n] for f in several]) for n in "vxw")
    first = np.zeros(len(v), dtype=bool)
    first[begin[:-1]] = True
    fresh = first | (v != 0)
    leaf = fresh | (x != 0)
    return _within(v, first), _within(x, fresh), _within(w, leaf), fresh, leaf


def _spans(part: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the parts that occur in an ordered array."""
    bounds = np.searchsorted(part, np.arange(parts + 1))
    return [(k, int(bounds[k]), int(bounds[k + 1])) for k in np.flatnonzero(np.diff(bounds)).tolist()]


def _table(kinds: str, rows: list[tuple]) -> pa.Table:
    schema = pa.schema([(n, _KINDS[k]) for n, k in (c.split() for c in kinds.split(", "))])
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _by_source(rows: pa.Table) -> list[dict[str, np.ndarray]]:
    return [_opened(rows.column("body")[int(i)].as_py()) for i in np.argsort(rows.column("source").to_numpy(), kind="stable")]


def _read(parts: int):
    def run(key, blobs):
        """A chunk's text in numbers of its words, and its words with their training counts, by the root's parts."""
        chunk = key[0].as_py()
        table = unpack(blobs)
        ids = table.column("doc_id").to_pylist()
        h, first = tokens(*text_bytes(table.column("text")))
        words, word = np.unique(h, return_inverse=True)
        n_tokens = np.diff(first)
        train = ~np.array([held_out(i) for i in ids], dtype=bool)
        counts = np.bincount(word[np.repeat(train, n_tokens)], minlength=len(words))
        part = (mix(np.append(START, words)) % np.uint64(parts)).astype(np.int32)
        known = np.array([i is not None for i in ids], dtype=bool)
        text = _bundle(doc_id=np.array([i or 0 for i in ids], np.int64), known=known, train=train, n_tokens=n_tokens, word=word + 1, part=part)
        return _table(MAIL, [(TEXTS, chunk, chunk, text)] + [
            (WORDS, p, chunk, _bundle(h=words[a:b], c=counts[a:b])) for p, a, b in _spans(root_part(words, parts), parts)])

    return run


def _numbered(key, rows):
    """Number the words of one of the root's parts in the order of their hashes; tell every chunk the numbers and training counts of its own."""
    part = key[0].as_py()
    sources = np.sort(rows.column("source").to_numpy()).tolist()
    told = _by_source(rows)
    words = np.unique(np.concatenate([m["h"] for m in told]))
    at = [np.searchsorted(words, m["h"]) for m in told]
    counts = np.zeros(len(words), dtype=np.int64)
    for a, m in zip(at, told):
        counts[a] += m["c"]
    out = [(i, part, _bundle(word=_steps(a), c=counts[a]), None, None, None) for i, a in zip(sources, at)]
    return _table(SUMS, [*out, (None, part, None, None, len(words), int(counts.sum()))])


def _dealt(offsets: np.ndarray):
    def run(key, texts, numbers):
        """A chunk's trigrams with their training counts, by part."""
        chunk = key[0].as_py()
        text = _opened(texts.column("body")[0].as_py())
        k = _chunk(text)
        sources = np.sort(numbers.column("source").to_numpy()).tolist()
        ids = np.concatenate([[0], *(1 + offsets[i] + np.cumsum(m["word"], dtype=np.int64) for i, m in zip(sources, _by_source(numbers)))])
        counts = np.bincount(k.number[np.repeat(text["train"], text["n_tokens"])], minlength=len(k.part))
        return _table(MAIL, [(TRIGRAMS, p, chunk, _bundle(**_folded(*(ids[n[a:b]] for n in k.words)), c=counts[a:b])) for p, a, b in _spans(k.part, len(offsets) - 1)])

    return run


def _sent(part: int, mine: np.ndarray, tables: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """The tables of a part's words, ordered by number, for the root's parts."""
    bounds = np.searchsorted(mine, offsets + 1)
    return [(TABLES, p, -1 - part, _bundle(word=_steps(mine[a:b] - 1 - offsets[p]), t=tables[a:b]))
            for p, a, b in zip(range(len(bounds) - 1), bounds.tolist(), bounds[1:].tolist()) if a < b]


def _merged(offsets: np.ndarray):
    def run(key, rows):
        """A part's distinct trigrams by restaurant, the places of each chunk's among them, and for the root one table for each dish of a parent."""
        part = key[0].as_py()
        chunks = np.sort(rows.column("source").to_numpy()).tolist()
        asked = _by_source(rows)
        sizes = np.cumsum([0, *(len(a["c"]) for a in asked)])
        given = np.concatenate([a["c"] for a in asked])
        v, x, w, fresh, _ = _unfolded(asked)
        del asked
        runs = np.flatnonzero(fresh)
        parents, v = np.unique(v[runs], return_inverse=True)
        n = int(offsets[-1]) + 1
        v, x, w, number = trigrams(np.repeat(v, np.diff(runs, append=len(x))), x, w, n, len(parents))
        count = np.bincount(number, given).astype(np.int64)
        trained = count > 0
        mine, tables = np.unique(np.unique(v[trained] * n + w[trained]) % n, return_counts=True)
        # restaurants are told apart by where they begin; which words they belong to is not asked again
        folded = _folded(v, x, w)
        parent = folded["v"] != 0
        parent[:1] = True
        leaf = parent | (folded["x"] != 0)
        return _table(MAIL, [
            (TRIGRAMS, part, -1, _bundle(parent=np.packbits(parent), leaf=np.packbits(leaf), w=folded["w"], c=count)),
            *((PLACES, part, i, _bundle(at=_steps(number[a:b]))) for i, a, b in zip(chunks, sizes.tolist(), sizes[1:].tolist())),
            *_sent(part, mine, tables, offsets)])

    return run


def _whole(averages: np.ndarray) -> np.ndarray:
    a = np.rint(averages * SAMPLES).astype(np.int64)
    return a.astype(np.min_scalar_type(a.max(initial=0)))


def _seated(offsets: np.ndarray, known: tuple[float, int], last: bool):
    """known: the root's customers and words of the round before."""

    def run(key, rows, replies):
        """Sample the restaurants of one part, tell the root's parts their tables, and after the last round answer every chunk."""
        part = key[0].as_py()
        if not len(rows):
            return _table(MAIL, [])
        kinds = rows.column("kind").to_numpy()
        merged = _opened(rows.column("body")[int(np.flatnonzero(kinds == TRIGRAMS)[0])].as_py())
        count = merged["c"].astype(np.int64)
        parents, leaves = (np.unpackbits(merged[k], count=len(count)).astype(bool) for k in ("parent", "leaf"))
        w = _within(merged["w"], leaves)
        # numbers of the leaves, and of the parent of each
        v, leaf = np.cumsum(parents) - 1, np.cumsum(leaves) - 1
        up = v[leaves]
        del merged, parents, leaves
        trained = np.flatnonzero(count)
        out = []
        if len(trained):
            mine, dish = np.unique(w[trained], return_inverse=True)
            top = np.concatenate([m["t"] for m in _by_source(replies)]).astype(np.float64)
            s = seat(leaf[trained], dish, count[trained], 1, part, up, (top, *known))
            out += _sent(part, mine, s["root"], offsets)
        if last:
            n, n_leaves, words = int(v[-1]) + 1, len(up), int(offsets[-1]) + 1
            each = {k: np.zeros(len(count)) for k in ("mid_c", "mid_t")}
            of_leaf = {"leaf_c": np.bincount(leaf, count, n_leaves)}
            of_parent = {}
            if len(trained):
                # the parent's dish also of a trigram never seen in training, if its parent has the word
                middle = np.zeros(len(s["mid_c"]), dtype=np.int64)
                middle[s["mid"]] = v[trained] * words + w[trained]
                wanted = v * words + w
                at = np.minimum(np.searchsorted(middle, wanted), len(middle) - 1)
                has = middle[at] == wanted
                each = {k: np.where(has, s[k][at], 0.0) for k in each}
                tables = np.zeros(len(count))
                tables[trained] = s["t"]
                of_leaf["leaf_t"] = np.bincount(leaf[trained], s["t"], n_leaves)
                of_parent = {f"parent_{k[-1]}": np.bincount(s["mid_restaurant"], s[k], n) for k in ("mid_c", "mid_t")}
                del middle, wanted, at, has
            else:
                tables = np.zeros(len(count))
                of_leaf["leaf_t"], of_parent = np.zeros(n_leaves), {"parent_c": np.zeros(n), "parent_t": np.zeros(n)}
            # averages over the samples are multiples of one sample's share
            each, of_leaf, of_parent = ({k: _whole(a) for k, a in kind.items()} for kind in (each, of_leaf, of_parent))
            each["c"], tables = count.astype(np.min_scalar_type(count.max())), _whole(tables)
            for i in np.flatnonzero(kinds == PLACES):
                at = np.cumsum(_opened(rows.column("body")[int(i)].as_py())["at"], dtype=np.int64)
                mine, above = leaf[at], v[at]
                mine, above = (a[np.diff(a, prepend=-1) != 0] for a in (mine, above))
                body = _bundle(t=tables[at[count[at] > 1]], **{k: a[at] for k, a in each.items()}, **{k: a[mine] for k, a in of_leaf.items()}, **{k: a[above] for k, a in of_parent.items()})
                out.append((ANSWERS, rows.column("source")[int(i)].as_py(), part, body))
        return _table(MAIL, out)

    return run


def _summed(offsets: np.ndarray):
    def run(key, rows):
        """Sum the customers of one of the root's parts; tell every source, parts and chunks, those of its words."""
        part = key[0].as_py()
        sources = np.sort(rows.column("source").to_numpy()).tolist()
        told = _by_source(rows)
        at = [np.cumsum(m["word"], dtype=np.int64) for m in told]
        t = np.zeros(int(offsets[part + 1] - offsets[part]))
        for a, m in zip(at, told):
            if "t" in m:
                t[a] += m["t"]
        out = [(i, part, _bundle(t=t[a], **{n: m[n] for n in m.keys() & {"c"}}), None, None, None) for i, a, m in zip(sources, at, told)]
        return _table(SUMS, [*out, (None, part, None, float(t.sum()), int((t > 0).sum()), None)])

    return run


@dataclass
class Totals:
    """Customers and tables of restaurants, the tokens and words of training."""

    leaf: tuple[np.ndarray, np.ndarray]
    parent: tuple[np.ndarray, np.ndarray]
    root: float
    words: int
    tokens: int

    def shares(self, context, own, parent, up=None):
        """What leaf and parent give a word themselves, and the factor of the root's chance. up: the parent restaurant of each word."""
        share, rest = np.zeros(len(own)), np.ones(len(own))
        for mine, (customers, tables), level, r in ((parent, self.parent, 1, context // 2 if up is None else up), (own, self.leaf, 0, context)):
            weight = STRENGTH[level] + DISCOUNT[level] * tables[r]
            share, rest = (mine + weight * share) / (STRENGTH[level] + customers[r]), weight * rest / (STRENGTH[level] + customers[r])
        return share, rest

    def probability(self, context, own, parent, root):
        """Averaged predictive probability of a word in a leaf context: one share of each level. Over all words and one
        unknown word they add up to 1."""
        share, rest = self.shares(context, own, parent)
        return share + rest * (root + unknown(self.words)) / (STRENGTH[2] + self.root)


def _scored(customers: float, words: int, total: int):
    def run(key, texts, answers):
        text = _opened(texts.column("body")[0].as_py())
        k, n_tokens = _chunk(text), text["n_tokens"].astype(np.int64)
        source, kind = answers.column("source").to_numpy(), answers.column("kind").to_numpy()
        got = {g: [_opened(answers.column("body")[int(i)].as_py()) for i in np.lexsort((source,)) if kind[i] == g] for g in (ANSWERS, TABLES)}
        a = {n: np.concatenate([g[n] for g in got[ANSWERS]]).astype(np.float64) / (1 if n == "c" else SAMPLES) for n in got[ANSWERS][0]}
        # one answer for each parent and each leaf; a trigram that training has once has one table
        v, x, _ = k.words
        parent = _steps(v, -1) != 0
        leaf, parent = np.cumsum(parent | (_steps(x, -1) != 0)) - 1, np.cumsum(parent) - 1
        tables = np.minimum(a["c"], 1.0)
        tables[a["c"] > 1] = a["t"]
        totals = Totals((a["leaf_c"], a["leaf_t"]), (a["parent_c"], a["parent_t"]), 0.0, 0, 0)
        share, rest = totals.shares(leaf, a["c"] - DISCOUNT[0] * tables, a["mid_c"] - DISCOUNT[1] * a["mid_t"], parent)
        del a, got[ANSWERS]
        t, c = (np.concatenate([g[n] for g in got[TABLES]])[text["word"] - 1] for n in "tc")
        share, rest = (a.astype(np.float32)[k.number].astype(np.float64) for a in (share, rest))
        score = np.log10(share + rest * root_chance(t, customers, words))
        base = np.log10((c + 1.0) / (total + words + 1))
        first = np.cumsum(n_tokens) - n_tokens
        return pa.Table.from_arrays([
            pa.array(text["doc_id"].astype(np.int64), pa.int64(), mask=~text["known"]), pa.array(~text["train"]), pa.array(n_tokens, pa.int64()),
            pa.array(np.add.reduceat((c > 0).astype(np.int64), first), pa.int64()), pa.array(np.full(len(first), total), pa.int64()),
            pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(score, first))], schema=OUT)

    return run


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words end at ASCII white space, A-Z are lower-cased, and an end token closes every text; null is empty, so null and
    empty texts are one token. Training takes all texts whose crc32(doc_id as text) mod 7 is not 2 (a null id counts as
    empty text), repeated rows as often as they occur. n_known: tokens that training has. base_score: log10 probability
    with one added to every count; score: that of the model. An empty table gives no rows; other columns are left behind.
    Without training rows all words are unknown, and alike.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark, chunks = docs.sparkSession, chunk_count(docs, chunk_bytes)
    apart = lambda path, kind: spark.read.schema(MAIL).parquet(path).where(F.col("kind") == kind)
    with shuffles_removed(spark):
        read = written_apart(pack(docs, chunks).groupBy("chunk").applyInArrow(_read(chunks), MAIL), "texts", "kind")
        numbers = written(apart(read, WORDS).groupBy("target").applyInArrow(_numbered, SUMS), "words")
        named = last_written()
        remove(spark, f"{read}/kind={WORDS}")
        sizes = {r.source: r for r in numbers.where("target is null").select("source", "words", "tokens").collect()}
        offsets = np.cumsum([0, *(sizes[p].words if p in sizes else 0 for p in range(chunks))])
        total = sum(r.tokens for r in sizes.values())
        texts, numbers = apart(read, TEXTS), numbers.where("target is not null").select("target", "source", "body")
        dealt = texts.groupBy("target").cogroup(numbers.groupBy("target")).applyInArrow(_dealt(offsets), MAIL)
        merged = written_apart(dealt.groupBy("target").applyInArrow(_merged(offsets), MAIL), "trigrams", "kind")
        path = merged
        for left in range(ROUNDS, -1, -1):
            tables = apart(path, TABLES).select("target", "source", "body")
            if left == 0:
                tables = tables.unionByName(numbers.select(F.col("source").alias("target"), F.col("target").alias("source"), "body"))
            sums = written(tables.groupBy("target").applyInArrow(_summed(offsets), SUMS), "root")
            remove(spark, f"{path}/kind={TABLES}")
            found = sums.where("target is null").agg(F.sum("customers"), F.sum("words")).first()
            known = (found[0] or 0.0, found[1] or 0)
            if left == 0:
                break
            replies = sums.where("target < 0").select((-1 - F.col("target")).alias("target"), "source", "body")
            replied = last_written()
            rows = spark.read.schema(MAIL).parquet(merged).where(F.col("kind") == TRIGRAMS if left > 1 else F.col("kind") < TABLES)
            path = written_apart(rows.groupBy("target").cogroup(replies.groupBy("target")).applyInArrow(_seated(offsets, known, left == 1), MAIL), "tables", "kind")
            remove(spark, replied)
        remove(spark, merged)
        remove(spark, named)
    answers = apart(path, ANSWERS).unionByName(sums.where("target >= 0").select(F.lit(TABLES).alias("kind"), "target", "source", "body"))
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("target").cogroup(answers.groupBy("target")).applyInArrow(_scored(*known, total), kinds)
