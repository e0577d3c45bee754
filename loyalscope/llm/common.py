"""Shared helpers: Arrow text as numpy bytes, word hashes, chunked corpora, written tables, components."""

from __future__ import annotations

import ctypes
import pathlib
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalscope.session import written

__all__ = ["written"]

#: Texts are worked on in groups of about this many bytes, so that numpy's temporary arrays stay small.
GROUP_BYTES = 1 << 19
SLICE = 2000  # rows that appended() works on at once
CHUNK_BYTES = 8 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Bytes of words that end at white space, and of words of letters, digits and non-ASCII characters.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False
WORD_CHARS = np.zeros(256, dtype=bool)
WORD_CHARS[48:58] = WORD_CHARS[97:123] = WORD_CHARS[128:] = True

_ODD = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, so that they can import it wherever the driver found it."""
    context = spark.sparkContext
    if context not in _shipped:
        folder = tempfile.mkdtemp(prefix="loyalscope-")
        root = pathlib.Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{folder}/loyalscope-package", "zip", root, "loyalscope"))
        _shipped.add(context)


_shipped: set = set()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run in here hand rows to Python in smaller batches: for rows that hold whole sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """From now on jobs hand at most so many rows and about so many bytes to Python at once, unless the session says less: rows
    of whole texts are long, and what the JVM and the workers set aside for a batch stays with them."""
    confs = spark.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(confs.get(name))
        if now <= 0 or now > spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most):
            confs.set(name, most)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def release() -> None:
    """Give back to the system what the worker has set aside and does not use: it may go on to other work, and not alone."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more entry than texts). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def groups(starts: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `limit` bytes; a longer text is a range of its own."""
    first = 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        yield first, last
        first = last


class Words:
    """The words of some texts: spans, 64-bit hashes and the number of the text of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, table: np.ndarray):
        low = FOLD[data]
        inside = table[low]
        before = np.zeros(len(low), dtype=bool)
        before[1:] = inside[:-1]
        begins = starts[:-1][np.diff(starts) > 0]
        before[begins] = False
        self.begin = np.flatnonzero(inside & ~before)
        after = np.zeros(len(low), dtype=bool)
        after[:-1] = inside[1:]
        after[begins[begins > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        powers = np.full(len(low), _BASE, np.uint64)
        back = np.full(len(low), _INVERSE, np.uint64)
        if len(low):
            powers[0] = back[0] = 1
            np.cumprod(powers, out=powers)
            np.cumprod(back, out=back)
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_BYTE[low] * powers, out=sums[1:])
        hashes = (sums[self.end] - sums[self.begin]) * back[self.begin]
        self.hash = mix(hashes ^ ((self.end - self.begin).astype(np.uint64) * np.uint64(_ODD)))
        self.low = low
        #: words of text i are self.first[i] up to self.first[i + 1]
        self.first = np.searchsorted(self.begin, starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def word_hash(word: str, table: np.ndarray) -> int:
    """The hash that Words gives one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Words(data, np.array([0, len(data)]), table).hash[0])


# Chunked corpora: texts packed into chunks of bounded size, so that what one chunk needs of a corpus-wide table can be
# sent to it as a whole.


def chunk_count(docs: DataFrame, size: int = CHUNK_BYTES) -> int:
    """How many chunks of about `size` bytes of text the documents fill: grows with the input."""
    total = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    return max(1, -(-total // size))


def pack(docs: DataFrame, chunks: int) -> DataFrame:
    """Rows (chunk, blob): the doc_id and text of all documents, compressed, several documents a blob.

    Documents go to chunks by a hash of doc_id. Other columns are left behind.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                       F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(chunks)).cast("int").alias("chunk"))
    return rows.mapInArrow(_packed, "chunk int, blob binary")


def _packed(batches):
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
        order = np.argsort(chunk, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(chunk[order])) + 1), len(order)]
        names, blobs = [], []
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = pa.table({n: batch.column(n).take(pa.array(order[a:b])) for n in ("doc_id", "text")})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_table(part)
            names.append(int(chunk[order[a]]))
            blobs.append(press.compress(sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "blob"])


def unpack(blobs: pa.Table | pa.RecordBatch) -> pa.Table:
    """The documents of one chunk, ordered by doc_id (null last) and text, whatever order the blobs came in."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    parts = []
    for blob in blobs.column("blob").to_pylist():
        with pa.ipc.open_stream(press.decompress(blob)) as stream:
            parts.append(stream.read_all())
    return pa.concat_tables(parts).sort_by([("doc_id", "ascending"), ("text", "ascending")])


# Connected components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (node, component) for every node of the links (a, b): the smallest node reachable.

    Alternates linking all larger neighbours, then all smaller ones, to a node's smallest neighbour. Both are a grouped
    minimum and a join on the node, so a node with very many links is split like any skewed join key. Every round is
    written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = written(small, name)
        stars = after.agg(F.count("*").alias("n"), F.count_distinct("u").alias("nodes"),
                          F.max(F.col("v")).alias("top")).first()
        heads = after.select("v").distinct().join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        links = after
        if stars["n"] == stars["nodes"] and heads == 0:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def appended(rows: DataFrame, compute, new: str) -> DataFrame:
    """All columns of rows and those that compute(batch) gives as a list of arrays, as declared in `new`.

    Columns of rows with the name of a new one are replaced; compute() finds them as `_given_<name>`.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    made = _parse_datatype_string(new)
    rows = rows.select([c for c in rows.columns if c.lower() not in {f.name.lower() for f in made}] + [
        F.col(f"`{c}`").alias(f"_given_{c}") for c in rows.columns if c.lower() in {f.name.lower() for f in made}])
    kept = [f for f in rows.schema if not f.name.startswith("_given_")]
    types = to_arrow_schema(made).types

    def run(batches):
        for batch in (whole.slice(first, SLICE) for whole in batches for first in range(0, max(1, whole.num_rows), SLICE)):
            arrays = [pa.array(a, t) if not isinstance(a, pa.Array) else a for a, t in zip(compute(batch), types)]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + arrays, names=[f.name for f in kept] + made.names)
        release()

    return rows.mapInArrow(run, StructType(kept + list(made.fields)))
