"""Shared helpers of the training-data operators.

Tasks work on Arrow batches: texts come in as UTF-8 bytes, words become 64-bit
hashes once per distinct word, and everything after that is array arithmetic
over all documents of a slice at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from quire.session import scratch_path

#: Text bytes that a task turns into arrays at a time.
SLICE_BYTES = 3 << 20
#: An odd multiplier of the polynomial window hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and both a lost executor and a second reader find the same files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns, *names: str) -> list[str]:
    """For each name one like it that is none of ``columns``, so that a step's own
    columns never clash with the caller's (names differ by more than case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def process_cache(name: str, make):
    """One object per Python worker process: code shipped by value is unpickled
    anew for every task, what is kept on ``sys`` outlives the task. A worker serves
    one step after the other, so the object of an earlier name goes first."""
    store = sys.__dict__.setdefault("_quire_process_cache", {})
    if name not in store:
        if store:
            store.clear()
            release_memory()
        store[name] = make()
    return store[name]


def release_memory() -> None:
    """Give what the worker process has freed back to the system: a worker lives
    on after its task, beside those of the next stage."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def drop_caches() -> None:
    """Forget what :func:`process_cache` keeps: a step that needs none of it runs
    in workers that earlier steps have filled."""
    if sys.__dict__.pop("_quire_process_cache", None):
        release_memory()


def text_bytes(column) -> list:
    """A text column as a list of UTF-8 bytes (NULL: None)."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut a batch into row ranges of about ``max_bytes`` of text (one row at
    least), each with its texts."""
    texts = text_bytes(batch.column(text))
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= max_bytes or i == len(texts) - 1:
            yield batch.slice(start, i + 1 - start), texts[start:i + 1]
            start, size = i + 1, 0


def split_words(texts: list) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The texts (UTF-8 bytes or None) cut at ASCII white space: the code of each
    word, all texts one after the other; the words per text; and the distinct
    words, in the order of their codes."""
    column = pa.array([t or b"" for t in texts], pa.binary()).cast(pa.large_string())
    parts = pc.ascii_split_whitespace(column)
    coded = parts.values.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    bounds = parts.offsets.to_numpy().astype(np.int64)
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in words:  # an empty text, or white space at an edge
        full = codes != words.index(b"")
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        codes = codes[full]
    return codes, np.diff(bounds), words


def hashed_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, one text after the other, and the words per
    text."""
    codes, lens, words = split_words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), lens


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values, so that order and low bits look random."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int, base: int = BASE) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


class Windows:
    """Hashes of all windows of any length over one array of word hashes, by
    differences of one weighted running sum (modulo 2**64)."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.n = n
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(n), out=self.sums[1:])
        self.inverse = powers(n, BASE_INV)

    def of(self, length: int) -> np.ndarray:
        """Entry i: the hash of words i .. i+length-1 (those crossing documents
        included; the caller masks them)."""
        if self.n < length:
            return np.zeros(0, dtype=np.uint64)
        m = self.n - length + 1
        return mixed((self.sums[length:] - self.sums[:m]) * self.inverse[:m])


def inside(lens: np.ndarray, length: int) -> np.ndarray:
    """Which starts of a window over the joined documents stay in one document."""
    ends = np.repeat(np.cumsum(lens), lens)
    starts = np.arange(len(ends))
    return (starts + length <= ends)[:max(0, len(ends) - length + 1)]


def binary_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row i holds values[bounds[i]:bounds[i+1]]."""
    data = np.ascontiguousarray(values)
    offsets = (bounds * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data)])
