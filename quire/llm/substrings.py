"""Substring deduplication by compacting repeated token k-mers.

The edges of a de Bruijn graph over words are the windows of K consecutive
words. As in disk-based graph compaction, windows are dealt by their minimizer
(the smallest hash among their shorter word runs), so a stretch of consecutive
windows with one minimizer travels as one row, and equal windows meet. In each
minimizer's rows the repeated windows are found and compacted at once into
paths: runs of windows that follow each other both in the document and at their
first occurrence (the source coordinates). Paths that continue one another
across minimizers are glued when they are joined to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quire.operators.ordering import global_index

from .common import (SLICE_BYTES, Windows, hashed_words, inside, mixed, slices, table,
                     written)

K, MINIMIZER = 20, 6
#: Text a task turns into windows at a time; repeats inside are settled there.
CHUNK_BYTES = 6 << 20
#: Bytes of a window's hash: all 64 bits, which alone tell windows of one
#: minimizer apart.
WINDOW_BYTES = 8
#: Minimizers with this many different windows in one of HOT_SHARE documents are
#: dealt by window instead.
HOT_WINDOWS, HOT_SHARE = 1000, 64
#: Rows of a chunk, one after the other, whose settled paths travel together.
SETTLED_BLOCK = 512
#: Level of zstd for texts that are shuffled to their paths: about two thirds of
#: the bytes that Spark's own compression of shuffles leaves.
TEXT_LEVEL = 1

#: settled = 0: windows first seen in their chunk, as hashes; settled = n: a path
#: of n repeated windows whose source is known already.
SUPERKMERS = ("minimizer long, doc long, start int, settled int, source_doc long, "
              "source_start int, windows binary")
PATHS = "doc long, start int, n int, source_doc long, source_start int"
NO_ID = -(1 << 63)


def split_runs(*breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs that end wherever one of ``breaks`` (True
    between element i and i+1) holds."""
    n = len(breaks[0]) + 1
    edge = np.flatnonzero(np.logical_or.reduce(breaks)) + 1
    first = np.concatenate([[0], edge])
    return first, np.diff(np.append(first, n))


def minimizer_positions(lens: np.ndarray, short: np.ndarray, k: int, m: int
                        ) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all k-word windows inside documents, and for each the place of
    its smallest m-word hash (the first of equals)."""
    n = len(short) - (k - m)
    best, at = short[:n].copy(), np.zeros(n, dtype=np.int32)
    for j in range(1, k - m + 1):
        less = short[j:n + j] < best
        best = np.where(less, short[j:n + j], best)
        at[less] = j
    starts = np.flatnonzero(inside(lens, k))
    return starts, starts + at[starts]


def pack_hashes(h: np.ndarray) -> np.ndarray:
    """The low WINDOW_BYTES bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :WINDOW_BYTES]


def unpack_hashes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // WINDOW_BYTES, 8), dtype=np.uint8)
    out[:, :WINDOW_BYTES] = raw.reshape(-1, WINDOW_BYTES)
    return out.view("<u8").ravel()


def first_of_equal(keys: np.ndarray) -> np.ndarray:
    """For each element the index of the first equal element."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = head
    return out


def chunk_rows(ids: list[int], texts: list, k: int, m: int, hot: np.ndarray
               ) -> pa.RecordBatch | None:
    """SUPERKMERS rows of a chunk of documents (sorted by id here). Windows of a
    ``hot`` minimizer are rows of their own, dealt by their own hash."""
    order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
    ids = np.array(ids, dtype=np.int64)[order]
    hashes, lens = hashed_words([texts[i] for i in order.tolist()])
    if len(hashes) < k:
        return None
    windows = Windows(hashes)
    starts, places = minimizer_positions(lens, windows.of(m), k, m)
    if not len(starts):
        return None
    doc = np.repeat(np.arange(len(ids)), lens)[starts]
    begin = (np.cumsum(lens) - lens)[doc]
    whole, short = windows.of(k), windows.of(m)
    # Windows that share the place of their minimizer form a run.
    alone = np.isin(short[places], hot)
    run, size = split_runs((np.diff(places) != 0) | (np.diff(starts) != 1) | alone[1:] | alone[:-1])
    minimizer = short[places[run]]
    # Windows of minimizers seen more than once may repeat inside the chunk.
    head = first_of_equal(minimizer)
    shared = np.bincount(head, minlength=len(run))[head] > 1
    source = np.arange(len(starts))
    maybe = np.flatnonzero(np.repeat(shared, size))
    if len(maybe):
        source[maybe] = maybe[first_of_equal(whole[starts[maybe]])]
        # Repeated rows of one id: the same start is not an earlier one.
        same = (ids[doc] == ids[doc[source]]) & (starts - begin == (starts - begin)[source])
        source[same] = np.flatnonzero(same)
    repeated = source != np.arange(len(starts))
    key = np.where(alone, whole[starts], np.repeat(minimizer, size))
    position = (starts - begin).astype(np.int32)
    step = np.diff(np.repeat(np.arange(len(run)), size)) != 0
    turn = np.diff(repeated.astype(np.int8)) != 0
    jump = repeated[1:] & (np.diff(source) != 1)
    first, count = split_runs(step | turn | jump)
    settled = repeated[first]
    data = pack_hashes(whole[starts])
    cuts = np.concatenate([[0], np.cumsum(np.where(settled, 0, count))])
    kept = data[~repeated]
    offsets = (cuts * WINDOW_BYTES).astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(first),
                                   [None, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])
    # Any key will do for settled paths; in blocks they repeat most of their bytes.
    scattered = mixed(np.arange(len(first), dtype=np.uint64) // np.uint64(SETTLED_BLOCK)
                      + np.uint64(ids[0] & 0xFFFFFFFF))
    from_ = source[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.where(settled, scattered, key[first]).view(np.int64)),
         pa.array(ids[doc[first]]), pa.array(position[first]),
         pa.array(np.where(settled, count, 0).astype(np.int32)),
         pa.array(np.where(settled, ids[doc[from_]], 0)),
         pa.array(np.where(settled, position[from_], 0).astype(np.int32)), binary],
        names=[f.split()[0] for f in SUPERKMERS.split(", ")])


def super_kmers(batches: Iterator[pa.RecordBatch], k: int, m: int, hot: np.ndarray
                ) -> Iterator[pa.RecordBatch]:
    ids, texts, size = [], [], 0

    def chunk():
        out = chunk_rows(ids, texts, k, m, hot) if ids else None
        return [] if out is None else [out]

    for batch in batches:
        for rows, part in slices(batch):
            ids += rows.column("doc").to_pylist()
            texts += part
            size += sum(len(t) for t in part if t)
            if size >= CHUNK_BYTES:
                yield from chunk()
                ids, texts, size = [], [], 0
    yield from chunk()


class FirstSeen:
    """Repeated windows of rows that come ordered by minimizer, doc and start.
    What is remembered between batches is one minimizer's distinct windows."""

    def __init__(self):
        self.key, self.seen, self.doc, self.start = None, None, None, None

    def paths(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        col = {n: batch.column(n) for n in batch.schema.names}
        key, doc, start, settled, sdoc, sstart = (
            col[c].to_numpy(zero_copy_only=False) for c in
            ("minimizer", "doc", "start", "settled", "source_doc", "source_start"))
        ready = np.flatnonzero(settled > 0)
        out = [(doc[ready], start[ready], settled[ready], sdoc[ready], sstart[ready])]
        near = np.concatenate([[False], key[1:] == key[:-1], [False]])
        go_on = near[1:] | near[:-1] | (key == self.key if self.key is not None else False)
        open_ = np.flatnonzero(go_on & (settled == 0))
        last = key[-1]
        if len(open_):
            raws = col["windows"].take(pa.array(open_)).to_pylist()
            size = np.array([len(r) // WINDOW_BYTES for r in raws])
            h = unpack_hashes(np.frombuffer(b"".join(raws), dtype=np.uint8))
            row = np.repeat(open_, size)
            at = start[row] + (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size))
            both = mixed(h ^ (key[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            wdoc, wstart = doc[row], at
            head = first_of_equal(both)
            fdoc, fstart = wdoc[head], wstart[head]
            if self.key is not None and len(self.seen):
                old = np.minimum(np.searchsorted(self.seen, both), len(self.seen) - 1)
                known = (key[row] == self.key) & (self.seen[old] == both)
                fdoc = np.where(known, self.doc[old], fdoc)
                fstart = np.where(known, self.start[old], fstart)
            repeated = (fdoc != wdoc) | (fstart != wstart)
            pick = np.flatnonzero(repeated)
            if len(pick):
                d, p, fd, fp, r = wdoc[pick], wstart[pick], fdoc[pick], fstart[pick], row[pick]
                first, count = split_runs((np.diff(r) != 0) | (np.diff(p) != 1)
                                          | (np.diff(fd) != 0) | (np.diff(fp) != 1))
                out.append((d[first], p[first], count, fd[first], fp[first]))
            mine = np.flatnonzero((key[row] == last) & ~repeated)
            new = (both[mine], wdoc[mine], wstart[mine])
        else:
            new = None
        if self.key is not None and last == self.key and self.seen is not None:
            new = new if new is not None else (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
            new = tuple(np.concatenate([a, b]) for a, b in
                        zip((self.seen, self.doc, self.start), new, strict=True))
        elif new is None or not np.any(key[open_] == last):
            new = self._single(col, key, doc, start, settled)
        u, i = np.unique(new[0], return_index=True)
        self.key, self.seen, self.doc, self.start = last, u, new[1][i], new[2][i]
        joined = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t)) for c, t in
             zip(joined, (np.int64, np.int32, np.int32, np.int64, np.int32), strict=True)],
            names=[f.split()[0] for f in PATHS.split(", ")])

    @staticmethod
    def _single(col, key, doc, start, settled):
        """Windows of the batch's last row, whose minimizer may go on."""
        if settled[-1]:
            return (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        h = unpack_hashes(np.frombuffer(col["windows"][len(key) - 1].as_py(), dtype=np.uint8))
        both = mixed(h ^ (key[-1:].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return both, np.full(len(h), doc[-1]), start[-1] + np.arange(len(h))


def hot_minimizers(docs: DataFrame, k: int, m: int) -> np.ndarray:
    """The minimizers that have many different windows, by a share of the
    documents. Any set gives the same paths; it settles who compares them."""
    share = docs.where(F.pmod(F.xxhash64("doc", "text"), F.lit(HOT_SHARE)) == 0)
    none = np.zeros(0, np.uint64)
    rows = share.mapInArrow(lambda b: super_kmers(b, k, m, none), SUPERKMERS).where("settled = 0")
    found = (rows.groupBy("minimizer").agg(F.sum(F.length("windows") / WINDOW_BYTES).alias("n"))
             .where(F.col("n") >= HOT_WINDOWS).select("minimizer").collect())
    return np.sort(np.array([r[0] for r in found], dtype=np.int64).view(np.uint64))


def repeated_paths(docs: DataFrame, k: int = K, m: int = MINIMIZER) -> DataFrame:
    """Paths (PATHS) of windows of ``k`` words that also start earlier: in a
    smaller doc_id or earlier in the same one. ``docs`` has doc and text."""
    hot = hot_minimizers(docs, k, m)
    rows = docs.mapInArrow(lambda b: super_kmers(b, k, m, hot), SUPERKMERS)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "minimizer").sortWithinPartitions("minimizer", "doc", "start")

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = FirstSeen()
        for batch in batches:
            if batch.num_rows:
                yield state.paths(batch)

    return dealt.mapInArrow(resolve, PATHS)


def covered_words(n: int, starts: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Which of n words a window of the given paths covers."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.add.at(edge, np.minimum(starts + counts + k - 1, n), -1)
    return np.cumsum(edge)[:n] > 0


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_doc``: its doc_id, or where several rows have one id (or
    none) the place of (doc_id, hash of the text) in their order, so that rows
    that share an id keep their own paths."""
    ids = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")))
    if ids.groupBy("_doc").count().where("count > 1").isEmpty():
        return ids
    hashed = ids.withColumnRenamed("_doc", "_id").withColumn("_hash", F.xxhash64("text"))
    order = written(global_index(hashed.select("_id", "_hash").distinct(),
                                 [F.col("_id"), F.col("_hash")], "_doc"), "repeated-span-order")
    return hashed.join(order, ["_id", "_hash"]).select(*docs.columns, "_doc")


def packed_text(text: bytes | None) -> bytes | None:
    """A text by zstd, behind its size in 8 bytes."""
    return None if text is None else len(text).to_bytes(8, "little") + pa.Codec(
        "zstd", TEXT_LEVEL).compress(text, asbytes=True)


def unpacked_text(raw: bytes | None) -> bytes | None:
    return None if raw is None else pa.decompress(
        raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def unpacked_slices(batch: pa.RecordBatch, max_bytes: int = SLICE_BYTES
                    ) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut a batch of packed texts into row ranges of about ``max_bytes`` of text
    (one row at least), each with its texts."""
    raws = batch.column("text").to_pylist()
    start, size, texts = 0, 0, []
    for i, raw in enumerate(raws):
        texts.append(unpacked_text(raw))
        size += len(texts[-1] or b"")
        if size >= max_bytes or i == len(raws) - 1:
            yield batch.slice(start, i + 1 - start), texts
            start, size, texts = i + 1, 0, []


def with_paths(docs: DataFrame, k: int, m: int) -> DataFrame:
    """``docs`` with its paths as an array column ``_paths`` (NULL without any);
    its texts are packed (:func:`unpacked_slices` reads them)."""
    own = numbered(docs)
    paths = repeated_paths(own.select(F.col("_doc").alias("doc"), "text"), k, m)
    grouped = (paths.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("_paths"))
               .withColumnRenamed("doc", "_doc"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for rows, texts in slices(batch):
                yield rows.set_column(at, "text", pa.array(list(map(packed_text, texts)), pa.binary()))

    schema = StructType([StructField("text", BinaryType()) if f.name == "text" else f
                         for f in own.schema.fields])
    return (own.mapInArrow(pack, schema).join(grouped, "_doc", "left")
            .select(*docs.columns, "_paths"))


def dedup_substrings(docs: DataFrame, k: int = K, m: int = MINIMIZER) -> DataFrame:
    """``docs`` with the text of every row freed of its repeated spans: words
    covered by a window of ``k`` words that starts earlier in the corpus go, the
    others are joined by one space; texts without such words stay as they are
    (NULL too). ``n_chars``, where there is one, follows the text.

    The earliest occurrence stays: smallest doc_id (NULL before all), then
    smallest start. Different texts that share a doc_id (or have none) are
    ordered by a hash of the text and each loses its own words only; rows that
    repeat both count as the same document, so an equal start in them is not an
    earlier one. Texts of fewer than ``k`` words have no windows; an empty table
    gives an empty table.
    """
    columns = docs.columns
    kept = docs.select(*columns)
    lengths = "n_chars" in columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for rows, texts in unpacked_slices(batch):
                changed = {}
                for i, (p, t) in enumerate(zip(rows.column("_paths").to_pylist(), texts, strict=True)):
                    if p and t:
                        changed[i] = b" ".join(keep_words(t, p, k)[0])
                out = rows.drop_columns(["_paths"])
                texts = [changed.get(i, t) for i, t in enumerate(texts)]
                out = out.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string()))
                if changed and lengths:
                    c = out.schema.get_field_index("n_chars")
                    old = out.column(c).to_pylist()
                    new = [len(changed[i].decode()) if i in changed else v for i, v in enumerate(old)]
                    out = out.set_column(c, out.schema.field(c), pa.array(new, out.schema.field(c).type))
                yield out

    return with_paths(kept, k, m).mapInArrow(cut, kept.schema)


def keep_words(text: bytes, paths: list[dict], k: int) -> tuple[list[bytes], int]:
    words = text.split()
    gone = covered_words(len(words), np.array([p["start"] for p in paths]),
                         np.array([p["n"] for p in paths]), k)
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], len(words)


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words removed from all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = StructType([docs.schema["doc_id"]])
    for c in ("n_words long", "n_removed long", "kept_sha256 string"):
        schema = schema.add(*c.split())

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in unpacked_slices(batch):
                n_words, removed, digests = [], [], []
                for t, p in zip(texts, rows.column("_paths").to_pylist(), strict=True):
                    t = t or b""
                    kept, n = keep_words(t, p, K) if p else (t.split(), None)
                    n = len(kept) if n is None else n
                    n_words.append(n)
                    removed.append(n - len(kept))
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n_words, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    names=schema.names)

    return with_paths(docs, K, MINIMIZER).mapInArrow(report, schema)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 19), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE k > 1),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
          WHERE len(w) > 0),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
