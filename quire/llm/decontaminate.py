"""Benchmark decontamination.

The normalised n-grams of the benchmark are a broadcast hash set; every task
slides over the words of its documents, looks windows up, verifies each hit
word by word, and marks the words a hit covers. A benchmark larger than one
broadcast is bounded to is scanned in blocks of items.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Windows, inside, slices, split_words, table, text_bytes, written

WINDOW = 13
#: Benchmark words per broadcast block (about 100 bytes each in a task).
BLOCK_WORDS = 1_000_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A-Z to a-z; every other byte that is no word byte to a space.
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower()
              else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def fold_words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WindowSet:
    """Windows of a block of items, by the ids of their words. Ids are exact
    (one per distinct benchmark word), so equal ids mean equal words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                   for w in fold_words(text)]
            length = min(window, len(ids))
            known = self.by_length.setdefault(length, {}) if length else {}
            for i in range(len(ids) - length + 1):
                known.setdefault(tuple(ids[i:i + length]), set()).add(item)
        self.hashes = {}
        for length, known in self.by_length.items():
            flat = np.array(list(known), dtype=np.uint64).reshape(len(known), length)
            h = Windows(spread(flat.ravel())).of(length)[::length]
            self.hashes[length] = np.sort(h)

    def scan(self, texts: list) -> tuple[np.ndarray, np.ndarray, list[set]]:
        """Words per text, which words are hit, and the items found per text."""
        codes, lens, words = split_words([t.translate(_FOLD) if t else t for t in texts])
        found = [set() for _ in texts]
        known_id = np.array([self.vocabulary.get(w, 0) for w in words] or [0], dtype=np.uint64)
        ids = known_id[codes]
        cover = np.zeros(len(ids) + 1, dtype=np.int64)
        doc_of = np.repeat(np.arange(len(texts)), lens)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        windows = Windows(spread(ids))
        for length, known in self.by_length.items():
            if not length or length > len(ids):
                continue
            start = np.flatnonzero(inside(lens, length) & (unknown[length:] == unknown[:-length]))
            if not len(start):
                continue
            h, table_ = windows.of(length)[start], self.hashes[length]
            near = np.minimum(np.searchsorted(table_, h), len(table_) - 1)
            for i in start[table_[near] == h].tolist():
                items = known.get(tuple(ids[i:i + length].tolist()))
                if items:
                    found[doc_of[i]] |= items
                    cover[i] += 1
                    cover[i + length] -= 1
        return lens, np.cumsum(cover)[:-1] > 0, found


def spread(ids: np.ndarray) -> np.ndarray:
    """Small ids as well-spread 64-bit values."""
    return (ids + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ (ids << np.uint64(40))


def cut_spans(text: bytes, hit: np.ndarray) -> bytes:
    """The text without the stretches from the first to the last word of each
    run of hit words."""
    spans = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, text[at:]])


def benchmark_blocks(benchmark: DataFrame, window: int, block_words: int
                     ) -> tuple[int, Iterator[WindowSet]]:
    """The number of blocks, from the benchmark's total size, and the blocks as
    window sets of bounded size, each collected when it is asked for."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text")).where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))

    def block(b: int) -> WindowSet:
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        return WindowSet([(r["item"], r["text"].encode()) for r in rows], window)

    return blocks, map(block, range(blocks))


SCHEMA = ("n_words long, n_hit long, n_items long, items array<string>, contaminated boolean")


def scan_documents(docs: DataFrame, windows, text: str = "text", cut: bool = False) -> DataFrame:
    """Add the columns of SCHEMA (``cut``: and the text without hit spans as
    ``cut_text``) to every row of ``docs``; ``windows`` is a broadcast set."""
    from pyspark.sql.types import StringType, StructType

    added = StructType.fromDDL(SCHEMA)
    if cut:
        added = added.add("cut_text", StringType())
    clash = {f.name.lower() for f in added.fields}
    kept = [c for c in docs.columns if c.lower() not in clash]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                lens, hit, found = windows.value.scan(texts)
                ends = np.cumsum(lens)
                sums = np.concatenate([[0], np.cumsum(hit)])
                n_hit = sums[ends] - sums[ends - lens]
                columns = [pa.array(lens), pa.array(n_hit),
                           pa.array([len(f) for f in found], pa.int64()),
                           pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                           pa.array((n_hit > 0) & (20 * n_hit >= lens))]
                if cut:
                    columns.append(pa.array(
                        [t if t is None or not n else cut_spans(t, hit[e - k:e])
                         for t, n, e, k in zip(texts, n_hit, ends, lens, strict=True)],
                        pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns],
                                                 names=[*rows.schema.names, *added.names])

    out = StructType([*docs.select(*kept).schema.fields, *added.fields])
    return docs.select(*kept).mapInArrow(scan, out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "mark",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Find benchmark windows in ``docs`` (columns doc_id and text).

    ``mark``: one row per document row with doc_id, n_words, n_hit, n_items,
    items and contaminated. ``documents``: ``docs`` without the contaminated
    ones. ``spans``: ``docs`` with hit spans cut out of the text.

    A document is contaminated if at least one word and 5 % of its words are
    hit. NULL and empty texts have no words and are never hit; an empty
    benchmark hits nothing; repeated rows are judged each for itself. With
    several benchmark blocks hits are summed up over blocks by document row.
    """
    spark = docs.sparkSession
    blocks, sets = benchmark_blocks(benchmark, window, block_words)
    if blocks == 1:
        return _apply(docs, spark.sparkContext.broadcast(next(sets)), mode)
    return _blockwise(docs, sets, mode)


def _apply(docs: DataFrame, windows, mode: str) -> DataFrame:
    if mode == "mark":
        return scan_documents(docs.select("doc_id", "text"), windows).drop("text")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for rows, texts in slices(batch):
                lens, hit, _ = windows.value.scan(texts)
                ends = np.cumsum(lens)
                sums = np.concatenate([[0], np.cumsum(hit)])
                n_hit = sums[ends] - sums[ends - lens]
                if mode == "documents":
                    yield rows.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= lens))))
                else:
                    cut = pa.array([t if t is None or not n else cut_spans(t, hit[e - k:e])
                                    for t, n, e, k in zip(texts, n_hit, ends, lens, strict=True)],
                                   pa.binary()).cast(rows.schema.field(at).type)
                    yield rows.set_column(at, rows.schema.field(at), cut)

    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    return docs.mapInArrow(rewrite, docs.schema)


def _blockwise(docs: DataFrame, blocks: Iterator[WindowSet], mode: str) -> DataFrame:
    """One scan per block; the rows keep a running set of hit word numbers and
    items, so the order of blocks does not matter. A block is collected when the
    scan of the one before is written, and taken off the executors after its own."""
    spark = docs.sparkSession
    rows = docs.select("*", F.array().cast("array<int>").alias("_hit"),
                       F.array().cast("array<string>").alias("_items"))
    schema = rows.schema
    while (block := next(blocks, None)) is not None:
        windows = spark.sparkContext.broadcast(block)
        del block

        def scan(batches, windows=windows):
            for batch in batches:
                for part, texts in slices(batch):
                    lens, hit, found = windows.value.scan(texts)
                    ends, names = np.cumsum(lens), part.schema.names
                    old_hit, old = part.column("_hit").to_pylist(), part.column("_items").to_pylist()
                    hits = [sorted({*h, *np.flatnonzero(hit[e - k:e]).tolist()})
                            for h, e, k in zip(old_hit, ends, lens, strict=True)]
                    items = [sorted({*o, *f}) for o, f in zip(old, found, strict=True)]
                    new = {"_hit": pa.array(hits, pa.list_(pa.int32())),
                           "_items": pa.array(items, pa.list_(pa.string()))}
                    yield pa.RecordBatch.from_arrays(
                        [new.get(c, part.column(c)) for c in names], names=names)

        rows = written(rows.mapInArrow(scan, schema), "decontamination-block")
        windows.unpersist()

    def finish(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            words = [fold_words(t) for t in texts]
            hits, items = batch.column("_hit").to_pylist(), batch.column("_items").to_pylist()
            bad = [bool(h) and 20 * len(h) >= len(w) for h, w in zip(hits, words, strict=True)]
            rest = batch.select([c for c in batch.schema.names if c not in ("_hit", "_items")])
            if mode == "mark":
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(map(len, words), pa.int64()),
                     pa.array(map(len, hits), pa.int64()), pa.array(map(len, items), pa.int64()),
                     pa.array(items, pa.list_(pa.string())), pa.array(bad)],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"])
            elif mode == "documents":
                yield rest.filter(pa.array([not b for b in bad], pa.bool_()))
            else:
                at = rest.schema.get_field_index("text")
                cut = []
                for t, h, w in zip(texts, hits, words, strict=True):
                    mask = np.zeros(len(w), dtype=bool)
                    mask[h] = True
                    cut.append(cut_spans(t, mask) if h else t)
                yield rest.set_column(at, rest.schema.field(at),
                                      pa.array(cut, pa.binary()).cast(rest.schema.field(at).type))

    out = docs.schema if mode != "mark" else \
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}"
    return rows.mapInArrow(finish, out)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of every whole document; see ``decontaminate``."""
    marked = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                         "contaminated")


#: The same result from the definitions, over all windows of all texts.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
              array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b
             WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens
             WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
          GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
