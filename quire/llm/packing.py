"""Lexical retrieval packing.

Documents become token ids; whole windows of long documents are sequences of
their own, and what is left of each document is packed by retrieval: the rest
pieces are sharded by a similarity signature, every shard holds a BM25 inverted
index over token ids (document frequencies are those of the whole corpus), and
each seed's unused best-scoring neighbours greedily fill its window. The last
neighbour is cut to fit and its remainder stays in the index, so only the last
sequence of a shard is padded.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, process_cache, slices, split_words, table, written

WINDOW = 4096
TOKENIZER = "word_bpe_49k.json"
EOS = 2
#: Tokens of rest pieces per index shard (bounds a task's memory and time).
SHARD_TOKENS = 2_000_000
#: Query terms per seed, and neighbours looked at per window.
QUERY_TERMS, NEIGHBOURS = 16, 64
K1, B = 1.2, 0.75
#: Words whose ids a worker process remembers.
CACHED_WORDS = 500_000

PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Texts of these characters only are plain: white space and printable ASCII but the apostrophe, and
#: letters below U+0250 that keep their form under NFC and lower-case one by one.
_PLAIN = re.compile("[\t-\r -&(-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]*")
_MARKS = re.compile(rb"([!-&(-/:-@\[-`{-~]+)")


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Token ids of whole texts through a cache of words.

    The tokenizer normalises and splits each stretch between white space by
    itself, so a text's ids are its words' ids one after the other. In a plain
    text it also cuts marks from letters and digits, so those are parted first
    and far fewer words differ.
    """

    def __init__(self, path: str, eos: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.eos = Tokenizer.from_file(path), eos
        self.letters = str.maketrans(byte_letters())
        self._reset()

    def _reset(self) -> None:
        #: word -> row; row r has the ids flat[start[r]:start[r + 1]].
        self.rows: dict[bytes, int] = {}
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _parted(self, text: bytes | None) -> bytes:
        if text and b"<|" not in text and _PLAIN.fullmatch(text.decode()):
            return _MARKS.sub(rb" \1 ", text).lower()
        return text or b""

    def _word(self, word: bytes) -> list[int]:
        text = word.decode()
        if text.isalpha() and _PLAIN.fullmatch(text):  # one run of letters: the model alone
            text = text.lower().encode().decode("latin-1").translate(self.letters)
            return [t.id for t in self.tokenizer.model.tokenize(text)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text's followed by the end mark, and
        the ids per text."""
        codes, lens, words = split_words([self._parted(t) for t in texts])
        if len(self.rows) > CACHED_WORDS:
            self._reset()
        new = [w for w in words if w not in self.rows]
        if new:
            ids = [self._word(w) for w in new]
            self.rows.update(zip(new, range(len(self.start) - 1, len(self.start) - 1 + len(new)),
                                 strict=True))
            self.flat = np.concatenate([self.flat, np.array(list(chain(*ids)), np.uint32)])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(list(map(len, ids)))])
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        begin, size = self.start[rows], self.start[rows + 1] - self.start[rows]
        # The ids of the slice's distinct words and of the end mark, then every
        # text's words and its end mark as rows of these.
        begin, size = np.append(begin, len(self.flat)), np.append(size, 1)
        flat = np.append(self.flat, np.uint32(self.eos))
        ends = np.cumsum(lens)
        row = np.insert(codes, ends, len(rows))
        width = size[row]
        until = np.cumsum(width)
        out = flat[np.repeat(begin[row] - (until - width), width) + np.arange(width.sum())]
        return out, np.diff(np.concatenate([[0], until[ends + np.arange(len(texts))]]))


def signature(ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Per text a MinHash of its token pairs: similar texts tend to share it."""
    ends = np.cumsum(lens)
    pair = ids.astype(np.uint64)
    pair[:-1] |= pair[1:] << np.uint64(32)
    h = mixed(pair) >> np.uint64(1)
    return np.minimum.reduceat(h, ends - lens).astype(np.int64)


def tokenized(docs: DataFrame, path: str, eos: int) -> DataFrame:
    """doc_id, n (ids with the end mark), ids (binary, uint16 where the
    vocabulary allows, else uint32) and signature, written once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = process_cache(f"tokenizer:{path}:{eos}", lambda: WordTokenizer(path, eos))
        kind = id_type(coder.tokenizer.get_vocab_size())
        for batch in batches:
            for rows, texts in slices(batch):
                ids, lens = coder.encode(texts)
                ends, data = np.cumsum(lens), ids.astype(kind)
                cuts = zip((ends - lens).tolist(), ends.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(lens),
                     pa.array([data[a:b].tobytes() for a, b in cuts], pa.binary()),
                     pa.array(signature(ids, lens))],
                    names=["doc_id", "n", "ids", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, n long, ids binary, signature long")
    return written(out, "tokens")


def id_type(vocabulary: int):
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def distinct_terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of one text with their counts (16-bit ids sort by radix)."""
    s = np.sort(ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.append(first, len(s)))


def document_frequencies(tokens: DataFrame, kind) -> tuple[np.ndarray, int, float]:
    """Document frequency per token id over all documents (as many numbers as
    the vocabulary has ids), the number of documents and their mean length."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                terms, _ = distinct_terms(np.frombuffer(raw, dtype=kind))
                if terms[-1] >= len(df):
                    df = np.concatenate([df, np.zeros(int(terms[-1]) + 1, dtype=np.int64)])
                df[terms] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    rows = (tokens.select("ids").mapInArrow(count, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toPandas())
    n, mean = tokens.agg(F.count(F.lit(1)), F.avg("n")).first()
    df = np.zeros(int(rows["term"].max()) + 1 if len(rows) else 1, dtype=np.int64)
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return df, n, float(mean or 1.0)


class Shard:
    """BM25 inverted index over the rest pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        self.lens = np.array([len(p) for p in pieces])
        n_terms, docs, weights, terms = [], [], [], []
        for d, p in enumerate(pieces):
            t, tf = distinct_terms(p)
            w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(p) / mean))
            terms.append(t)
            docs.append(np.full(len(t), d, dtype=np.int32))
            weights.append(w.astype(np.float32))
            n_terms.append(len(t))
        self.bounds = np.concatenate([[0], np.cumsum(n_terms)])
        self.terms, self.weights = np.concatenate(terms), np.concatenate(weights)
        order = np.argsort(self.terms, kind="stable")
        self.post_docs, self.post_weights = np.concatenate(docs)[order], self.weights[order]
        self.post_bounds = np.searchsorted(self.terms[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused pieces by falling BM25 score against the seed's strongest
        terms; pieces without a common term are left out."""
        a, b = self.bounds[seed], self.bounds[seed + 1]
        w = self.weights[a:b]
        top = np.argpartition(-w, QUERY_TERMS)[:QUERY_TERMS] if len(w) > QUERY_TERMS else slice(None)
        spans = [(self.post_bounds[t], self.post_bounds[t + 1]) for t in self.terms[a:b][top]]
        docs = np.concatenate([self.post_docs[x:y] for x, y in spans])
        score = np.bincount(docs, weights=np.concatenate([self.post_weights[x:y] for x, y in spans]),
                            minlength=len(self.lens))
        score[~unused] = 0
        best = np.argpartition(-score, NEIGHBOURS)[:NEIGHBOURS] if len(score) > NEIGHBOURS \
            else np.arange(len(score))
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))]


def fill_windows(index: Shard, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (piece, start, length); each id of each piece is in
    exactly one. A seed without unused neighbours left is followed by the next
    unused piece, which becomes the seed of what is left of the window."""
    left, start = index.lens.copy(), np.zeros(len(index.lens), dtype=np.int64)
    unused, sequences, at = left > 0, [], 0
    while True:
        room, sequence = window, []
        while room:
            while at < len(left) and not unused[at]:
                at += 1
            if at == len(left):
                break
            queue, seeded = [at], False
            while queue and room:
                d = queue.pop(0)
                take = int(min(left[d], room))
                sequence.append((d, int(start[d]), take))
                start[d] += take
                left[d] -= take
                room -= take
                unused[d] = left[d] > 0
                if not seeded and room:
                    queue, seeded = pick(index.neighbours(d, unused).tolist(), left, room), True
        if not sequence:
            return sequences
        sequences.append(sequence)


def pick(ranked: list[int], left: np.ndarray, room: int) -> list[int]:
    """Neighbours in rank order that fit whole; then the best one that is left,
    which will be cut."""
    chosen, cut = [], None
    for d in ranked:
        if left[d] <= room:
            chosen.append(d)
            room -= int(left[d])
        elif cut is None:
            cut = d
    return [*chosen, cut] if room and cut is not None else chosen


def pack(docs: DataFrame, path: str | None = None, eos: int = EOS, window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``window`` ids.

    One row per piece: doc_id, start (the document's ids before it), length,
    ids_crc32, doc_tokens (ids with the end mark), sequence_id, offset and,
    with ``with_ids``, the ids as little-endian uint32. A NULL or empty text is
    the end mark alone; every row is a document of its own, repeated rows and
    ids too; an empty table gives an empty table.
    """
    from tokenizers import Tokenizer

    path = path or tokenizer_path()
    spark = docs.sparkSession
    kind = id_type(Tokenizer.from_file(path).get_vocab_size())
    tokens = tokenized(docs, path, eos)
    df, n_docs, mean = document_frequencies(tokens, kind)
    idf = spark.sparkContext.broadcast(np.log1p((n_docs - df + 0.5) / (df + 0.5)))
    rest_tokens = tokens.agg(F.sum(F.col("n") % window)).first()[0] or 0
    schema = PIECES.format(id=docs.schema["doc_id"].dataType.simpleString())

    def piece_batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in schema.split(", ")]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        types = [None] + [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def piece(doc_id, ids: np.ndarray, start: int, doc_tokens: int, sequence: int, offset: int):
        raw = ids.astype("<u4").tobytes()
        return (doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, sequence, offset,
                raw if with_ids else None)

    def whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for doc_id, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids")),
                                      strict=True):
                ids = np.frombuffer(raw, dtype=kind)
                for a in range(0, n - window + 1, window):
                    rows.append(piece(doc_id, ids[a:a + window], a, n, 2 * sequence + 1, 0))
                    sequence += 1
            if rows:
                yield piece_batch(rows)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "rest")), strict=True)
        if not held:
            return
        pieces = [np.frombuffer(raw, dtype=kind) for _, _, raw in held]
        sequence = TaskContext.get().partitionId() << 33
        rows = []
        for members in fill_windows(Shard(pieces, idf.value, mean), window):
            offset = 0
            for d, start, length in members:
                doc_id, n, _ = held[d]
                rows.append(piece(doc_id, pieces[d][start:start + length],
                                  n - len(pieces[d]) + start, n, 2 * sequence, offset))
                offset += length
            sequence += 1
            if len(rows) >= 4096:
                yield piece_batch(rows)
                rows = []
        if rows:
            yield piece_batch(rows)

    width = kind.itemsize
    full = tokens.where(F.col("n") >= window).select("doc_id", "n", "ids")
    rests = tokens.where(F.col("n") % window > 0).select(
        "doc_id", "n", "signature",
        F.expr(f"substring(ids, int({width} * (n - n % {window}) + 1))").alias("rest"))
    shards = max(1, -(-rest_tokens // shard_tokens))
    packed = (rests.repartitionByRange(shards, "signature", "doc_id")
              .mapInArrow(fill, schema))
    out = full.mapInArrow(whole_windows, schema).unionByName(packed)
    return out if with_ids else out.drop("ids")


def op4_bm25_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed; see ``pack``."""
    return pack(table(spark, sf_dir, "documents"))
