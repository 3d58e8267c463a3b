"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the bytes of a text at different places. Byte offsets where
tokens of both end are shared cuts, and the tokens between neighbouring cuts are
a group. They are found by dividing: in a stretch of both token lists a common
end near the middle is located by bisection, and both halves are divided again;
a stretch without a common end inside is a group. All stretches of one depth are
divided at once, over the texts of a whole slice.

The last tokens of a group end together: that is a link. How often each pair of
ids is linked is counted over the whole corpus, and every document is scored by
those counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, slices, table, written

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Distinct stretches of text, and their ids, that a task remembers.
CACHED, CACHED_IDS = 150_000, 1_000_000
#: Stretches tokenized at a time.
LEARN = 2048
#: Text bytes tokenized and divided at a time.
SLICE = 1 << 19
#: Linked pairs up to which their counts are broadcast (17 bytes each); beyond
#: that the documents' pairs are joined with them.
BROADCAST_PAIRS = 2_000_000

_PLAIN = re.compile(rb"[ \t-\r]*[^ \t-\r]*")
#: White space beyond ASCII, which may stand at a stretch's edge.
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bytes that begin it in UTF-8, and runs of white space.
_CAREFUL = (b"  ", b" \n", b"\n ", b"\n\n", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe1\xa0",
            b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
_CONTROL = b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
#: Characters whose classes no version of Unicode has changed.
_SETTLED = re.compile("[\x00-\x1b\x20-\x7f\xa1-\u024f]*")
#: Fixed value: how byte-level vocabularies of this kind part a text before merging.
_PARTS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteLevel:
    """Tokenizer A: ids of a text and the bytes of each id."""

    def __init__(self, path: str):
        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bytes_of, vocabulary = byte_values(), spec["model"]["vocab"]
        vocabulary |= {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.size = max(vocabulary.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in vocabulary.items():
            if all(c in bytes_of for c in token):
                self.bytes[i] = bytes(bytes_of[c] for c in token)
        self.quick = self._quick(spec)

    def _quick(self, spec: dict):
        """The same merges in a faster library, where the file's ids are in the
        order of its merges; None where they are not."""
        import tiktoken

        parts, model = spec["pre_tokenizer"] or {}, spec["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        usual = (parts.get("type") == "ByteLevel" and parts.get("use_regex")
                 and not parts.get("add_prefix_space") and not spec["normalizer"])
        if not usual or [model["vocab"][m] for m in merged] != [*range(256, 256 + len(merged))]:
            return None
        return tiktoken.Encoding("merges", pat_str=_PARTS, special_tokens={}, mergeable_ranks={
            self.bytes[i]: i for i in range(256 + len(merged))})

    def _own(self, texts: list[str]) -> list[list[int]]:
        """By the file's own library, loaded when first needed."""
        if self.slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return [e.ids for e in self.slow.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [self.quick.encode_ordinary(t) if self.quick and _SETTLED.fullmatch(t) else None
               for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            for i, ids in zip(rest, self._own([texts[i] for i in rest]), strict=True):
                out[i] = ids
        return out


def byte_values() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    Latin-1 for itself, the others from U+0100 on in their order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """Tokenizer B: it writes a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                      else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.model.piece_to_id("▁")
        plain = [p for i, p in enumerate(pieces) if not (
            self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        #: White space inside pieces: texts with it are not cut into stretches.
        self.joining = {c for p in plain for c in "\t\n\x0b\x0c\r" if c in p}
        if any("▁" in p.lstrip("▁") for p in plain):
            self.joining.add(" ")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """``texts`` begin with the space that the model would add, or with other
        white space, before which the space that it does add is taken off."""
        bare = [t[1:] if t[:1] == " " else t for t in texts]
        # Without a text the model writes no space either.
        return [[self.space] if t == " " else ids if t[:1] == " " else
                ids[1:] if ids[:1] == [self.space] else []
                for t, ids in zip(texts, self.model.encode(bare, num_threads=1), strict=True)]


class Pair:
    """Tokens of both tokenizers for whole texts, through a cache of stretches
    (white space and what follows up to the next): neither joins tokens across
    the start of one, so a text's tokens are its stretches' one after the other.
    Texts for which that does not hold are one stretch."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        joining = "".join(sorted(self.b.joining))
        self.joining = re.compile(f"[{re.escape(joining)}]") if joining else None
        self.width = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[bytes, int] = {}
        #: Row r of tokenizer k has the ids flat[k][start[k][r]:start[k][r + 1]]
        #: if known[r]; else the bytes of its tokens differ from the text's.
        self.flat = [np.zeros(0, np.int64) for _ in "ab"]
        self.start = [np.zeros(1, np.int64) for _ in "ab"]
        self.known = np.zeros(0, bool)

    def _parted(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The stretches of the texts, as codes one text after the other; how many
        each text has; and the distinct ones in the order of their codes. Where
        single spaces and line feeds are all the white space, the texts are
        parted together."""
        plain, others, counts = [], {}, np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if not t:
                continue
            if (any(c in t for c in _CAREFUL) or t[:1] in b" \n" or t[-1:] in b" \n"
                    or len(t.translate(None, _CONTROL)) != len(t)):
                others[i] = self._stretches(b" " + t)
            else:
                plain.append(i)
        column = pa.array([texts[i].replace(b"\n", b" \n") for i in plain], pa.binary())
        parts = pc.split_pattern(column.cast(pa.large_string()), " ")
        coded = parts.values.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        words = [w if w[:1] == b"\n" else b" " + w
                 for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
        counts[plain] = np.diff(parts.offsets.to_numpy())
        if others:
            code = dict(zip(words, range(len(words)), strict=True))
            for i, p in others.items():
                counts[i] = len(p)
            start, out = np.cumsum(counts) - counts, np.empty(counts.sum(), np.int64)
            size = counts[plain]
            out[np.arange(len(codes)) + np.repeat(start[plain] - (np.cumsum(size) - size), size)] = codes
            for i, p in others.items():
                out[start[i]:start[i] + len(p)] = [code.setdefault(w, len(code)) for w in p]
            codes, words = out, [*code]
        return codes, counts, words

    def _stretches(self, text: bytes) -> list[bytes]:
        s = text.decode()
        if (self.joining and self.joining.search(s, 1)) or _WIDE_SPACE.search(s):
            return [text]
        return _PLAIN.findall(text)[:-1]

    def _learn(self, new: list[bytes]) -> None:
        texts = [n.decode() for n in new]
        known = np.ones(len(new), bool)
        for k, tokenizer in enumerate((self.a, self.b)):
            ids = tokenizer.encode(texts)
            flat = [*chain(*ids)]
            if b"".join(map(tokenizer.bytes.__getitem__, flat)) != b"".join(new):
                known &= [b"".join(map(tokenizer.bytes.__getitem__, i)) == n
                          for i, n in zip(ids, new, strict=True)]
            self.flat[k] = np.concatenate([self.flat[k], np.array(flat, np.int64)])
            self.start[k] = np.concatenate([self.start[k],
                                            self.start[k][-1] + np.cumsum([*map(len, ids)])])
        self.rows.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.known = np.concatenate([self.known, known])

    def encode(self, texts: list[bytes | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both tokenizers, all texts one after the other, and the ids
        per text: none where the text is empty or a tokenizer changes it."""
        codes, counts, words = self._parted(texts)
        if len(self.rows) > CACHED or len(self.flat[0]) > CACHED_IDS:
            self._reset()
        new = [w for w in words if w not in self.rows]
        for i in range(0, len(new), LEARN):
            self._learn(new[i:i + LEARN])
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))[codes]
        text = np.repeat(np.arange(len(texts)), counts)
        good = np.bincount(text, weights=~self.known[rows], minlength=len(texts)) == 0
        if not good.all():
            rows, text = rows[good[text]], text[good[text]]
        ids, lens = [], []
        for flat, start in zip(self.flat, self.start, strict=True):
            begin, size = start[rows], start[rows + 1] - start[rows]
            until = np.cumsum(size)
            ids.append(flat[np.repeat(begin - (until - size), size) + np.arange(size.sum())])
            lens.append(np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64))
        return ids, lens


def shared_cuts(a: np.ndarray, b: np.ndarray, lens_a: np.ndarray, lens_b: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``a`` and ``b`` of the tokens that end together, in order.
    ``a`` and ``b`` are the ends (rising) of the tokens of all texts one after the
    other, with ``lens_a`` and ``lens_b`` tokens per text; the last tokens of a
    text end together.

    A stretch is the tokens a[i:j] and b[k:l], whose last ones end together. Its
    cut is a common end before that, looked for by bisection from the middle
    token of ``a`` outwards; the tokens up to it and those after it are the next
    stretches. One without a cut is a group. All stretches of a depth are
    bisected together.
    """
    until_a, until_b = np.cumsum(lens_a), np.cumsum(lens_b)
    some = lens_a > 0
    i, j = (until_a - lens_a)[some], until_a[some]
    k, l = (until_b - lens_b)[some], until_b[some]
    found_a, found_b = [j - 1], [l - 1]
    while True:
        more = (j - i > 1) & (l - k > 1)
        i, j, k, l = i[more], j[more], k[more], l[more]
        if not len(i):
            break
        cut_a, cut_b = middle_cuts(a, b, i, j, k, l)
        hit = cut_a >= 0
        i, j, k, l, cut_a, cut_b = (x[hit] for x in (i, j, k, l, cut_a, cut_b))
        found_a.append(cut_a)
        found_b.append(cut_b)
        i, j = np.concatenate([i, cut_a + 1]), np.concatenate([cut_a + 1, j])
        k, l = np.concatenate([k, cut_b + 1]), np.concatenate([cut_b + 1, l])
    cuts_a, cuts_b = np.concatenate(found_a), np.concatenate(found_b)
    return np.sort(cuts_a), np.sort(cuts_b)  # both rise together


def middle_cuts(a, b, i, j, k, l) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch the common end nearest to its middle token of ``a`` (the
    last tokens aside), as indexes into ``a`` and ``b``; -1 where there is none."""
    cut_a, cut_b = np.full(len(i), -1), np.full(len(i), -1)
    middle, open_, step = (i + j - 1) // 2, np.arange(len(i)), 0
    while len(open_):
        for side in ((0,) if not step else (-step, step)):
            at = middle[open_] + side
            ok = (at >= i[open_]) & (at < j[open_] - 1) & (cut_a[open_] < 0)
            s, at = open_[ok], at[ok]
            place = np.searchsorted(b, a[at])
            # Ends rise over all texts, so a found one lies in the stretch.
            hit = b[np.minimum(place, len(b) - 1)] == a[at]
            cut_a[s[hit]], cut_b[s[hit]] = at[hit], place[hit]
        step += 1
        left = (cut_a[open_] < 0) & ((middle[open_] - step >= i[open_])
                                     | (middle[open_] + step < j[open_] - 1))
        open_ = open_[left]
    return cut_a, cut_b


class Writer:
    """The groups of texts as ``a1,a2|b1;a3|b2``: every token's digits and the
    mark after it are one string of a table."""

    def __init__(self, size_a: int, size_b: int):
        self.size_a, self.size_b = size_a, size_b
        digits = [[str(i) for i in range(n)] for n in (size_a, size_b)]
        self.strings = pa.array(
            [d + m for m in ",|" for d in digits[0]]
            + [d + m for m in (",", ";", "") for d in digits[1]], pa.binary())

    def write(self, ids: list[np.ndarray], cuts: list[np.ndarray], lens: list[np.ndarray]
              ) -> list[memoryview]:
        """The string of each text (empty without tokens)."""
        (a, b), (cut_a, cut_b) = ids, cuts
        if not len(a):
            return [memoryview(b"")] * len(lens[0])
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a], last_b[cut_b] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends = np.cumsum(lens[1])
        mark = last_b.copy()
        mark[ends[lens[1] > 0] - 1] = 2
        # A group's tokens of a come after those of b of the groups before, and
        # its tokens of b after those of a up to its own.
        before_b = np.concatenate([[0], cut_b + 1])
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + before_b[group_a]] = a + self.size_a * last_a
        code[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * self.size_a + b + self.size_b * mark
        out = self.strings.take(pa.array(code))
        place = np.frombuffer(out.buffers()[1], np.int32, len(code) + 1)
        data = memoryview(out.buffers()[2])
        at = place[np.concatenate([[0], np.cumsum(lens[0] + lens[1])])].tolist()
        return [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


ALIGNED = ("doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document the counts, the digest of its groups and its links (for each
    group the last ids a and b as the number a * ids of B + b, eight bytes or
    four where they suffice), written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = writer = None
        for batch in batches:
            if pair is None:
                pair = Pair(path_a, path_b)
                writer = Writer(pair.a.size, pair.b.size)
                kind = link_type(pair.a.size * pair.b.size)
                release_memory()
            for rows, texts in slices(batch, max_bytes=SLICE):
                ids, lens = pair.encode(texts)
                # Ends count on over the texts, as the bytes of both are the same.
                a, b = (np.cumsum(w[x]) for w, x in zip(pair.width, ids, strict=True))
                cuts = shared_cuts(a, b, *lens)
                link = (ids[0][cuts[0]] * pair.b.size + ids[1][cuts[1]]).astype(kind)
                groups = np.searchsorted(cuts[0], np.concatenate([[0], np.cumsum(lens[0])]))
                raw = memoryview(link.tobytes())
                at = (groups * kind.itemsize).tolist()
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *map(pa.array, lens), pa.array(np.diff(groups)),
                     pa.array([hashlib.sha256(x).hexdigest() if len(x) else ""
                               for x in writer.write(ids, cuts, lens)], pa.string()),
                     pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:], strict=True)],
                              pa.binary())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])
        pair = writer = None
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(run, ALIGNED.format(id=kind)),
                   "aligned")


def link_type(codes: int) -> np.dtype:
    return np.dtype("<u4") if codes <= 1 << 32 else np.dtype("<u8")


def counted_pairs(rows: DataFrame, size_a: int, size_b: int) -> DataFrame:
    """(pair, n, best): how often the corpus links each pair of ids, and whether
    no other id of A is linked with its id of B more often. Tasks count their
    documents first, so a pair of every document is a row per task."""
    kind = link_type(size_a * size_b)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs, counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)

        def settle():
            new = np.frombuffer(b"".join(held), kind)
            new, n = np.unique(new, return_counts=True)
            every, place = np.unique(np.concatenate([pairs, new.astype(np.int64)]),
                                     return_inverse=True)
            return every, np.bincount(place, weights=np.concatenate([counts, n])).astype(np.int64)

        size = 0
        for batch in batches:
            for raw in batch.column("links"):
                held.append(raw.as_buffer())
                size += len(held[-1])
                if size > 8 << 20:
                    pairs, counts = settle()
                    held, size = [], 0
        pairs, counts = settle()
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    counts = rows.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", F.col("pair") % size_b), "linked-pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return written(counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top"))
                                                .alias("best")), "counted-pairs")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a and n_b (tokens of both), n_groups,
    n_links, n_best (links whose pair of ids the corpus links as often as any
    with that id of B), count_sum (of the links' pairs' corpus counts) and
    groups_sha256.

    NULL and empty texts, and those that a tokenizer does not give back byte for
    byte, have no tokens: zeros and an empty digest. Every row counts, rows that
    repeat an id or a text too; ids may be NULL. Other columns are left out. An
    empty table gives an empty table. No token of either vocabulary is empty, so
    each group has one link, its last tokens.
    """
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    size_a, size_b = ByteLevel(path_a).size, Pieces(path_b).size
    rows = aligned(docs, path_a, path_b)
    pairs = counted_pairs(rows, size_a, size_b)
    if pairs.count() <= broadcast_pairs:
        scored = scored_by_broadcast(rows, pairs, link_type(size_a * size_b))
    else:
        scored = scored_by_join(rows, pairs, link_type(size_a * size_b))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                         "n_best", "count_sum", "groups_sha256")


def scored_by_broadcast(rows: DataFrame, pairs: DataFrame, kind: np.dtype) -> DataFrame:
    """``rows`` with n_best and count_sum; all pairs in every task."""
    t = pairs.toArrow().sort_by("pair")
    shared = rows.sparkSession.sparkContext.broadcast(
        (t["pair"].to_numpy().astype(kind), t["n"].to_numpy(), t["best"].to_numpy().astype(np.int8)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            for part, raws in slices(batch, "links", SLICE):
                at = np.searchsorted(pair, np.frombuffer(b"".join(raws), kind))
                ends = np.concatenate([[0], np.cumsum([len(r) for r in raws])]) // kind.itemsize
                out = []
                for values in (best[at].astype(np.int64), n[at]):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    out.append(pa.array(sums[ends[1:]] - sums[ends[:-1]]))
                keep = [c for c in batch.schema.names if c != "links"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *out],
                                                 names=[*keep, "n_best", "count_sum"])

    kept = rows.drop("links")
    return rows.mapInArrow(run, f"{schema_of(kept)}, n_best long, count_sum long")


def scored_by_join(rows: DataFrame, pairs: DataFrame, kind: np.dtype) -> DataFrame:
    """The same by a join: each document's distinct pairs as rows meet the
    counts, and the sums go back to the documents. ``rows`` is a written table,
    so a row's place in it names the row; a pair of very many documents is a
    skewed join key with one row on the other side, which Spark splits."""
    placed = rows.withColumn("row", F.monotonically_increasing_id())
    placed = written(placed, "placed")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in zip(batch.column("row").to_pylist(), batch.column("links").to_pylist(),
                                strict=True):
                pair, times = np.unique(np.frombuffer(raw, kind), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), row)), pa.array(pair.astype(np.int64)),
                     pa.array(times)], names=["row", "pair", "times"])

    links = placed.select("row", "links").mapInArrow(unpack, "row long, pair long, times long")
    sums = links.join(pairs, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return placed.drop("links").join(sums, "row", "left").select(
        *rows.drop("links").columns, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"))


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """All documents aligned; see ``align``."""
    return align(table(spark, sf_dir, "documents"))
