"""Quality classifier: hashed word n-grams and logistic regression.

Each text gives hashed n-grams of its words and of its words' shapes (letter
case and the marks around the word). The weights are learned by
follow-the-regularised-leader updates (FTRL-proximal), on several shards in
parallel whose weights are averaged by feature, and a text's score is the
sparse dot product of its features with the averaged weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import BASE, inside, mixed, process_cache, slices, split_words, table
from .labelled import SAMPLE_ROWS, held_out, training_sample

BITS = 18
#: n-gram lengths over words and over word shapes.
WORD_GRAMS, SHAPE_GRAMS = (1, 2), (1, 2, 3)
SHARDS, EPOCHS = 8, 3
#: FTRL-proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.01, 1.0
CACHED_WORDS = 300_000

_EDGES = re.compile(r"^([^\w]*)(.*?)([^\w]*)$", re.DOTALL)


def word_codes(word: bytes) -> tuple[int, int]:
    """Hashes of a word's lower-cased core and of its shape."""
    before, core, after = _EDGES.match(word.decode()).groups()
    case = "0" if not core else "X" if core.isupper() else "x" if core.islower() else \
        "Xx" if core[0].isupper() else "d" if core.isdigit() else "m"
    shape = f"{before}\t{case}\t{after}"
    return (xxhash.xxh3_64_intdigest(core.lower()) | 1, xxhash.xxh3_64_intdigest(shape) | 1)


class Features:
    """Hashed n-gram features of texts, through a cache of words."""

    def __init__(self, bits: int = BITS):
        self.bits, self.at, self.codes = bits, {}, np.zeros((2, 1024), dtype=np.uint64)

    def _index(self, word: bytes) -> int:
        i = self.at.get(word)
        if i is None:
            i = len(self.at)
            if i == self.codes.shape[1]:
                self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)], axis=1)
            self.codes[:, i] = word_codes(word)
            self.at[word] = i
        return i

    def of(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each n-gram kind: feature index of every occurrence, and the text
        it belongs to. Every text also has one constant feature."""
        if len(self.at) > CACHED_WORDS:
            self.__init__(self.bits)
        codes, lens, words = split_words(texts)
        rows = np.array([self._index(w) for w in words] or [0], dtype=np.int64)
        at = rows[codes]
        owner = np.repeat(np.arange(len(texts)), lens)
        mask = np.uint64((1 << self.bits) - 1)
        out = [(np.zeros(len(texts), np.int64), np.arange(len(texts)))]
        for stream, lengths in enumerate((WORD_GRAMS, SHAPE_GRAMS)):
            code = self.codes[stream][at]
            for n in lengths:
                if n > len(code):
                    continue
                h = code[:len(code) - n + 1].copy()
                for j in range(1, n):
                    h = h * np.uint64(BASE) + code[j:len(code) - n + 1 + j]
                keep = inside(lens, n)
                h = mixed(h + np.uint64(n + 10 * stream))
                out.append(((h & mask).astype(np.int64)[keep], owner[:len(h)][keep]))
        return out


def dot(features, weights: np.ndarray, n: int) -> np.ndarray:
    """Weight sum of each text over the root of its number of features."""
    total, size = np.zeros(n), np.zeros(n)
    for index, owner in features:
        total += np.bincount(owner, weights=weights[index], minlength=n)
        size += np.bincount(owner, minlength=n)
    return total / np.sqrt(np.maximum(size, 1))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int = BITS) -> np.ndarray:
    """Weights after EPOCHS passes of FTRL-proximal over sparse rows (feature,
    value, label)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weight(zi, ni):
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for index, value, label in rows:
            zi, ni = z[index], n[index]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[index] = ni + g * g
    return weight(z, n)


def fit(sample: DataFrame, bits: int = BITS) -> np.ndarray:
    """Averaged weights of SHARDS models, each learned in a task of its own on
    its rows of ``sample`` (doc_id, text, label), in the order of a hash of the
    id. The result has 2**bits numbers."""
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Features(bits)
        for batch in batches:
            for rows, texts in slices(batch):
                found = coder.of(texts)
                index = np.concatenate([i for i, _ in found])
                owner = np.concatenate([o for _, o in found])
                keys, counts = np.unique((owner << bits) | index, return_counts=True)
                cuts = np.searchsorted(keys >> bits, np.arange(len(texts) + 1))
                data = [(keys[a:b] & ((1 << bits) - 1)).astype("<u4").tobytes()
                        + counts[a:b].astype("<u4").tobytes()
                        for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("label"), pa.array(data, pa.binary())],
                    names=["doc_id", "label", "features"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("order")
        rows = []
        for raw, label in zip(part["features"], part["label"], strict=True):
            both = np.frombuffer(raw, dtype="<u4").reshape(2, -1)
            counts = both[1].astype(float)
            rows.append((both[0], counts / np.sqrt(counts.sum()), label))
        w = ftrl(rows, bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"feature": at, "weight": w[at], "rows": len(part)})

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "label", "text").mapInArrow(
        sparse, f"doc_id {kind}, label double, features binary")
    order = F.xxhash64(F.lit(7), "doc_id")
    rows = rows.withColumn("order", order).withColumn("shard", F.pmod("order", F.lit(SHARDS)))
    models = rows.groupBy("shard").applyInPandas(
        lambda part: learn(part), "feature long, weight double, rows long")
    mean = (models.groupBy("feature").agg((F.sum("weight") / SHARDS).alias("weight"))).toPandas()
    weights = np.zeros(1 << bits)
    weights[mean["feature"].to_numpy(dtype=np.int64)] = mean["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, col: str = "score") -> DataFrame:
    """Add ``col``, the probability of label 1, to every row. NULL and empty
    texts are scored by the constant alone."""
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = [c for c in docs.columns if c.lower() != col.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = process_cache(f"quality:{bits}", lambda: Features(bits))
        for batch in batches:
            for rows, texts in slices(batch):
                margin = dot(coder.of(texts), model.value, len(texts))
                p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(p)],
                                                 names=[*rows.schema.names, col])

    schema = StructType([*docs.select(*kept).schema.fields, StructField(col, DoubleType())])
    return docs.select(*kept).mapInArrow(run, schema)


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from labels.quality; without labelled rows every score
    is one half."""
    return fit(training_sample(docs, labels, "quality", rows))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train_quality(docs, table(spark, sf_dir, "labels"))
    return score(docs, weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
