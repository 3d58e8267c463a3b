"""Toxicity classifier: gradient-boosted trees over dense text features.

Features per text: densities of a lexicon (words and word beginnings that
labelled toxic documents favour, mined from the training sample, next to a
small fixed list), how near its entries stand to the second person, rates of
capitals, punctuation, symbols and obfuscated words, and length. Spark's GBT
learns on a part of the sample; an isotonic regression on the rest turns its
margins into probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import process_cache, release_memory, slices, split_words, table, written
from .labelled import SAMPLE_ROWS, held_out, training_sample

#: Entries of the mined lexicon, documents an entry must occur in, and the
#: lengths of word beginnings.
LEXICON_TERMS, MIN_DOCUMENTS, STEMS = 256, 8, (4, 5, 6)
TREES, DEPTH = 24, 4
#: Words whose codes a reader keeps: most words of a large corpus come once, the
#: frequent ones are soon back.
CACHED_WORDS = 200_000
#: Share of the sample (in tenths) that calibrates.
CALIBRATION_TENTHS = 3

#: Insults that count from the start, whatever the labels hold.
SEED_WORDS = frozenset((
    "idiot moron stupid loser trash scum pathetic worthless disgusting clown "
    "imbecile dumb fool jerk").split())
SECOND_PERSON = frozenset((
    "you your yours yourself u ur du dich dir dein deine ihr euch sie vous votre vos tu te toi "
    "ton ta tes usted ustedes ti tus vosotros").split())

#: Digits and signs that stand for letters.
_LEET = str.maketrans("013457@$!", "oieastasi")
_LETTERS = re.compile(r"[^\W\d_]+")
FEATURES = 17


def plain_word(word: str) -> str:
    """Lower-cased, without marks around it, signs for letters undone and
    separators inside it removed."""
    core = word.strip(".,;:!?\"'()[]{}<>|*#%&-_~").lower()
    if not core.isalpha():
        core = "".join(_LETTERS.findall(core.translate(_LEET)))
    return core


def terms_of(word: str) -> list[str]:
    """The lexicon keys of a plain word: itself, and its beginnings as 'x*'."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def mine_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms whose documents are toxic far more often than others, with their
    log odds; at most LEXICON_TERMS. Counts are aggregated by Spark."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                out = []
                for t in texts:
                    words = {plain_word(w) for w in set(t.decode().split())}
                    out.append(sorted({k for w in words if len(w) > 2 for k in terms_of(w)}))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("label"), pa.array(out, pa.list_(pa.string()))],
                    names=["label", "terms"])

    docs = sample.select("label", "text").mapInArrow(distinct, "label double, terms array<string>")
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic or toxic == n:
        return {}
    share = float(toxic) / n
    counts = (docs.select("label", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t"))
              .where(F.col("n") >= MIN_DOCUMENTS))
    odds = F.log((F.col("t") + 0.5 * share) / (F.col("n") - F.col("t") + 0.5 * (1 - share))) \
        - F.lit(float(np.log(share / (1 - share))))
    best = (counts.withColumn("odds", odds).where("odds > 1.5")
            .orderBy((F.col("odds") * F.sqrt("t")).desc(), "term").limit(LEXICON_TERMS).collect())
    return {r["term"]: float(r["odds"]) for r in best}


class Reader:
    """Dense features of texts, through a cache of words.

    A word's code: bits 0 to 6 mark lexicon word, lexicon beginning, second
    person, obfuscated, all capitals, stretched, symbols only; above them its
    lexicon weight in hundredths.
    """

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.codes = lexicon, {}

    def code(self, word: bytes) -> int:
        text = word.decode()
        plain = plain_word(text)
        weight, code = 0.0, 0
        if plain in SEED_WORDS or plain in self.lexicon:
            weight, code = max(2.0, self.lexicon.get(plain, 0.0)), 1
        for key in terms_of(plain)[1:]:
            if key in self.lexicon:
                weight, code = max(weight, self.lexicon[key]), code | 2
        core = text.strip(".,;:!?\"'()[]{}<>|")
        letters = sum(map(str.isalpha, core))
        code |= 4 if plain in SECOND_PERSON else 0
        code |= 8 if letters and letters < len(core) and plain else 0
        code |= 16 if letters > 1 and core.isupper() else 0
        code |= 32 if re.search(r"(\w)\1\1", plain) else 0
        code |= 64 if not letters else 0
        return code | int(min(weight, 20.0) * 100) << 7

    def of(self, texts: list[bytes | None]) -> np.ndarray:
        if len(self.codes) > CACHED_WORDS:
            self.codes.clear()
        codes, lens, words = split_words(texts)
        known = self.codes
        for w in words:
            if w not in known:
                known[w] = self.code(w)
        marks_of = np.array([known[w] for w in words] or [0], dtype=np.int64)[codes]
        out, ends = np.zeros((len(texts), FEATURES)), np.cumsum(lens)
        for i, (t, n, end) in enumerate(zip(texts, lens.tolist(), ends.tolist(), strict=True)):
            if not n:
                continue
            code, size = marks_of[end - n:end], len(t)
            weight = (code >> 7) / 100
            hit = np.flatnonzero(code & 3)
            person = np.flatnonzero(code & 4)
            near = 0
            if len(hit) and len(person):
                right = np.searchsorted(person, hit)
                gap = np.minimum(np.abs(person[np.minimum(right, len(person) - 1)] - hit),
                                 np.abs(hit - person[np.maximum(right - 1, 0)]))
                near = int((gap <= 3).sum())
            bits = [np.count_nonzero(code & (1 << b)) for b in range(7)]
            upper = len(t) - len(t.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            marks = t.count(b"!") + t.count(b"?")
            symbols = len(t) - len(t.translate(None, b"$%&*#@|~^<>"))
            out[i] = (bits[0] / n, bits[1] / n, weight.sum() / n, weight.max(), np.log1p(bits[0]),
                      np.log1p(bits[1]), np.log1p(weight.sum()), near / n, bits[2] / n, bits[3] / n,
                      bits[4] / n, bits[5] / n, bits[6] / n, upper / size, marks / size,
                      symbols / size, np.log1p(n))
        return out


def with_features(docs: DataFrame, lexicon: dict[str, float], col: str) -> DataFrame:
    """Add the dense features (array<double>) of every row's text; NULL and
    empty texts have all zeros."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    key = f"toxicity:{hash(tuple(sorted(lexicon.items())))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = process_cache(key, lambda: Reader(shared.value))
        for batch in batches:
            for rows, texts in slices(batch):
                values = reader.of(texts)
                bounds = np.arange(len(texts) + 1, dtype=np.int32) * FEATURES
                column = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*rows.columns, column],
                                                 names=[*rows.schema.names, col])
        release_memory()

    schema = StructType([*docs.schema.fields, StructField(col, ArrayType(DoubleType()))])
    return docs.mapInArrow(run, schema)


class ToxicityModel:
    """Lexicon, trees and calibration; ``prior`` alone where the sample holds
    one label only (0.5 without any)."""

    def __init__(self, lexicon, trees, calibration, prior: float):
        self.lexicon, self.trees = lexicon, trees
        self.calibration, self.prior = calibration, prior

    def score(self, docs: DataFrame, col: str = "score") -> DataFrame:
        """Add ``col``, the probability of a toxic text, to every row of
        ``docs`` (a column of that name is replaced)."""
        docs = docs.drop(col)
        if self.trees is None:
            return docs.withColumn(col, F.lit(self.prior))
        f, v, m, c = (f"_toxicity_{x}" for x in ("features", "vector", "margin", "calibrated"))
        out = with_features(docs, self.lexicon, f).withColumn(v, array_to_vector(F.col(f)))
        trees = self.trees.copy({self.trees.featuresCol: v, self.trees.rawPredictionCol: f"{v}_raw",
                                 self.trees.probabilityCol: f"{v}_p",
                                 self.trees.predictionCol: f"{v}_label"})
        out = trees.transform(out)
        out = out.withColumn(m, margin(f"{v}_p"))
        calibrated = self.calibration.copy({self.calibration.featuresCol: m,
                                            self.calibration.predictionCol: c}).transform(out)
        # Isotonic steps hold ties; the trees' own probability orders within them.
        value = (F.col(c) * 0.99 + F.col(m) * 0.01)
        return calibrated.select(*docs.columns, F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))
                                 .alias(col))


def margin(probability: str):
    from pyspark.ml.functions import vector_to_array

    return F.element_at(vector_to_array(F.col(probability)), 2)


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most ``rows`` labelled documents outside the held-out fold."""
    sample = written(training_sample(docs, labels, "toxic", rows), "toxicity-sample")
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic or toxic == n:
        return ToxicityModel({}, None, None, 0.5 if not n else float(toxic) / n)
    # The lexicon comes from the fitting part alone, so the other part's hits
    # are as rare as those of unseen documents.
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(10))
    sample = sample.withColumn("part", part)
    fitting = sample.where(F.col("part") >= CALIBRATION_TENTHS)
    lexicon = mine_lexicon(fitting)
    featured = written(
        with_features(sample, lexicon, "f").select("label", "part", "f"),
        "toxicity-features").withColumn("features", array_to_vector("f"))
    fit_rows = featured.where(F.col("part") >= CALIBRATION_TENTHS)
    if fit_rows.select("label").distinct().count() < 2:
        return ToxicityModel({}, None, None, float(toxic) / n)
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.2, subsamplingRate=1.0, seed=17).fit(fit_rows.coalesce(4))
    rest = featured.where(F.col("part") < CALIBRATION_TENTHS)
    rest = rest if rest.limit(1).count() else featured
    margins = trees.transform(rest).withColumn("margin", margin("probability"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="margin",
                                     predictionCol="calibrated").fit(
        margins.select("label", "margin"))
    return ToxicityModel(lexicon, trees, calibration, float(toxic) / n)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents scored ``threshold`` or more."""
    return model.score(docs, "_toxicity").where(F.col("_toxicity") < threshold).drop("_toxicity")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
