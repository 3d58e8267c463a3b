"""Document fingerprints by consistent weighted sampling.

A text's terms are its pairs of adjacent words, weighted by how often they
occur. For each of SAMPLES samples every term has a gamma-based draw of its own,
and the sample is the term (and its quantised weight) with the smallest one,
which two texts share with the probability of the generalised Jaccard similarity
of their weights. A fingerprint lists the samples, and the share of equal ones
estimates the similarity. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.ordering import global_index

from .common import table, written

#: Samples of a fingerprint, those drawn in one row, and codes in a long.
SAMPLES, ROW, LANES = 64, 8, 4
#: Bits of a draw beside a code of 16 in a positive long.
BITS = 47
#: Tells the hashes of one term and row apart (times their number, below 2**63).
SPREAD = 0x02545F4914F6CDD1
#: Stands for a NULL doc_id in join keys (the smallest long: last in falling order).
NO_ID = -(1 << 63)
#: Characters of text per partition of the term counting (bounds its memory).
PARTITION_CHARS = 4_000_000


def uniform(number: Column, bits: int) -> Column:
    """A number in (0, 1) from a whole one of so many bits."""
    return (number + 0.5) * F.lit(1.0 / (1 << bits))


def terms(text: Column) -> Column:
    """array of (this word, next word or NULL) in lower case."""
    words = F.split(F.trim(F.lower(text)), r"\s+")
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, F.size(words)).alias("b"))


def code_of(term: Column, t: Column) -> Column:
    """1 to 65535 for a term and its quantised weight."""
    return F.pmod(F.xxhash64(term, t), F.lit(65535)) + 1


def packed(number: Column, code: Column) -> Column:
    """A number of BITS bits and a code in one long that orders by the number."""
    return F.shiftleft(number, 63 - BITS).bitwiseOR(code)


def drawn(counts: DataFrame) -> DataFrame:
    """``counts`` with a row per ROW samples, ``row``, and for sample i of it what
    does not depend on the weight: ``seed``, the number n{i} that draws weight 1,
    and the same packed with its code, p{i}."""
    rows = counts.withColumn("code", code_of(F.col("term"), F.lit(0).cast("long"))).withColumn(
        "row", F.explode(F.array(*map(F.lit, range(SAMPLES // ROW)))))
    seeded = rows.withColumn("seed", F.xxhash64("term", "row"))
    numbers = seeded.select("*", *[
        F.shiftrightunsigned(F.xxhash64(F.col("seed").bitwiseXOR(F.lit((i + 1) * SPREAD))),
                             64 - BITS).alias(f"n{i}") for i in range(ROW)])
    return numbers.select(*counts.columns, "row", "seed", *[f"n{i}" for i in range(ROW)], *[
        packed(F.col(f"n{i}"), F.col("code")).alias(f"p{i}") for i in range(ROW)])


def weighted_draw(weight: Column, i: int) -> Column:
    """A weighted term's draw for sample i of a row, packed with the code of the
    term and its quantised weight; NULL for weight 0. The smallest draw is the
    largest value here, as a draw d is kept as exp(-d).

    Consistent sampling takes r and c of Gamma(2, 1) and a uniform beta, quantises
    to t = floor(ln(w) / r + beta) and draws c exp(-r (t - beta + 1)). Let e and x
    be of Exp(1): c = e + x is of Gamma(2, 1), u1 = e / c uniform and independent
    of it. With another uniform u2, r = -ln(u1 u2) is of Gamma(2, 1) and beta =
    ln(u2) / ln(u1 u2) uniform and independent of r. The draw is then
    c u1 (u1 u2)^t = e (u1 u2)^t. For weight 1, t is 0 and the draw e, of which
    exp(-e) is the uniform number n itself: only heavier terms take logarithms.
    """
    h = F.xxhash64(F.col("seed").bitwiseXOR(F.lit((ROW + i + 1) * SPREAD)))
    e = -F.log(uniform(F.col(f"n{i}"), BITS))
    x = -F.log(uniform(F.shiftrightunsigned(h, 32), 32))
    u2 = uniform(h.bitwiseAND(F.lit((1 << 32) - 1)), 32)
    u = e / (e + x) * u2
    t = F.floor(F.log(weight / u2) / -F.log(u))
    number = F.least(F.floor(F.exp(-e * F.pow(u, t)) * F.lit(float(1 << BITS))),
                     F.lit((1 << BITS) - 1))
    return F.when(weight == 1, F.col(f"p{i}")).when(
        weight > 1, packed(number, code_of(F.col("term"), t)))


def fingerprint_of(counts: DataFrame, keys: list[str], variants: int) -> DataFrame:
    """One row per ``keys`` with fingerprint strings f0 .. of each variant: SAMPLES
    codes of four hex digits. ``counts`` has each term's weights w0 .."""
    samples = drawn(counts).groupBy(*keys, "row").agg(*[
        F.max(weighted_draw(F.col(f"w{v}"), i)).alias(f"s{v}_{i}")
        for v in range(variants) for i in range(ROW)])

    def lane(v, first):
        word = F.lit(0).cast("long")
        for i in range(LANES):
            code = F.col(f"s{v}_{first + i}").bitwiseAND(F.lit(65535))
            word = word.bitwiseOR(F.shiftleft(code, 16 * (LANES - 1 - i)))
        return word

    lanes = samples.select(*keys, "row", *[
        lane(v, i).alias(f"l{v}_{i}") for v in range(variants) for i in range(0, ROW, LANES)])
    out = lanes.groupBy(*keys).agg(*[
        F.max(F.when(F.col("row") == r, F.col(f"l{v}_{i}"))).alias(f"l{v}_{r * ROW + i}")
        for v in range(variants) for r in range(SAMPLES // ROW) for i in range(0, ROW, LANES)])
    return out.select(*keys, *[
        F.lower(F.concat(*[F.lpad(F.hex(f"l{v}_{i}"), 16, "0")
                           for i in range(0, SAMPLES, LANES)])).alias(f"f{v}")
        for v in range(variants)])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    def at(c, i):
        return F.substring(c, i * 4 + 1, F.lit(4))

    samples = F.sequence(F.lit(0), F.lit(SAMPLES - 1))
    return F.size(F.filter(samples, lambda i: at(a, i) == at(b, i))) / F.lit(SAMPLES)


def fingerprints(texts: DataFrame, keys: list[str], variants: list[str]) -> DataFrame:
    """``keys`` and the fingerprint f0, f1, .. of each text column in
    ``variants``. Rows must be partitioned by ``keys`` already for the counting
    to need no further shuffle; ``keys`` must be unique."""
    exploded = texts.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("variant"), F.col(c).alias("text"))
        for i, c in enumerate(variants)])).alias("v")).select(*keys, "v.variant", "v.text")
    rows = exploded.select(*keys, "variant", F.inline(terms(F.col("text"))).alias("a", "b"))
    counts = (rows.select(*keys, "variant", F.xxhash64("a", "b").alias("term"))
              .groupBy(*keys, "term").agg(*[
                  F.count(F.when(F.col("variant") == i, 1)).alias(f"w{i}")
                  for i in range(len(variants))]))
    return fingerprint_of(counts, keys, len(variants))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next document's, in falling order of doc_id;
    after the last comes the first. NULL text is empty; ids that repeat are
    ordered by a hash of their texts, rows that repeat both are one document
    (each row is returned); a NULL doc_id comes last. A single document is its
    own next. An empty table gives an empty table.
    """
    text, key = F.coalesce("text", F.lit("")), ["id", "h"]
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       text.alias("text")).withColumn("h", F.xxhash64("text"))
    rows = written(base.select(*key, F.length("text").alias("n_chars")), "fingerprint-keys")
    unique = rows.distinct()
    n, chars = unique.agg(F.count(F.lit(1)), F.sum("n_chars")).first()
    repeated = rows.count() != n
    if repeated:
        base = base.dropDuplicates(key)
    order = written(global_index(unique, [F.col("id").desc(), F.col("h")], "at"),
                    "fingerprint-order")
    following = order.select(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"),
                             F.col("id").alias("next_id"), F.col("h").alias("next_h"))
    links = written(order.join(following, "at"), "fingerprint-links")

    # Texts are dealt once, by key; each document then sends the start of its
    # text to the one it follows, and all the rest stays in place.
    parts = max(1, -(-(chars or 0) // PARTITION_CHARS))
    dealt = base.repartition(parts, *key)
    donors = links.select(F.col("next_id").alias("id"), F.col("next_h").alias("h"),
                          F.col("id").alias("to_id"), F.col("h").alias("to_h"),
                          F.floor(F.col("n_chars") / 3).alias("k")).repartition(parts, *key)
    pieces = dealt.join(donors, key).select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), "k",
        F.substring("text", F.lit(1), F.col("k")).alias("piece")).repartition(parts, *key)
    edited = dealt.join(pieces, key).select(
        *key, "text", F.length("text").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("k")), "piece")
        .alias("edited"))
    found = fingerprints(edited, key, ["text", "edited"])
    digests = edited.select(*key, "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    every = written(found.join(digests, key), "fingerprints")
    nexts = links.select(F.col("id").alias("own_id"), F.col("h").alias("own_h"),
                         F.col("next_id").alias("id"), F.col("next_h").alias("h")).join(
        every.select(*key, F.col("f0").alias("next_f")), key).select(
        F.col("own_id").alias("id"), F.col("own_h").alias("h"), "next_f")
    out = every.join(nexts, key)
    if repeated:
        out = out.join(rows.select(*key), key)
    return out.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"),
                      F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                      F.col("f0").alias("fingerprint"), F.col("f1").alias("edited_fingerprint"),
                      likeness(F.col("f0"), F.col("f1")).alias("near_edited"),
                      likeness(F.col("f0"), F.col("next_f")).alias("near_next"))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_next(table(spark, sf_dir, "documents"))
