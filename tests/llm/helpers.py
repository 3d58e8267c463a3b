"""Small tables with every awkward case, and plain models of the results."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    """(doc_id, text): copies, near copies, shared passages, NULLs, empty, one
    word, a very long text, equal texts and a repeated row."""
    base = words(120, 1)
    near = base[:60] + ["changed"] + base[61:]
    far = base[:60] + words(60, 2)
    passage = words(70, 3)
    texts = [" ".join(base), " ".join(near), " ".join(base), " ".join(far), None, "", "one",
             " ".join(words(50, 4) + passage + words(50, 5)),
             " ".join(passage + words(200, 6)), " ".join(words(6000, 7, 5000)),
             "  ".join(passage).upper(), "é ü\t ñ\n\x0bx", " ".join(words(30, 8) * 3),
             "a b c", "A b  c", "x!! THE end?? ..."]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, rows[1], (1000, texts[0])]


def frame(spark, rows=None, extra=False):
    """The corpus as ``documents``; ``extra`` adds columns whose names clash with
    those operators use."""
    rows = corpus() if rows is None else rows
    data = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("score", "key", "n", "shard", "component", "ids", "label", "items", "h", "at"):
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))
