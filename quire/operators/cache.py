"""Answer cache as a table keyed by the request (mode, media, question, n).

Hits are a key join, misses an anti join followed by one ``dropDuplicates``
on the key, so equal requests are inferred once. Error answers are never
stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.replies import is_error


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]):
    """Null-safe equality of the key columns; ``right`` has them as ``_k0`` ..."""
    cond = None
    for i, k in enumerate(key):
        c = left[k].eqNullSafe(right[f"_k{i}"])
        cond = c if cond is None else cond & c
    return cond


def _renamed(df: DataFrame, key: Sequence[str], *cols: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], *cols)


def split_cached(requests: DataFrame, cache: DataFrame, key: Sequence[str],
                 value_col: str = "answer") -> tuple[DataFrame, DataFrame]:
    """``(hits, misses)``: requests with their cached answer, and the distinct
    request keys that still need an answer. A NULL in the key is a value like
    any other; keys stored more than once (by concurrent runs) have one answer."""
    key = list(key)
    one = cache.groupBy(*key).agg(F.min(value_col).alias(value_col))
    c = _renamed(one, key, value_col)
    names = [f"_k{i}" for i in range(len(key))]
    hits = requests.join(c, _same(requests, c, key), "inner").drop(*names)
    bare = _renamed(one, key)
    misses = requests.join(bare, _same(requests, bare, key), "left_anti").select(*key).distinct()
    return hits, misses


def cacheable(results: DataFrame, value_col: str = "answer") -> DataFrame:
    """Results fit to store: no error answers."""
    return results.filter(~is_error(value_col, missing_is_error=True))


def refresh(cache: DataFrame, results: DataFrame, key: Sequence[str],
            value_col: str = "answer") -> DataFrame:
    """Cache plus new non-error results; an existing key keeps its entry."""
    key = list(key)
    new = cacheable(results, value_col).select(*key, value_col).dropDuplicates(key)
    old = _renamed(cache, key)
    new = new.join(old, _same(new, old, key), "left_anti")
    return cache.select(*key, value_col).unionByName(new)


CACHE_SCHEMA = "mode STRING, url STRING, question STRING, n INT, answer STRING"
CACHE_KEY = ("mode", "url", "question", "n")


def answer_with_cache(requests: DataFrame, cache_path: str, answer_fn,
                      key=CACHE_KEY) -> DataFrame:
    """Answers for ``requests`` (key columns plus anything else).

    Cache hits are joined; the distinct missing keys are answered once by
    ``answer_fn`` (``keys -> keys + answer``). That model output is written
    once (a hidden batch folder next to the cache, so a lost executor never
    asks the model again), its non-error answers are appended to the cache,
    and every request gets its answer (errors too, but they are not cached).
    """
    import uuid

    from quire.sources.io import load_log

    key = list(key)
    spark = requests.sparkSession
    # The file listing is taken here: hits come from the cache as it was.
    cache = load_log(spark, cache_path, CACHE_SCHEMA)
    hits, misses = split_cached(requests, cache, key)
    batch_path = f"{cache_path.rstrip('/')}/_batch-{uuid.uuid4().hex[:12]}"
    answer_fn(misses).select(*key, "answer").write.parquet(batch_path)
    fresh = spark.read.schema(CACHE_SCHEMA).parquet(batch_path)
    refresh(cache.limit(0), fresh, key).write.mode("append").parquet(cache_path)
    got = _renamed(fresh, key, "answer")
    late = requests.join(got, _same(requests, got, key), "inner")
    return hits.unionByName(late.drop(*[f"_k{i}" for i in range(len(key))]))
