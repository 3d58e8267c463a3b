"""Alignment of two tokenizers against both tokenizers run on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import by_id, corpus, frame
from quire.llm import align as al

TEXTS = ["", None, "x", " ", "  two  spaces ", "\n\nline\r\nother;\r", "tab\tafter\x0b\x0cfeeds ", "é ü ñ 日本語 テキスト",
         "wide　space here", "no\xa0break  ", "a ▁ b", "<|endoftext|> and <s> and <0x41>",
         "emoji 👩‍👩‍👧 🇫🇷 ‍ joined", "don't we'll I'd 's", "x" * 3000, "日本" * 400, "\x00 \x1c \x85 ctrl",
         "1234567 8,9.0 a.b_c-d", "﻿mark", "é combining", "mixed \n \t  runs\n", "ends with space "]


def brute(rows):
    """The contract's columns, by sets of ends over whole texts."""
    a_of, b_of = al.ByteLevel(al.tokenizer_path(al.TOKENIZER_A)), al.Pieces(al.tokenizer_path(al.TOKENIZER_B))
    out, links = [], []
    for doc, text in rows:
        a, b = [], []
        if text:
            a, b = a_of.encode([" " + text])[0], b_of.model.encode(text)
            whole = (" " + text).encode()
            if any(b"".join(t.bytes[i] for i in ids) != whole for t, ids in ((a_of, a), (b_of, b))):
                a, b = [], []
        ends = [np.cumsum([len(t.bytes[i]) for i in ids]).tolist() for t, ids in ((a_of, a), (b_of, b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, own, at = [], [], [0, 0]
        for c in cuts:
            to = [ends[0].index(c, at[0]) + 1, ends[1].index(c, at[1]) + 1]
            groups.append(",".join(map(str, a[at[0]:to[0]])) + "|" + ",".join(map(str, b[at[1]:to[1]])))
            own.append((a[to[0] - 1], b[to[1] - 1]))
            at = to
        links.append(own)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), len(own), digest))
    n = Counter(p for own in links for p in own)
    top = Counter()
    for (x, y), c in n.items():
        top[y] = max(top[y], c)
    return [(*r[:5], sum(n[p] == top[p[1]] for p in own), sum(n[p] for p in own), r[5])
            for r, own in zip(out, links, strict=True)]


def got(df):
    return by_id([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_awkward_texts(spark, broadcast):
    rows = corpus() + [(2000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (2000, "again")]
    out = al.align(frame(spark, rows, extra=True), broadcast_pairs=broadcast)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    assert got(out) == by_id(brute(rows))


def test_empty_table(spark):
    assert al.align(frame(spark, []), broadcast_pairs=0).count() == 0
    assert al.align(frame(spark, [])).count() == 0


def test_cuts_of_random_ends():
    r = random.Random(5)
    for _ in range(60):
        texts = []
        for _ in range(r.randrange(1, 6)):
            n = r.randrange(0, 60)
            inner = range(1, n)
            texts.append([sorted({*r.sample(inner, r.randrange(0, len(inner) + 1)), n}) if n else []
                          for _ in "ab"])
        ends, lens, base = [[], []], [[], []], 0
        for text in texts:
            for k in (0, 1):
                ends[k] += [base + e for e in text[k]]
                lens[k].append(len(text[k]))
            base += text[0][-1] if text[0] else 0
        a, b = (np.array(e, np.int64) for e in ends)
        cut_a, cut_b = al.shared_cuts(a, b, *(np.array(x, np.int64) for x in lens))
        assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(ends[0]) & set(ends[1]))


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(al.op12_alignment(spark, folder)) == by_id(brute(rows))


def test_a_pair_of_every_document_counts_once_a_task(spark):
    df = frame(spark, [(i, "the same words") for i in range(200)]).repartition(4)
    out = al.align(df, broadcast_pairs=0).agg(F.min("count_sum"), F.max("count_sum"), F.min("n_links")).first()
    assert out[0] == out[1] == 200 * out[2]
