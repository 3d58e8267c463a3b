"""Near duplicates, repeated spans, decontamination against plain models."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import by_id, corpus, frame, words
from quire.llm import decontaminate as dc
from quire.llm import jaccard, substrings


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def classes(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in sets}
    links = [(a, b) for a, x in sets for b, y in sets if x and y and a < b
             and 100 * len(x & y) >= 75 * len(x | y)]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return by_id([(i, len(s), label[i]) for i, s in sets])


def test_near_duplicates_match_all_pairs(spark):
    rows = corpus()
    got = jaccard.near_duplicates(frame(spark, extra=True)).collect()
    assert by_id(map(tuple, got)) == classes(rows)


def test_near_duplicates_in_a_large_group_of_near_copies(spark):
    """A long list: near copies of each other, a chain of drifting texts, and
    strangers that share one passage."""
    base = words(160, 20)
    rows = []
    for i in range(40):
        t = list(base)
        t[(i * 7) % 160] = f"edit{i}"
        rows.append((i, " ".join(t)))
    drift = list(words(100, 21))
    for i in range(30):
        drift = drift[3:] + [f"d{i}a", f"d{i}b", f"d{i}c"]
        rows.append((100 + i, " ".join(drift)))
    passage = words(30, 22)
    rows += [(200 + i, " ".join(passage + words(12, 300 + i))) for i in range(30)]
    got = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert by_id(map(tuple, got)) == classes(rows)


def test_near_duplicates_of_nothing_and_of_empty_texts(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    got = jaccard.near_duplicates(frame(spark, [(2, None), (1, ""), (5, "  ")])).collect()
    assert by_id(map(tuple, got)) == [(1, 0, 1), (2, 0, 2), (5, 0, 5)]


def test_rows_without_id_keep_their_set_size(spark):
    got = jaccard.near_duplicates(frame(spark, [(None, "a b c d e f"), (4, "a b c d e f")]))
    assert by_id(map(tuple, got.collect())) == [(None, 2, 4), (4, 2, 4)]


def test_texts_that_share_an_id_are_compared_by_their_own_words(spark):
    base, other = words(60, 31), words(60, 32)
    rows = [(1, " ".join(base)), (1, " ".join(other)), (2, " ".join(base[:-1])), (3, " ".join(other[1:]))]
    got = by_id(map(tuple, jaccard.near_duplicates(frame(spark, rows)).collect()))
    assert got == [(1, 56, 1), (1, 56, 1), (2, 55, 1), (3, 55, 1)]
    rows = [(1, " ".join(base)), (1, "a b c"), (2, " ".join(base[:-1])), (3, " ".join(other))]
    got = by_id(map(tuple, jaccard.near_duplicates(frame(spark, rows)).collect()))
    assert got == [(1, 1, 1), (1, 56, 1), (2, 55, 1), (3, 56, 3)]


def test_keep_one_leaves_the_smallest_id_of_each_class(spark):
    rows = corpus()
    docs = frame(spark, extra=True)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    firsts = {c for i, _, c in classes(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(firsts)


def model_of_spans(rows, k):
    """Kept words per row: windows in order of (id, start); the first stays."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, ws in sorted(split, key=lambda r: r[0]):
        for p in range(len(ws) - k + 1):
            first.setdefault(tuple(ws[p:p + k]), (i, p))
    out = []
    for i, ws in split:
        gone = set()
        for p in range(len(ws) - k + 1):
            if first[tuple(ws[p:p + k])] < (i, p):
                gone.update(range(p, p + k))
        out.append((i, [w for p, w in enumerate(ws) if p not in gone], len(ws)))
    return out


def test_repeated_spans_match_the_window_rule(spark):
    rows = corpus()
    docs = frame(spark, extra=True)
    out = substrings.dedup_substrings(docs)
    assert out.columns == docs.columns
    texts = dict(rows)
    want = [(i, texts[i] if len(kept) == n else b" ".join(kept).decode())
            for i, kept, n in model_of_spans(rows, 20)]
    got = out.select("doc_id", "text", "n_chars").collect()
    assert by_id([(r[0], r[1]) for r in got]) == by_id(want)
    assert all(r[2] == (None if r[1] is None else len(r[1])) for r in got)


def test_a_passage_in_many_documents_stays_once(spark, monkeypatch):
    """Small chunks, so that the same windows come from many of them, and small
    batches, so that one minimizer's rows span several."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 600)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        passage = words(55, 40)
        rows = [(i, " ".join(words(5 + i % 7, 500 + i) + passage + words(9, 900 + i)))
                for i in range(60)]
        out = substrings.dedup_substrings(frame(spark, rows).repartition(7)).select("doc_id", "text")
        want = [(i, rows[i][1] if len(kept) == n else b" ".join(kept).decode())
                for i, kept, n in model_of_spans(rows, 20)]
        assert by_id(map(tuple, out.collect())) == by_id(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_are_told_apart_by_all_bits_of_their_hashes():
    h = np.array([1, 1 + (1 << 40), 1 + (1 << 63)], dtype=np.uint64)
    assert substrings.unpack_hashes(substrings.pack_hashes(h).ravel()).tolist() == h.tolist()


def test_windows_of_hot_minimizers_are_dealt_by_their_own_hash(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_WINDOWS", 10)
    monkeypatch.setattr(substrings, "HOT_SHARE", 1)
    phrase = words(6, 41)
    rows = [(i, " ".join(words(30, 1500 + i % 20) + phrase + words(30, 1600 + i % 20)))
            for i in range(30)]
    docs = frame(spark, rows)
    hot = substrings.hot_minimizers(docs.selectExpr("doc_id AS doc", "text"), 20, 6)
    assert len(hot)
    out = substrings.chunk_rows([0, 1], [rows[0][1].encode(), rows[1][1].encode()], 20, 6, hot)
    assert not np.isin(out.column("minimizer").to_numpy().view(np.uint64), hot).any()
    got = substrings.dedup_substrings(docs).select("doc_id", "text")
    want = [(i, rows[i][1] if len(kept) == n else b" ".join(kept).decode())
            for i, kept, n in model_of_spans(rows, 20)]
    assert by_id(map(tuple, got.collect())) == by_id(want)


def test_different_texts_that_share_an_id_lose_their_own_words_only(spark):
    """Rows without id and rows of one id: a passage repeated in one of them, and
    the same window at the same start in two."""
    passage = words(25, 42)
    head = words(30, 43)
    for shared in (None, 7):
        rows = [(-5 if shared else 1, " ".join(passage)),
                (shared, " ".join(words(10, 44) + passage + words(10, 45))),
                (shared, " ".join(words(60, 46))),
                (shared, " ".join(head + words(10, 47))), (shared, " ".join(head + words(10, 48))),
                (shared, " ".join(words(40, 49))), (shared, " ".join(words(40, 49)))]
        got = [r["text"] for r in substrings.dedup_substrings(frame(spark, rows, extra=True)).collect()]
        assert len(got) == len(rows) and " ".join(words(60, 46)) in got
        assert got.count(" ".join(words(40, 49))) == 2
        tails = sorted([" ".join(words(10, 47)), " ".join(words(10, 48))])
        whole = [" ".join(head) + " " + t for t in tails]
        assert sum(t in got for t in tails) == 1 and sum(t in got for t in whole) == 1
        kept = " ".join(passage)
        cut = " ".join(words(10, 44) + words(10, 45))
        if shared:
            assert kept in got and cut in got
        else:  # rows without id come first
            assert "" in got and rows[1][1] in got


def test_repeated_spans_of_an_empty_table(spark):
    assert substrings.dedup_substrings(frame(spark, [])).count() == 0


ITEM = words(16, 60) + ["ninth"]
BENCH = [(7, " ".join(ITEM)), (12, "short item, HERE"), (30, None), (31, "..."),
         (8, " ".join(words(13, 61)))]


def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def contaminated_rows():
    return [(1, " ".join(words(10, 70) + ITEM[2:16] + words(9, 71))),
            (2, " ".join(ITEM[:12] + words(5, 72))),
            (3, "A Short ITEM; here" + " filler" * 100), (4, "short item here"), (5, None), (6, ""),
            (7, " ".join(words(300, 73) + ITEM[:13])),
            (8, " ".join(ITEM[:14]).upper()), (8, " ".join(ITEM[:14]).upper())]


def model_of_hits(rows):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                 re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, t in rows:
        ws, hit, found = split(t), set(), set()
        for item, text in BENCH:
            iw = split(text)
            n = min(13, len(iw))
            for a in range(len(iw) - n + 1 if n else 0):
                for p in range(len(ws) - n + 1):
                    if ws[p:p + n] == iw[a:a + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        out.append((i, len(ws), len(hit), len(found), sorted(found),
                    bool(hit) and 20 * len(hit) >= len(ws)))
    return by_id(out)


@pytest.mark.parametrize("block_words", [1_000_000, 8])
def test_decontamination_marks_every_hit(spark, block_words):
    rows = contaminated_rows()
    got = dc.decontaminate(frame(spark, rows, extra=True), bench(spark), block_words=block_words)
    assert by_id(map(tuple, got.collect())) == model_of_hits(rows)


@pytest.mark.parametrize("block_words", [1_000_000, 8])
def test_decontamination_removes_documents_or_spans(spark, block_words):
    rows = contaminated_rows()
    docs = frame(spark, rows, extra=True)
    kept = dc.decontaminate(docs, bench(spark), "documents", block_words=block_words)
    assert kept.columns == docs.columns
    bad = {r[0] for r in model_of_hits(rows) if r[-1]}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in bad)
    cut = dc.decontaminate(docs, bench(spark), "spans", block_words=block_words)
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[3] == "A " + " filler" * 100 and texts[5] is None and texts[4] == ""
    assert texts[2] == rows[1][1]


def test_decontamination_without_benchmark_or_documents(spark):
    none = bench(spark).where(F.lit(False))
    assert dc.decontaminate(frame(spark), none).where("n_hit > 0").count() == 0
    assert dc.decontaminate(frame(spark, []), bench(spark)).count() == 0


def test_bitmaps_never_rule_out_a_link():
    import numpy as np

    r = np.random.default_rng(3)
    for n in (5, 130, 300, 900):
        base = r.integers(0, 1 << 63, n, dtype=np.uint64)
        sets = [base]
        for edits in (1, n // 12, n // 7, n // 5, n // 2):
            x = base.copy()
            x[:edits] = r.integers(0, 1 << 63, edits, dtype=np.uint64)
            sets.append(np.append(x, r.integers(0, 1 << 63, n // 9, dtype=np.uint64)) if edits % 2 else x)
        sets.sort(key=len)
        size = np.array([len(s) for s in sets])
        maps = [jaccard.parity_bitmap(s).tobytes() for s in sets]
        i, j = jaccard.feasible_across(size, np.arange(len(sets)), maps, first=False)
        kept = set(zip(i.tolist(), j.tolist(), strict=True))
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                inter = len(np.intersect1d(sets[a], sets[b]))
                if 100 * inter >= 75 * (size[a] + size[b] - inter):
                    assert (a, b) in kept
        assert len(kept) < len(sets) * (len(sets) - 1) // 2


def test_texts_travel_packed_to_their_paths(spark):
    words = [f"word{i * 7919 % 1000}" for i in range(600)]
    texts = {1: " ".join(words), 2: " ".join(words[100:400]), 3: "", 4: None, 5: "ä\x00 ß", 6: "x" * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = substrings.with_paths(docs, 20, 6).toArrow().combine_chunks()
    size = sum(map(len, filter(None, found["text"].to_pylist())))
    assert size < 0.6 * sum(len(t.encode()) for t in texts.values() if t)
    got = {}
    for batch in found.to_batches():
        for rows_, parts in substrings.unpacked_slices(batch, max_bytes=1000):
            assert rows_.num_rows == len(parts)
            got.update(zip(rows_["doc_id"].to_pylist(), parts, strict=True))
    assert got == {k: None if t is None else t.encode() for k, t in texts.items()}
    assert [r["doc_id"] for r in found.to_pylist() if r["_paths"]] == [2]


def test_settled_paths_of_a_chunk_share_keys():
    words = " ".join(f"w{i}" for i in range(40)).encode()
    out = substrings.chunk_rows(list(range(300)), [words] * 300, 20, 6, np.zeros(0, np.uint64))
    settled = [r for r in out.to_pylist() if r["settled"]]
    assert len(settled) >= 299
    assert len({r["minimizer"] for r in settled}) <= 1 + len(out) // substrings.SETTLED_BLOCK
