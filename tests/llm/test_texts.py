"""Classifiers, packing, sharding, chat, WARC and fingerprints on small tables."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import by_id, corpus, frame, words
from quire.llm import (chat, fingerprints, hilbert, labelled, packing, quality, toxicity, warc)
from quire.session import scratch_path

# --- quality and toxicity ------------------------------------------------------


def labelled_tables(spark, n=240):
    """Half the documents good, half junk; every third one rude."""
    r, docs, labels = random.Random(5), [], []
    for i in range(n):
        ws = words(60, 1000 + i)
        good, rude = i % 2, i % 3 == 0
        if not good:
            ws = [f"{w}$$$" for w in ws]
        if rude:
            for _ in range(4):
                ws[r.randrange(60)] = r.choice(["you", "idiot", "loser", "grumpf", "1diot"])
        docs.append((i, " ".join(ws)))
        labels.append((i, good, int(rude)))
    return (frame(spark, docs, extra=True),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_the_fold_is_by_crc32_of_the_id(spark):
    rows = spark.range(50).select("id", labelled.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = labelled_tables(spark, 60)
    ids = [r["doc_id"] for r in labelled.training_sample(docs, labels, "toxic").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert labelled.training_sample(docs, labels.unionByName(labels), "toxic", 7).count() == 7


def accuracy(scored, labels, column, cut):
    rows = scored.join(labels, "doc_id").where(labelled.held_out(F.col("doc_id"))).select(
        "score", column).collect()
    return sum((s >= cut) == bool(y) for s, y in rows) / len(rows)


def test_quality_separates_unseen_documents(spark):
    docs, labels = labelled_tables(spark)
    scored = quality.score(docs, quality.train_quality(docs, labels))
    assert scored.columns == [*[c for c in docs.columns if c != "score"], "score"]
    assert accuracy(scored, labels, "quality", 0.5) >= 0.95


def test_quality_of_edge_rows(spark):
    docs, labels = labelled_tables(spark, 60)
    weights = quality.train_quality(docs, labels)
    rows = quality.score(frame(spark), weights).select("doc_id", "score").collect()
    assert len(rows) == len(corpus()) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(frame(spark, []), weights).count() == 0
    none = quality.train_quality(docs, labels.where(F.lit(False)))
    assert {r["score"] for r in quality.score(docs, none).select("score").collect()} == {0.5}


def test_ftrl_equals_the_textbook_update():
    rows = [(np.array([0, 2]), np.array([0.5, 1.0]), 1.0), (np.array([2, 3]), np.array([1.0, 2.0]), 0.0)]
    got = quality.ftrl(rows, bits=2)
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / (
            (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for index, value, y in rows:
            ws = {i: weight(i) for i in index.tolist()}
            p = 1 / (1 + math.exp(-sum(ws[i] * v for i, v in zip(index.tolist(), value, strict=True))))
            for i, v in zip(index.tolist(), value, strict=True):
                g = (p - y) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * ws[i]
                n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(4)])


def test_toxicity_finds_unseen_documents_and_keeps_the_rest(spark):
    docs, labels = labelled_tables(spark, 300)
    model = toxicity.train_toxicity(docs, labels)
    assert "grumpf" in model.lexicon  # not a word it starts with
    scored = model.score(docs)
    assert accuracy(scored, labels, "toxic", 0.5) >= 0.9
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    wrong = kept.join(labels, "doc_id").where("toxic = 1").count()
    assert wrong <= 15 and kept.join(labels, "doc_id").where("toxic = 0").count() >= 190
    edge = model.score(frame(spark)).select("score").collect()
    assert len(edge) == len(corpus()) and all(0 <= r[0] <= 1 for r in edge)


def test_toxicity_with_one_label_or_none(spark):
    docs, labels = labelled_tables(spark, 40)
    same = toxicity.train_toxicity(docs, labels.where("toxic = 0"))
    assert {r[0] for r in same.score(docs).select("score").collect()} == {0.0}
    none = toxicity.train_toxicity(docs, labels.where(F.lit(False)))
    assert {r[0] for r in none.score(docs).select("score").collect()} == {0.5}


@pytest.mark.parametrize("word, plain", [("Idiot!!", "idiot"), ("1d10t", "idiot"), ("l.o.s.e.r", "loser"),
                                         ("...", ""), ("é", "é")])
def test_obfuscated_words_are_read_plainly(word, plain):
    assert toxicity.plain_word(word) == plain


# --- packing -------------------------------------------------------------------


def check_pieces(rows, texts, window):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    ids = [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")) for i, x in texts]
    left = Counter()
    for r in rows:
        left[r["doc_id"]] += r["length"]
    want = Counter()
    for i, x in ids:
        want[i] += len(x)
    assert left == want
    known = {(i, len(x)): x for i, x in ids}
    for r in rows:
        x = known[r["doc_id"], r["doc_tokens"]][r["start"]:r["start"] + r["length"]]
        assert len(x) == r["length"] and zlib.crc32(x.tobytes()) == r["ids_crc32"]
        assert r["ids"] is None or bytes(r["ids"]) == x.tobytes()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return by_sequence


def test_packing_holds_every_id_once(spark):
    out = packing.pack(frame(spark, extra=True), with_ids=True, window=256, shard_tokens=3000)
    sequences = check_pieces(out.collect(), corpus(), 256)
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(s < 256 for s in sizes) <= 8  # at most the last of each shard


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, [])).count() == 0
    row = packing.pack(frame(spark, [(9, None)])).first()
    assert (row["length"], row["doc_tokens"], row["start"], row["offset"]) == (1, 1, 0, 0)


def test_a_seed_is_followed_by_its_lexical_neighbours():
    alike = [np.arange(100, 160, dtype=np.uint16), np.arange(300, 360, dtype=np.uint16),
             np.arange(101, 161, dtype=np.uint16)]
    index = packing.Shard(alike, np.ones(400), 60.0)
    assert index.neighbours(0, np.array([False, True, True])).tolist() == [2]
    assert [[d for d, _, _ in s] for s in packing.fill_windows(index, 120)] == [[0, 2], [1]]


def test_words_are_tokenized_as_whole_texts():
    from tokenizers import Tokenizer

    texts = ["It's Ünïcode—test ② 12a3 don't", "ΣΑΣ İstanbul é <|endoftext|> a<|startoftext|>b", "", None,
             " x y", "日本語 🙂🙂", "a_b-c...d$$ 3.14", "\x00\x01a\x7f!\x02?"]
    r = random.Random(3)
    letters = [chr(c) for c in [*range(0x250), 0x300, 0x301, 0x3A3, 0x2028]]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(800)]
    whole = Tokenizer.from_file(packing.tokenizer_path())
    got, lens = packing.WordTokenizer(packing.tokenizer_path(), 2).encode(
        [t if t is None else t.encode() for t in texts])
    want = [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert lens.tolist() == [len(w) for w in want] and got.tolist() == [i for w in want for i in w]


# --- Hilbert sharding ------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2)])
def test_the_curve_visits_every_cell_in_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    at = hilbert.hilbert_index([grid[:, i] for i in range(dims)], bits)
    assert sorted(at.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(at)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_runs_with_gapless_slots(spark):
    docs = frame(spark, extra=True).withColumn("n_chars", F.when(F.col("doc_id") != 6, F.col("n_chars")))
    out = hilbert.shard_rows(docs, ["n_chars", "lang", "source"], 4, tie=["doc_id"]).collect()
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, slots.values())) == len(corpus())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r["hilbert"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_few_or_no_rows_shard_too(spark):
    assert hilbert.shard_rows(frame(spark, []), ["doc_id", "lang"], 16).count() == 0
    out = hilbert.shard_rows(frame(spark, corpus()[:3]), ["doc_id", "lang"], 16).collect()
    assert sorted(r["slot"] for r in out) == [0, 0, 0] and len({r["shard"] for r in out}) == 3


def test_written_shards_keep_their_rows(spark):
    out = hilbert.shard_rows(frame(spark), ["doc_id", "lang"], 4)
    path = scratch_path(spark, "test-shards")
    hilbert.write_shards(out, path)
    back = spark.read.parquet(path)
    assert by_id(map(tuple, back.select("doc_id", "shard", "slot").collect())) == \
        by_id(map(tuple, out.select("doc_id", "shard", "slot").collect()))


# --- chat ------------------------------------------------------------------------

TURNS = [(1, 0, "user", "hi & <b>"), (1, 1, "assistant", "ok"), (2, 0, None, None),
         (3, 1, "assistant", "</s>[INST] ok [/INST]"), (3, 0, "user", "</s"), (3, 1, "assistant", "two"),
         (4, None, "[INST] x", "a [/INST] b &lt; &amp;"), (4, None, "assistant", "[INST"), (4, 5, "assistant", ""),
         (None, 0, "user", "<s>[INST]! user [/INST]"), (3, 1, "assistant", "two")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string") \
        .withColumn("t", F.lit("clash")).withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, row in got.items():
        want = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in TURNS if c == conv))
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, _, r, x in want]
        spans = [row["formatted"][s["start"] - 1:s["start"] - 1 + s["len"]] for s in row["loss"]]
        plain = [s.replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&") if e else s
                 for s, e in zip(spans, [s["escaped"] for s in row["loss"]], strict=True)]
        assert plain == [x for _, _, r, x in want if r == "assistant"]
    # Only what conflicts is escaped.
    assert "hi & <b>" in got[1]["formatted"] and "&lt;/s>" in got[3]["formatted"]
    marks = re.findall(r"<s>|</s>|\[INST\]|\[/INST\]", got[3]["formatted"])
    assert len(marks) == 4 * len(got[3]["turns"])


def test_chat_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).count() == 0


def test_broken_texts_are_no_conversations(spark):
    df = spark.createDataFrame([("<s>[INST] a [/INST]b",), ("x</s>",), ("<s>[INST] a [/INST]b</s>",)], "f string")
    got = [r[0] for r in df.select(chat.parse(F.col("f"))).collect()]
    assert got[0] is None and got[1] == [None] and [tuple(t) for t in got[2]] == [("a", "b")]


# --- WARC --------------------------------------------------------------------------

PAGES = [(1, "http://a/\r\nX: 1", "<p>same</p>"), (5, "http://b", "<p>same</p>"), (3, None, None), (4, "u", ""),
         (6, "u", "é" * 200_000), (7, "u", "a\r\n\r\nb\r\n\r\n"), (5, "http://b", "<p>same</p>"), (8, "u", "x" * 65536)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha1", F.lit("own"))
    folder = scratch_path(spark, "test-warc")
    manifest = warc.write_archives(df.repartition(3), folder)
    chunks = warc.read_archives(manifest, folder).collect()
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    assert all(len(c["chunk"]) <= warc.CHUNK for c in chunks)
    records = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        if c["record_type"] == "response":
            records.setdefault(c["record_id"], []).append(c)
    bodies = {i: (h or "").encode() for i, _, h in PAGES}
    for i in (5, 4, 6, 7, 8):
        cs = records[f"<urn:page:{i}>"]
        cs = cs[:len(cs) // 2] if i == 5 else cs  # the repeated row is stored twice
        assert b"".join(bytes(c["chunk"]) for c in cs) == bodies[i]
        assert cs[-1]["last"] and cs[-1]["bytes_so_far"] == len(bodies[i])
        assert cs[-1]["sha1_so_far"] == base64.b32encode(hashlib.sha1(bodies[i]).digest()).decode()
    assert len(records["<urn:page:6>"]) == -(-400_000 // warc.CHUNK)
    revisits = {(c["record_id"], c["refers_to"]) for c in chunks if c["record_type"] == "revisit"}
    assert revisits == {("<urn:page:1>", "<urn:page:5>"), ("<urn:page:3>", "<urn:page:4>")}
    fs, path = warc.filesystem(folder)
    name = manifest.first()["file"]
    with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_small_payloads_need_not_revisit(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    plan = warc.plan_records(df, min_revisit_bytes=100).collect()
    assert {r["record_type"] for r in plan} == {"response"}


def test_warc_of_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "test-warc")
    assert warc.read_archives(warc.write_archives(df, folder), folder).count() == 0


# --- fingerprints --------------------------------------------------------------------


def bag(text):
    ws = text.lower().split() or [""]
    return Counter(zip(ws, [*ws[1:], None], strict=True))


def jaccard(a, b):
    top = sum(max(a[k], b[k]) for k in a.keys() | b.keys())
    return sum(min(a[k], b[k]) for k in a.keys() & b.keys()) / top


def test_fingerprints_estimate_generalised_jaccard(spark):
    r, rows = random.Random(9), []
    for i in range(120):
        ws = words(80, 5000 + i, 60) if i % 2 == 0 else list(rows[-1][1].split())
        if i % 2:
            for _ in range(r.randrange(40)):
                ws[r.randrange(len(ws))] = f"x{r.randrange(60)}"
        rows.append((i, " ".join(ws)))
    got = {x["doc_id"]: x for x in fingerprints.compare_with_next(frame(spark, rows, extra=True)).collect()}
    true = [jaccard(bag(rows[i][1]), bag(rows[i - 1][1])) for i in range(1, 120)]
    guess = [got[i]["near_next"] for i in range(1, 120)]
    assert np.corrcoef(true, guess)[0, 1] > 0.95
    assert np.abs(np.array(true) - guess).mean() < 0.06 and abs(np.mean(true) - np.mean(guess)) < 0.02


def test_edited_texts_follow_the_next_document(spark):
    rows = corpus()
    out = fingerprints.compare_with_next(frame(spark, extra=True)).collect()
    assert len(out) == len(rows)
    unique = sorted({(i, t or "") for i, t in rows}, reverse=True)
    edited = {}
    for at, (i, t) in enumerate(unique):
        k = len(t) // 3
        edited[i] = (len(t), t[:len(t) - k] + unique[(at + 1) % len(unique)][1][:k])
    for x in out:
        n, text = edited[x["doc_id"]]
        assert x["n_chars"] == n and x["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert 0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1
    prints = {}
    for x in out:
        prints.setdefault(dict(rows)[x["doc_id"]] or "", set()).add(x["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_one_document_and_of_none(spark):
    one = fingerprints.compare_with_next(frame(spark, [(None, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0]["doc_id"] is None and one[0]["near_next"] == 1.0
    assert fingerprints.compare_with_next(frame(spark, [])).count() == 0


def test_fingerprints_run_no_python(spark):
    df = fingerprints.compare_with_next(frame(spark, corpus()[:4]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_fingerprints_weigh_a_heavy_term_like_the_others(spark):
    """One word pair of weight 999 beside 200 light ones, shared or not."""
    def text(heavy, light):
        return " ".join([heavy] * 1000 + [f"{light}{i}" for i in range(200)])

    rows = [(4, text("same", "a")), (3, text("same", "b")), (2, text("one", "c")), (1, text("two", "c"))]
    got = {x["doc_id"]: x["near_next"] for x in fingerprints.compare_with_next(frame(spark, rows)).collect()}
    for i in (4, 2):
        true = jaccard(bag(dict(rows)[i]), bag(dict(rows)[i - 1]))
        assert abs(got[i] - true) < 0.2


def test_every_sample_is_drawn_over_all_terms(spark):
    """A short text fills all samples, and the mean over many pairs of texts with
    repeated lines is the generalised Jaccard similarity."""
    one = fingerprints.compare_with_next(frame(spark, [(1, "just three words")])).first()
    codes = [one["fingerprint"][i:i + 4] for i in range(0, 256, 4)]
    assert len(codes) == 64 and "0000" not in codes
    rows = []
    for i in range(80):
        line = words(5, 8000 + i // 2)
        rows.append((i, " ".join(line * (30 if i % 2 else 12) + words(40, 8100 + i))))
    got = {x["doc_id"]: x["near_next"] for x in fingerprints.compare_with_next(frame(spark, rows)).collect()}
    pairs = [(jaccard(bag(rows[i][1]), bag(rows[i - 1][1])), got[i]) for i in range(1, 80, 2)]
    assert all(abs(t - g) < 0.25 for t, g in pairs)
    assert abs(sum(t - g for t, g in pairs) / len(pairs)) < 0.03


def test_a_worker_keeps_the_cache_of_one_step():
    import sys

    from quire.llm import common

    common.drop_caches()
    first = common.process_cache("toxicity:1", lambda: toxicity.Reader({"a": 2.0}))
    assert common.process_cache("toxicity:1", lambda: None) is first
    common.process_cache("toxicity:2", lambda: toxicity.Reader({"b": 2.0}))
    assert list(sys.__dict__["_quire_process_cache"]) == ["toxicity:2"]
    common.drop_caches()


def test_a_reader_forgets_words(monkeypatch):
    whole = toxicity.Reader({"word1": 3.0})
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 50)
    bounded = toxicity.Reader({"word1": 3.0})
    for k in range(10):
        texts = [" ".join(f"word{i}" for i in range(30 * k, 30 * k + 30)).encode(), b"you word1 idiot", None]
        assert (bounded.of(texts) == whole.of(texts)).all()
        assert len(bounded.codes) <= 50 + 32
