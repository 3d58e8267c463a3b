"""The corpus pipeline, each stage held against plain models of its rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import by_id, frame, words
from quire.llm import registry
from quire.session import scratch_path
from test_pairs import classes, model_of_spans
from test_texts import check_pieces

PASSAGE = words(60, 9001)
ITEM = words(20, 9002)


def corpus_tables(spark):
    r, docs, labels = random.Random(2), [], []
    for i in range(160):
        ws = words(70, 7000 + i)
        rude = i % 5 == 0
        if rude:
            for _ in range(6):
                ws[r.randrange(70)] = r.choice(["idiot", "moron", "scum"])
        if i % 7 == 1:
            ws = ws[:20] + PASSAGE + ws[20:]
        if i % 11 == 2:
            ws = ws[:30] + ITEM + ws[30:]
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, int(rude)))
    docs += [(200, docs[3][1]), (201, docs[3][1].replace(" ", "  ") + " tail"), (202, None), (203, ""),
             (204, docs[4][1] + " one more word")]
    folder = scratch_path(spark, "test-corpus")
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, docs


def test_every_stage_acts_on_what_the_last_one_kept(spark):
    folder, rows = corpus_tables(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_spans", "decontamination", "packing"]
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}.parquet"
        out.write.parquet(path)
        results[name] = docs = spark.read.parquet(path)
    texts = {n: [(r["doc_id"], r["text"]) for r in results[n].collect()]
             for n in list(results)[:-1]}
    assert all(results[n].columns == columns for n in texts)
    rude = {i for i, t in rows if t and re.search("idiot|moron|scum", t)}
    assert {i for i, _ in rows} - {i for i, _ in texts["toxicity"]} == rude
    firsts = {c for _, _, c in classes(texts["toxicity"])}
    assert sorted(i for i, _ in texts["near_duplicates"]) == sorted(firsts)
    before = dict(texts["near_duplicates"])
    want = [(i, before[i] if len(k) == n else b" ".join(k).decode())
            for i, k, n in model_of_spans(texts["near_duplicates"], 20)]
    assert by_id(texts["repeated_spans"]) == by_id(want)
    item = " ".join(ITEM)
    clean = [(i, t) for i, t in texts["repeated_spans"]
             if not any(" ".join(ITEM[a:a + 13]) in (t or "") for a in range(8))]
    assert item and by_id(texts["decontamination"]) == by_id(clean)
    pieces = results["packing"].withColumn("ids", F.lit(None).cast("binary")).collect()
    check_pieces(pieces, texts["decontamination"], 4096)
    again = corpus_pipeline.run(spark, folder)
    assert again.agg(F.sum("length")).first()[0] == results["packing"].agg(F.sum("length")).first()[0]


@pytest.mark.parametrize("n", range(1, 14))
def test_each_number_has_one_query(n):
    assert sum(q.startswith(f"op{n}_") for q in registry.QUERIES) == 1


def test_queries_match_their_sql(spark):
    """Every operator that SQL can express, over the smallest tables."""
    import duckdb

    from tools.compare import TABLES, digest

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in registry.SQL.items():
        df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        got, rel = [tuple(r) for r in df.collect()], con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns), name
        assert digest(df.columns, got)[0] == digest(rel.columns, rel.fetchall())[0], name
