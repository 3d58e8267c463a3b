import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import cache as ca
from quire.operators import enrich as en
from quire.operators import evaluate as ev
from quire.operators import grouping as gr
from quire.operators import resume as rs
from quire.operators import vote as vo
from quire.operators.ordering import global_index, group_index

from support import rows


def test_unanswered_and_only_ids(spark):
    q = spark.createDataFrame([("a",), ("b",), ("c",)], "qid string")
    log = spark.createDataFrame([("a", "x"), ("a", "y")], "qid string, prediction string")
    assert sorted(rows(rs.unanswered(q, log))) == [("b",), ("c",)]
    # D3: None = no filter, empty = no rows.
    assert rs.only_ids(q, None).count() == 3
    assert rs.only_ids(q, []).count() == 0
    assert sorted(rows(rs.only_ids(q, ["b"]))) == [("b",)]
    assert sorted(rows(rs.only_ids(q, log))) == [("a",)]


def test_latest_last_wins_first_order(spark):
    # One id three times → the value of the latest seq, order = first seq.
    log = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 5, "z"), ("a", 3, "w")],
                                "qid string, seq long, prediction string")
    got = sorted(rows(rs.latest(log, values=["prediction"], count_col="n")))
    assert got == [("a", "z", 1, 3), ("b", "y", 2, 1)]


def _log(spark, data):
    return spark.createDataFrame(data, "qid string, prediction string, first_seq long")


def test_overlay_rules(spark):
    # error+good → retry; error+error → orig; good+good → orig;
    # good+error → orig; retry only → dropped (J7a) or added.
    orig = _log(spark, [("1", "Error", 1), ("2", "Error", 2), ("3", "A", 3), ("4", "B", 4)])
    retry = _log(spark, [("1", "C", 10), ("2", "Error: again", 11), ("3", "D", 12),
                         ("4", "Error", 13), ("5", "E", 14)])
    a = dict((r[0], (r[1], r[2])) for r in rows(rs.overlay(orig, retry)))
    assert a == {"1": ("C", "retry"), "2": ("Error", "original"), "3": ("A", "original"),
                 "4": ("B", "original")}
    c = dict((r[0], (r[1], r[2], r[3])) for r in rows(rs.overlay(orig, retry, add_new=True)))
    assert c["5"] == ("E", "retry_only", 14) and c["1"] == ("C", "retry", 1)


def test_complete_fills_missing(spark):
    # 3 asked, 2 returned → 3 rows, placeholder on the missing one.
    exp = spark.createDataFrame([("a",), ("b",), ("c",)], "qid string")
    res = spark.createDataFrame([("a", "x"), ("c", "y")], "qid string, prediction string")
    got = sorted(rows(rs.complete(exp, res, placeholder=F.lit("MISSING"))))
    assert got == [("a", "x", False), ("b", "MISSING", True), ("c", "y", False)]


def test_to_input_order(spark):
    # Unknown id dropped; question without prediction → NULL; duplicates kept.
    q = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2)], "qid string, pos long")
    p = spark.createDataFrame([("a", "x"), ("b", "y"), ("z", "w")], "qid string, prediction string")
    assert rows(rs.to_input_order(q, p)) == [("b", 0, "y"), ("a", 1, "x"), ("b", 2, "y")]
    q2 = spark.createDataFrame([("c", 0)], "qid string, pos long")
    assert rows(rs.to_input_order(q2, p)) == [("c", 0, None)]


def test_repeat_rows(spark):
    # 2 questions × 3 passes.
    q = spark.createDataFrame([("a",), ("b",)], "qid string")
    got = sorted(rows(gr.repeat_passes(q, 3)))
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 2)]


def _cands(spark, data):
    return spark.createDataFrame(data, "qid string, pos long, label string")


def test_vote_cases(spark):
    # A9-R: all none; one label + many none; tie; single candidate; none at all.
    c = _cands(spark, [("all", 0, "E"), ("all", 1, "E"),
                       ("one", 0, "E"), ("one", 1, "E"), ("one", 2, "B"), ("one", 3, "E"),
                       ("tie", 0, "C"), ("tie", 1, "A"), ("tie", 2, "A"), ("tie", 3, "C"),
                       ("single", 0, "D")])
    exp = spark.createDataFrame([("all",), ("one",), ("tie",), ("single",), ("zero",)], "qid string")
    got = {r["qid"]: r for r in vo.vote(c, expected=exp).collect()}
    assert got["all"]["winner"] is None and got["all"]["status"] == "all_none"
    assert got["one"]["winner"] == "B" and got["one"]["votes"] == 1
    assert got["tie"]["winner"] == "C" and got["tie"]["status"] == "tie"
    assert got["single"]["winner"] == "D" and got["single"]["all_same"]
    assert got["zero"]["winner"] is None and got["zero"]["status"] == "no_candidates"
    noa = {r["qid"]: r["winner"] for r in vo.vote(c, tie_policy="none_of_above").collect()}
    assert noa["tie"] == "E" and noa["one"] == "B"


def test_vote_never_none_when_other_label(spark):
    c = _cands(spark, [(f"q{i % 7}", i, "E" if i % 3 else "ABCD"[i % 4]) for i in range(200)])
    for r in vo.vote(c).collect():
        assert r["winner"] != "E"


def test_candidate_rows(spark):
    reply = "1. A: x\n(B) y\nE\n\nAny text\n2) C. z\nA man"
    df = spark.createDataFrame([("q", reply)], "qid string, reply string")
    got = rows(vo.candidate_rows(df).orderBy("pos"), "pos", "label")
    assert got == [(0, "A"), (1, "B"), (2, "E"), (4, None), (5, "C"), (6, None)]


def _skewed(spark, n=3000):
    # One group holds a third of the rows.
    data = [(0 if i % 3 == 0 else i % 97 + 1, (i * 7919) % 100003, i) for i in range(n)]
    return spark.createDataFrame(data, "g long, o long, id long")


def test_group_index_matches_window(spark):
    df = _skewed(spark)
    got = {r["id"]: r["idx"] for r in group_index(df, ["g"], ["o", "id"], col="idx",
                                                  partitions=7).collect()}
    w = Window.partitionBy("g").orderBy("o", "id")
    exp = {r["id"]: r["rn"] - 1 for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == exp


def test_global_index_matches_window(spark):
    df = _skewed(spark)
    got = {r["id"]: r["idx"] for r in global_index(df, ["o", "id"], col="idx", partitions=5).collect()}
    w = Window.orderBy("o", "id")
    exp = {r["id"]: r["rn"] - 1 for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == exp


def test_batches_ordered(spark):
    q = spark.createDataFrame([("u", 5, "a"), ("v", 1, "b"), ("w", 3, "c"), ("u", 2, "d")],
                              "g string, pos long, qid string")
    got = sorted(rows(gr.batches(q, "g", 2), "g", "group_order", "batch_idx"))
    assert got == [("u", 1, 0), ("v", 0, 0), ("w", 2, 1)]


def test_group_key_normalizes(spark):
    # A trailing space does not split a group unless normalising is off.
    df = spark.createDataFrame([("u",), ("u ",)], "url string")
    assert df.select(gr.group_key("url")).distinct().count() == 1
    assert df.select(gr.group_key("url", normalize=False)).distinct().count() == 2


def test_flatten_prediction_overrides_only_matched(spark):
    q = spark.createDataFrame([("a", "old", 1.0, "p"), ("b", "keep", float("nan"), "p")],
                              "qid string, context string, duration double, question_prompt string")
    p = spark.createDataFrame([("a", ("new", True))],
                              "qid string, prediction struct<context:string, is_contextual:boolean>")
    got = {r["qid"]: r for r in en.enrich(q, p, question=None).collect()}
    assert got["a"]["context"] == "new" and got["a"]["is_contextual"] is True
    assert got["b"]["context"] == "keep" and got["b"]["is_contextual"] is None
    assert got["b"]["duration"] is None  # NaN → NULL
    assert "question_prompt" not in got["a"].asDict()


def test_prepare_answer_input_strict(spark):
    q = spark.createDataFrame([("a", "qa"), ("b", "qb")], "qid string, question string")
    rw = spark.createDataFrame([("a", "ra")], "qid string, corrected_question string")
    ctx = spark.createDataFrame([("a", "ca")], "qid string, context string")
    with pytest.raises(ValueError, match="1 questions lack a context"):
        en.prepare_answer_input(q, rw, ctx)
    got = sorted(rows(en.prepare_answer_input(q, rw, ctx, strict=False)))
    assert got == [("a", "qa", "ra", "ca", False), ("b", "qb", "qb", None, True)]


def test_accuracy_and_compare(spark):
    pred = spark.createDataFrame([("a", "x", "g1"), ("b", "y", "g1"), ("c", "z", "g2")],
                                 "qid string, pred string, grp string")
    truth = spark.createDataFrame([("a", "x"), ("b", "n"), ("c", "z")], "qid string, truth string")
    assert rows(ev.accuracy(pred, truth)) == [(3, 2, round(2 / 3, 6))]
    by = {(r[0], r[1]): r[4] for r in rows(ev.accuracy(pred, truth, by=["grp"]))}
    assert by == {("grp", "g1"): 0.5, ("grp", "g2"): 1.0, ("total", None): round(2 / 3, 6)}
    a = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "Error")], "qid string, prediction string")
    b = spark.createDataFrame([("1", "A"), ("2", "C"), ("4", "D")], "qid string, prediction string")
    got = dict(rows(ev.compare_runs(a, b)))
    assert got == {"agree": 1, "changed": 1, "only_a": 1, "only_b": 1}


def test_cache_split_and_refresh(spark):
    req = spark.createDataFrame([("m", "u1", "q1"), ("m", "u1", "q1"), ("m", "u2", "q2")],
                                "mode string, url string, question string")
    cache = spark.createDataFrame([("m", "u1", "q1", "ans")],
                                  "mode string, url string, question string, answer string")
    key = ["mode", "url", "question"]
    hits, misses = ca.split_cached(req, cache, key)
    assert hits.count() == 2 and rows(misses) == [("m", "u2", "q2")]
    new = spark.createDataFrame([("m", "u2", "q2", "Error: boom"), ("m", "u3", "q3", "ok")],
                                "mode string, url string, question string, answer string")
    refreshed = sorted(rows(ca.refresh(cache, new, key)))
    assert refreshed == [("m", "u1", "q1", "ans"), ("m", "u3", "q3", "ok")]  # errors are not cached


def test_progress_and_overlay_counts(spark):
    q = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "qid string, g long")
    log = spark.createDataFrame([("a",), ("a",), ("c",)], "qid string")
    got = {r[0]: (r[1], r[2]) for r in rows(ev.progress(q, log, by="g"))}
    assert got == {1: (2, 1), 2: (1, 1), None: (3, 2)}
    o = spark.createDataFrame([("1", "Error"), ("2", "Error"), ("3", "A")], "qid string, prediction string")
    r = spark.createDataFrame([("1", "B"), ("2", "Error"), ("9", "C")], "qid string, prediction string")
    assert rows(ev.overlay_counts(o, r)) == [(3, 3, 2, 1, 1, 1)]


def test_spread_for_inference_splits_hot_group(spark):
    # A third of the rows in one group spreads over all tasks.
    data = [(f"q{i}", 0 if i % 3 == 0 else i % 50 + 1) for i in range(3000)]
    df = spark.createDataFrame(data, "qid string, g long")
    out = gr.spread_for_inference(df, "g", partitions=16)
    per_task = out.filter("g = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 8 and max(r["count"] for r in per_task) <= 200
    assert sum(r["count"] for r in per_task) == 1000
    assert out.count() == 3000 and set(out.columns) == {"qid", "g"}


def test_infer_bounds_rows_per_task(spark):
    from quire.operators.infer import task_count

    df = spark.range(20_000).selectExpr("CAST(id AS STRING) AS qid", "id % 3 AS g")
    n = task_count(df, 100)
    out = gr.spread_for_inference(df, "g", partitions=n)
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()
    assert n == 200 and sizes[0] <= 160


def test_only_ids_takes_lists_of_any_length(spark):
    df = spark.range(3000).selectExpr("CAST(id AS STRING) AS qid")
    assert rs.only_ids(df, [str(i) for i in range(500, 1501)], key="qid").count() == 1001


def test_overlay_of_many_rounds(spark):
    # A retry that worked is kept, whatever later rounds hold; seq starts anew in each.
    log = spark.createDataFrame(
        [(0, 5, "a", "Error"), (0, 6, "b", "Error"), (0, 7, "c", "ok"), (1, 0, "a", "Error: x"),
         (1, 9, "b", "B1"), (2, 0, "a", "A2"), (3, 0, "b", "B3"), (3, 1, "d", "new"),
         (4, 0, "c", "later")], "run_id int, seq long, qid string, prediction string")
    got = sorted(rows(rs.overlay_runs(log, original=None, won_col="won"), "qid", "prediction", "won"))
    assert got == [("a", "A2", 2), ("b", "B1", 1), ("c", "ok", 0), ("d", "new", 3)]


def test_open_candidates_vote_by_text(spark):
    lines = spark.createDataFrame([("q", "1. A man\n2.  a man \n3. A dog")], "qid string, reply string")
    v = vo.vote(vo.open_labels(vo.candidate_rows(lines)))
    assert rows(v, "winner", "votes", "n_candidates", "status") == [("a man", 2, 3, "ok")]


def test_validate_rows_gives_a_reason_for_each(spark):
    df = spark.createDataFrame([(None, "a."), ("q", None), ("q", " . "), ("q", "a. b")],
                               "question string, context string")
    assert [r[0] for r in rows(en.validate_rows(df), "skip_reason")] == [
        "missing_question", "null_context", "no_chunks", None]
    other = df.select("question", F.lit(5).alias("context"))
    assert {r[0] for r in rows(en.validate_rows(other), "skip_reason")} == {"missing_question",
                                                                            "wrong_type"}


def test_cache_keeps_requests_with_null_keys(spark):
    req = spark.createDataFrame([("1", "m", None, "q"), ("2", "m", "u", None), ("3", "m", "u", "q")],
                                "qid string, mode string, url string, question string")
    cache = spark.createDataFrame([("m", None, "q", "x"), ("m", None, "q", "x")],
                                  "mode string, url string, question string, answer string")
    hits, misses = ca.split_cached(req, cache, ["mode", "url", "question"])
    assert rows(hits, "qid", "answer") == [("1", "x")] and misses.count() == 2


def test_overlay_runs_matches_two_log_overlay(spark):
    log = spark.createDataFrame(
        [(0, 1, "1", "Error"), (0, 2, "2", "Error"), (0, 3, "3", "A"), (0, 4, "4", "B"),
         (0, 5, "1", "Error"), (1, 10, "1", "C"), (1, 11, "2", "Error: again"), (1, 12, "3", "D"),
         (1, 13, "4", "Error"), (1, 14, "5", "E"), (1, 15, "1", "F")],
        "run_id int, seq long, qid string, prediction string")
    for add_new in (False, True):
        o = rs.latest(log.filter("run_id = 0"), values=["prediction"])
        r = rs.latest(log.filter("run_id = 1"), values=["prediction"])
        two = sorted(rows(rs.overlay(o, r, add_new=add_new)))
        one = sorted(rows(rs.overlay_runs(log, add_new=add_new)))
        assert one == two
    assert dict((r[0], r[1]) for r in one)["1"] == "F"


def test_batches_unordered_by_hash(spark):
    q = spark.createDataFrame([(f"g{i % 10}", i, f"q{i}") for i in range(40)],
                              "g string, pos long, qid string")
    b = gr.batches(q, "g", 3, ordered=False, n_batches=4)
    got = rows(b, "g", "batch_idx")
    assert len(got) == 10 and all(0 <= r[1] < 4 for r in got)
    with pytest.raises(ValueError):
        gr.batches(q, "g", 3, ordered=False)


def test_index_in_group(spark):
    q = spark.createDataFrame([("u", 5, "a"), ("v", 1, "b"), ("u", 2, "d"), ("u", 9, "e")],
                              "g string, pos long, qid string")
    got = sorted(rows(gr.index_in_group(q, "g"), "qid", "idx_in_group"))
    assert got == [("a", 1), ("b", 0), ("d", 0), ("e", 2)]


def test_spread_for_inference_splits_null_group(spark):
    data = [(f"q{i}", None if i % 2 else i % 7) for i in range(2000)]
    df = spark.createDataFrame(data, "qid string, g long")
    out = gr.spread_for_inference(df, "g", partitions=16)
    per_task = out.filter("g IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 4 and sum(r["count"] for r in per_task) == 1000
