"""Property tests: the Spark column functions against plain-Python models of
the same rules, on generated inputs (one Spark job per generated batch)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.functions import replies as rp
from quire.functions import text as tx

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# Text with plenty of whitespace of every kind Python knows.
WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　​"
_chars = st.text(alphabet=list(WS) + list("aZé9.\"'ß:"), max_size=30)
texts = st.one_of(_chars, st.builds(lambda a, b: a + "Rewritten question:" + b, _chars, _chars),
                  st.builds(lambda b: "rewritten QUESTION: " + b, _chars))


def _col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), texts, st.text(max_size=30)), min_size=1, max_size=60))
def test_strip_equals_python(spark, values):
    assert _col(spark, values, tx.py_strip) == [None if v is None else v.strip() for v in values]


def _combine_model(q, p):
    q = (q or "").strip()
    if p is not None and p.strip():
        return q + "\n" + p.strip()
    return q


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), texts), st.one_of(st.none(), texts)),
                min_size=1, max_size=60))
def test_combine_question_equals_model(spark, pairs):
    df = spark.createDataFrame(pairs, "q string, p string")
    got = [r[0] for r in df.select(tx.combine_question("q", "p")).collect()]
    assert got == [_combine_model(q, p) for q, p in pairs]


CLEANED = [
    (None, None), ("", ""), ("  plain text \n", "plain text"), ('"quoted"', '"quoted"'),
    ("Rewritten question: why?", "why?"), ('REWRITTEN QUESTION:\n"why?"\n', "why?"),
    ("rewritten question:", ""), ("the rewritten question: why?", "the rewritten question: why?"),
    ('Rewritten question: "a" or "b"', 'a" or "b'), ("Rewritten question:\twhy?", "\twhy?"),
]


def test_clean_rewrite_by_table(spark):
    assert _col(spark, [r for r, _ in CLEANED], tx.clean_rewrite) == [want for _, want in CLEANED]


plain = st.text(alphabet="abc XYZ?.\u00e9", min_size=1, max_size=20).map(str.strip).filter(bool)


@SETTINGS
@given(st.lists(plain, min_size=1, max_size=40))
def test_a_rewrite_survives_its_dress(spark, values):
    """Prefix in any case, quotes, blank space and line ends around it go."""
    dressed = [f'  rewritten QUESTION: "{v}" \n' for v in values]
    assert _col(spark, dressed, tx.clean_rewrite) == values
    assert _col(spark, values, tx.clean_rewrite) == values


values_json = st.one_of(st.none(), st.booleans(), st.integers(-5, 5),
                        st.text(alphabet="abc xyz", max_size=5))
objects = st.fixed_dictionaries({}, optional={"context": values_json, "is_contextual": values_json,
                                              "explanation": values_json,
                                              "corrected_question": values_json})


FAILED = (rp.PARSE_ERROR_CONTEXT, False, rp.PARSE_ERROR_EXPLANATION, None)
PARSED = [
    (None, FAILED), ("", FAILED), (" \n", FAILED), ("no json", FAILED), ("[1, 2]", FAILED),
    ('"text"', FAILED), ("{'context': 'c'}", FAILED), ('{"context": "c"', FAILED),
    ('{"context": "c"} tail', ("c", False, rp.PARSE_ERROR_EXPLANATION, None)), ("{}", FAILED),
    ('{"context": "c", "explanation": "e"}', ("c", False, "e", None)),
    ('{"context": "c", "is_contextual": true, "explanation": "e", "corrected_question": "q"}',
     ("c", True, "e", "q")),
    ('{"context": "c", "is_contextual": "true"}', ("c", False, rp.PARSE_ERROR_EXPLANATION, None)),
    ('{"context": "c", "is_contextual": 1}', ("c", False, rp.PARSE_ERROR_EXPLANATION, None)),
    ('{"context": null, "explanation": "e"}', (rp.PARSE_ERROR_CONTEXT, False, "e", None)),
    ('{"context": {"a": 1}, "explanation": 5}', ('{"a":1}', False, "5", None)),
]


def _parsed(spark, values):
    return [tuple(r) for r in _col(spark, values, rp.parse_reply)]


def test_parse_reply_by_table(spark):
    assert _parsed(spark, [r for r, _ in PARSED]) == [want for _, want in PARSED]


@SETTINGS
@given(st.lists(objects, min_size=1, max_size=40))
def test_a_fence_does_not_change_a_reply(spark, values):
    bare = [json.dumps(v) for v in values]
    want = _parsed(spark, bare)
    for dress in ("```json\n{}\n```", "```\n{}```", "  {}\n"):
        assert _parsed(spark, [dress.format(b) for b in bare]) == want
    assert _parsed(spark, [f"[{b}]" for b in bare]) == [FAILED] * len(bare)
    assert _parsed(spark, [b[:-1] for b in bare]) == [FAILED] * len(bare)


@SETTINGS
@given(st.lists(objects, min_size=1, max_size=40))
def test_fields_of_a_reply(spark, values):
    """A text field comes back as it is; only a true boolean sets the flag."""
    for v, got in zip(values, _parsed(spark, [json.dumps(v) for v in values]), strict=True):
        assert got[1] is (v.get("is_contextual") is True)
        for at, name in ((0, "context"), (2, "explanation"), (3, "corrected_question")):
            if isinstance(v.get(name), str):
                assert got[at] == v[name]


def _vote_model(cands, none="E", tie_policy="first"):
    """qid -> (winner, votes, n_candidates, status) from (qid, pos, label) rows."""
    out = {}
    by_q = {}
    for q, pos, label in cands:
        if label is not None:
            by_q.setdefault(q, []).append((pos, label))
    for q, rows_ in by_q.items():
        counts, first = {}, {}
        for pos, label in rows_:
            counts[label] = counts.get(label, 0) + 1
            first[label] = min(first.get(label, pos), pos)
        real = {k: v for k, v in counts.items() if k != none}
        n = sum(counts.values())
        if not real:
            out[q] = (None, 0, n, "all_none")
            continue
        top = max(real.values())
        tied = [k for k, v in real.items() if v == top]
        best = min(tied, key=lambda k: first[k])
        status = "tie" if len(tied) > 1 else "ok"
        winner = none if (status == "tie" and tie_policy == "none_of_above") else best
        out[q] = (winner, top, n, status)
    return out


cand_rows = st.lists(st.tuples(st.sampled_from(["q1", "q2", "q3", "q4"]),
                               st.sampled_from(["A", "B", "C", "E", None])), min_size=1, max_size=80)


@SETTINGS
@given(cand_rows, st.sampled_from(["first", "none_of_above"]))
def test_vote_equals_model(spark, raw, policy):
    from quire.operators import vote as vo

    cands = [(q, i, label) for i, (q, label) in enumerate(raw)]
    df = spark.createDataFrame(cands, "qid string, pos long, label string")
    got = {r["qid"]: (r["winner"], r["votes"], r["n_candidates"], r["status"])
           for r in vo.vote(df, tie_policy=policy).collect()}
    assert got == _vote_model(cands, tie_policy=policy)


def _overlay_model(log, add_new):
    """J7 rules on a log of (run_id, seq, qid, value): last-wins per run, then
    the retry value replaces an original error only with a non-error."""
    import re

    err = re.compile(rp.ERROR_TAXONOMY_RE)
    last = {}
    for run, seq, q, v in sorted(log, key=lambda r: r[1]):
        last[(run, q)] = v
    out = {}
    qids = {q for _, _, q, _ in log}
    for q in qids:
        o, r = last.get((0, q), "<none>"), last.get((1, q), "<none>")
        if o == "<none>":
            if add_new and r != "<none>":
                out[q] = (r, "retry_only")
            continue
        is_e = lambda v: v is not None and bool(err.match(v))
        if r != "<none>" and is_e(o) and not is_e(r):
            out[q] = (r, "retry")
        else:
            out[q] = (o, "original")
    return out


log_rows = st.lists(st.tuples(st.sampled_from([0, 1]), st.sampled_from(["a", "b", "c", "d"]),
                              st.sampled_from(["Error", "Error: x", "ok", "Errors here", None])),
                    min_size=1, max_size=40)


@SETTINGS
@given(log_rows, st.booleans())
def test_overlay_runs_equals_model(spark, raw, add_new):
    from quire.operators import resume as rs

    log = [(run, i, q, v) for i, (run, q, v) in enumerate(raw)]
    df = spark.createDataFrame(log, "run_id int, seq long, qid string, prediction string")
    got = {r["qid"]: (r["prediction"], r["source"])
           for r in rs.overlay_runs(df, add_new=add_new).collect()}
    assert got == _overlay_model(log, add_new)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 50)), min_size=1,
                max_size=120))
def test_group_index_equals_window(spark, raw):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quire.operators.ordering import group_index

    data = [(g, o, i) for i, (g, o) in enumerate(raw)]
    df = spark.createDataFrame(data, "g long, o long, id long")
    got = {r["id"]: r["k"] for r in group_index(df, ["g"], ["o", "id"], col="k",
                                                partitions=3).collect()}
    w = Window.partitionBy("g").orderBy("o", "id")
    exp = {r["id"]: r["rn"] - 1 for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == exp
