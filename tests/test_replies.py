from quire.functions import replies as rp
from quire.functions.prompts import render, slots


def _col(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


D1 = ["Error", "Error:RateLimit", "Error: No response from step 2", "Error during processing: x",
      "Error (run A): x", "Errors in the clip", "error", None]


def test_error_taxonomy(spark):
    got = _col(spark, D1, rp.error_kind("v"))
    assert got == ["error"] * 5 + [None, None, "missing"]


def test_error_exact(spark):
    got = _col(spark, D1, rp.error_kind("v", mode="exact"))
    assert got == ["error"] + [None] * 6 + ["missing"]


def test_is_error_never_null(spark):
    assert _col(spark, D1, rp.is_error("v")) == [True] * 5 + [False] * 3
    assert _col(spark, [None], rp.is_error("v", missing_is_error=True)) == [True]


def test_retry_class(spark):
    msgs = ["HTTP 429 Too Many Requests", "Rate limit hit", "503 Service Unavailable",
            "403 Permission denied", "Bad input (422)", "weird", None, "took 4001 ms"]
    got = _col(spark, msgs, rp.retry_class("v"))
    assert got == ["retryable", "retryable", "retryable", "fatal", "fatal", "other", None, "other"]
    from quire.operators.infer import classify_failure

    assert [classify_failure(m) for m in msgs[:6] + msgs[7:]] == [g for g in got if g]


P15 = [
    '{"context": "c", "is_contextual": true, "explanation": "e"}',
    '```json\n{"context": "c", "is_contextual": true}\n```',
    '```\n{"context": "c", "is_contextual": "true"}\n```',
    "[1,2]", "", "{broken",
    '{"context": "c", "is_contextual": 1}',
    '{"context": null}',
    '{"context":"c"} xx',
    "{'context':'c'}",
    '{"context":{"a":1}}',
]


def test_parse_reply(spark):
    got = _col(spark, P15, rp.parse_reply("v"))
    err = (rp.PARSE_ERROR_CONTEXT, False, rp.PARSE_ERROR_EXPLANATION, None)
    as_t = [tuple(r) for r in got]
    assert as_t[0] == ("c", True, "e", None)
    assert as_t[1] == ("c", True, rp.PARSE_ERROR_EXPLANATION, None)
    assert as_t[2] == ("c", False, rp.PARSE_ERROR_EXPLANATION, None)  # "true" is not a boolean
    assert as_t[3] == err and as_t[4] == err and as_t[5] == err
    assert as_t[6][1] is False  # 1 is not a boolean
    assert as_t[7][0] == rp.PARSE_ERROR_CONTEXT  # D9: null context → error text
    assert as_t[8][0] == "c"  # D10: trailing text accepted
    assert as_t[9] == err  # D10: single quotes rejected
    assert as_t[10][0] == '{"a":1}'  # nested object kept as JSON text


def test_parse_verdict(spark):
    vals = ['{"is_supported": true, "explanation": "ok"}', '{"is_supported": "true"}', "nope", None]
    got = [tuple(r) for r in _col(spark, vals, rp.parse_verdict("v"))]
    assert got[0] == (True, "ok")
    assert got[1] == (False, rp.VERDICT_NO_EXPLANATION)
    assert got[2] == (False, rp.VERDICT_ERROR_PREFIX + rp.VERDICT_PARSE_FAILURE + "nope")
    assert got[3][0] is False


def test_reply_status(spark):
    df = spark.createDataFrame([(" a ", None), ("  ", None), (None, "x" * 150)], "r string, e string")
    got = [r[0] for r in df.select(rp.reply_status("r", "e")).collect()]
    assert got == ["a", "Error: No response from best-answer selection (Step 2).",
                   "Error during processing: " + "x" * 100]


def test_option_label(spark):
    # P27-R
    lines = ["1. A: x", "(B) y", "E", "Any text", "2) C. z", "A man"]
    assert _col(spark, lines, rp.option_label("v")) == ["A", "B", "E", None, "C", None]


def test_answer_format(spark):
    # P28-R: B valid; "B." not valid, normalized B; a sentence: neither.
    df = spark.createDataFrame([("B", True), ("B.", True), ("The answer is B", True), ("A man", False)],
                               "a string, mc boolean")
    got = [tuple(r[0]) for r in df.select(rp.answer_format("a", "mc")).collect()]
    assert got == [(True, True, "B"), (True, False, "B"), (True, False, None), (False, None, None)]


def test_render_single_pass(spark):
    tpl = "Q: {question} / n={n}"
    assert slots(tpl) == ["question", "n"]
    df = spark.createDataFrame([("has {n} inside",)], "q string")
    assert df.select(render(tpl, question=df.q, n=8)).first()[0] == "Q: has {n} inside / n=8"
