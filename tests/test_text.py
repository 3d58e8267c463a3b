from pyspark.sql import functions as F

from quire.functions import text as tx


def _one(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn("v")).collect()]


def test_strip_matches_python(spark):
    # Tab, CR LF, U+00A0, U+2003, U+001C, U+001F are removed; U+200B kept.
    vals = ["\t x \r\n", " y ", "\u001cz\u001f", "​w​", " a b ", "", None, "　\u0085q"]
    got = _one(spark, vals, tx.py_strip)
    assert got == [None if v is None else v.strip() for v in vals]


def test_combine_question_prompt(spark):
    # NULL, '', '  ' prompts add nothing; ' p ' adds a stripped line.
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" p ",)], "p string")
    df = df.withColumn("q", F.lit(" q\r\n"))
    got = [r[0] for r in df.select(tx.combine_question("q", "p")).collect()]
    assert got == ["q", "q", "q", "q\np"]


def test_format_prompt_always_two_lines(spark):
    df = spark.createDataFrame([(" q ", None)], "q string, p string")
    assert df.select(tx.format_prompt("q", "p")).first()[0] == "q\n"


def test_context_chunks(spark):
    # Split on '.', decimals split too; empty and dots give []; NULL stays NULL.
    got = _one(spark, ["A b. C 3.5 m. ", "", "...", None], tx.context_chunks)
    assert got == [["A b", "C 3", "5 m"], [], [], None]


def test_context_chunks_from_list(spark):
    df = spark.createDataFrame([([" a ", ""],)], "v array<string>")
    assert df.select(tx.context_chunks("v", is_array=True)).first()[0] == ["a"]


def test_bullet_list(spark):
    df = spark.createDataFrame([(["a", "b"],)], "v array<string>")
    assert df.select(tx.bullet_list("v")).first()[0] == "- a\n- b"


def test_clean_rewrite(spark):
    # The prefix (any case) is cut and quotes trimmed; quotes alone are kept.
    got = _one(spark, ['REWRITTEN question: "x"', '"x"', "Rewritten Question:\n  y \n"],
               tx.clean_rewrite)
    assert got == ["x", '"x"', "y"]


def test_rewrite_or_fallback(spark):
    # Same text in other case → question; blank → question; different → rewrite.
    df = spark.createDataFrame([("What", "WHAT"), ("What", ""), ("What", "Why")], "q string, r string")
    got = [tuple(r) for r in df.select(tx.rewrite_or_fallback("r", "q"),
                                       tx.rewrite_status("r", "q")).collect()]
    assert got == [("What", "unchanged"), ("What", "empty"), ("Why", "changed")]


def test_preview_and_defaults(spark):
    df = spark.createDataFrame([("x" * 200, None, None)], "t string, qid string, vid string")
    r = df.select(tx.preview("t"), tx.with_default("qid", tx.UNKNOWN_QID),
                  tx.video_id_fallback("vid", F.lit("0008-0"))).first()
    assert r[0] == "x" * 150 + "..."
    assert r[1] == "UNKNOWN_QID"
    # The default separator '_' does not occur, so the whole id is returned.
    assert r[2] == "0008-0"


def test_clamp_candidates(spark):
    got = _one(spark, [None, 0, 5, 64], tx.clamp_candidates, "v int")
    assert got == [8, 1, 5, 32]


def test_minutes_seconds(spark):
    df = spark.createDataFrame([(125.7,)], "s double")
    m, s = tx.minutes_seconds("s")
    assert tuple(df.select(m, s).first()) == (2, 5)


def test_clean_rewrite_prefix_list(spark):
    # The prefix list is a parameter; by default "Revised Question:" survives.
    vals = ["Revised Question: x", "Rewritten question: y"]
    assert _one(spark, vals, tx.clean_rewrite) == ["Revised Question: x", "y"]
    both = lambda c: tx.clean_rewrite(c, prefixes=("rewritten question:", "revised question:"))
    assert _one(spark, vals, both) == ["x", "y"]
