"""Quality rules against a plain model over texts."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import by_id, corpus, frame
from quire.llm import rules as ru

TEXTS = ["a a a a", "a b c a b c", "x y z w x y z", "one\none\n\n \none \n", "#tag $5 100% a&b |c| <d> *e*", "!!! wow!",
         "the le der el", "é ü x\x1cy", " \t\n\x0b\x0c\r ", "tail\n", "\r\nsame\r\nsame\r\nsame",
         "the cat sat on the mat and the dog " * 8, "word " * 60, "\U0001f600 \U0001f600 \U0001f600 \U0001f600"]


def model(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    hit = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), t.count("!"),
            sum(w.lower() in ru.STOP_WORDS for w in words), len(lines), len(lines) - len(set(lines)), len(hit))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines",
            "n_dup_lines", "n_repeat_words"]


def table_of():
    return corpus() + [(3000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3000, "again")]


def test_measures_of_awkward_texts(spark):
    out = ru.measured(frame(spark, table_of(), extra=True))
    assert out.columns == ["doc_id", *MEASURES]
    assert by_id([tuple(r) for r in out.collect()]) == by_id([(i, *model(t)) for i, t in table_of()])


def test_names_that_clash(spark):
    df = frame(spark, table_of())
    for name in ("own", "t", "w", "lines", "grams", "at", "row", "broken", "N_Words", "text_"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    rows = ru.measured(df, ["doc_id", "own", "N_Words"]).collect()
    assert {(r["own"], r["N_Words"]) for r in rows} == {("own own", "own N_Words")}
    kept = ru.keep_good(df)
    assert kept.columns == df.columns
    assert {r["grams"] for r in kept.collect()} <= {"own grams"}


def test_rules_decide_and_keep_rows_whole(spark):
    good = " ".join(f"the {4 * a} of {5 * b}" for a, b in zip("abcdefghijklmnopqrst", "tsrqponmlkjihgfedcba", strict=True))
    df = frame(spark, [(1, good), (2, good + " #$%" * 20), (3, "short"), (4, None), (5, good), (5, good)])
    assert sorted(r["doc_id"] for r in ru.keep_good(df).collect()) == [1, 5, 5]
    rows = {r["doc_id"]: r["broken"] for r in ru.judged(ru.measured(df)).collect()}
    assert rows[1] == [] and "symbols" in rows[2] and rows[3] == ["words", "stop_words", "line_length"]
    assert rows[4] == ["words"]
    own = (ru.Rule("none", "n_words", high=10), ru.Rule("chars", "word_chars", "n_words", low=1.5))
    assert ru.judged(ru.measured(df), own).where("doc_id = 3").first()["broken"] == []


def test_empty_table(spark):
    assert ru.measured(frame(spark, [])).count() == 0 and ru.keep_good(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_sql_agrees_on_awkward_texts(spark, name):
    from quire.session import scratch_path

    folder = scratch_path(spark, "rules-docs")
    frame(spark, table_of()).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    want = con.sql(ru.OP13_SQL).fetchall()
    got = ru.op13_quality_rules(spark, folder)
    assert by_id([tuple(r) for r in got.collect()]) == by_id(want)


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = ru.op13_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
