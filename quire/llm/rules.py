"""Quality rules: a table of thresholds compiled into one projection.

Every rule bounds a measure of the text, or its share of another measure. The
measures (lengths, symbols, stop words, lines, repeated word windows) and the
rules are column expressions, so a document is judged in the row it is in: no
user function, no explode and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, table


class Rule(NamedTuple):
    """``low <= measure / per <= high``, bounds to three decimals; ``per`` None:
    the measure itself. A document whose ``per`` is 0 breaks no rule with a
    share."""
    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


#: Rules that every document must meet.
BASE = (
    Rule("words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)
#: Rules of running text, in any of the languages of STOP_WORDS.
RULES = (
    *BASE,
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("exclamations", "n_exclamations", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("line_length", "n_words", "n_lines", low=2),
)

#: The commonest function words of English, German, French and Spanish.
STOP_WORDS = tuple((
    "a an and are as at be by for from had has have he her his in is it its not of on or she that "
    "the their they this to was were which with you "
    "als am auch auf aus bei bin das dem den der des die ein eine einen er es für ich ihr im ist "
    "mit nicht noch nur oder sich sie sind so um und uns vom von war wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il je la le les leur lui mais ne nous "
    "ou où par pas plus pour que qui sa se ses son sont sur un une vous "
    "al como con del e el ella ellos entre era esta este fue ha hay las lo los más mi muy no o "
    "para pero por sin sobre su sus también una y ya").split())
WINDOW = 3


def words_of(text: Column) -> Column:
    """The words: stretches without space, tab, line feed, vertical tab, form
    feed and carriage return (what ``\\s`` is to the regular expressions here)."""
    return F.array_remove(F.split(text, r"\s+"), "")


def count_of(text: Column, characters: str) -> Column:
    """How often characters of a class (of single code points) occur."""
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def measured(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the measures of every row's ``text``:

    n_words; word_chars (code points in words); n_symbols (of ``#*$%&|<>``);
    n_exclamations; n_stop_words; n_lines (with a word) and n_dup_lines (of
    these, equal to an earlier one); n_repeat_words (words inside windows of
    three words that occur twice or more, the first time included).

    NULL and empty texts have zeros. Rows are measured one by one, so ties and
    repeated rows make no difference; an empty table gives an empty table.
    Windows are compared by 64-bit hashes. Other columns are left out, so names
    can clash with nothing; where a name in ``keep`` is also a measure's, the
    caller's column stays and the measure is left out.

    Each step refers to the last one's arrays more than once, so the optimizer
    keeps them as they are instead of computing them again for every element.
    """
    own, t, w, lines, grams, at = fresh(docs.columns, "own", "t", "w", "lines", "grams", "at")
    step = docs.select(F.struct(*[F.col(k) for k in keep]).alias(own),
                       F.coalesce(F.col(text), F.lit("")).alias(t))
    step = step.select(
        own, words_of(F.col(t)).alias(w),
        F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"\S")).alias(lines),
        count_of(F.col(t), r"[#*$%&|<>]").alias("n_symbols"),
        count_of(F.col(t), "!").alias("n_exclamations"))

    def gram(word, i):
        return F.xxhash64(word, *[F.get(F.col(w), i + j) for j in range(1, WINDOW)])

    n = F.size(w)
    step = step.select(
        own, "n_symbols", "n_exclamations", n.cast("long").alias("n_words"),
        F.length(F.array_join(F.col(w), "")).cast("long").alias("word_chars"),
        F.size(F.filter(F.col(w), lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long")
        .alias("n_stop_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform(w, gram), 1, F.greatest(n - (WINDOW - 1), F.lit(0))).alias(grams))
    # Only a text in which some window repeats has its windows sorted.
    placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn(at, F.when(F.size(F.array_distinct(grams)) < F.size(grams), placed))
    counts = ("n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines",
              "n_dup_lines")
    step = step.select(own, *counts, F.sort_array(F.transform(F.filter(
        at, lambda x, i: (x["h"] == F.get(F.col(at), i + 1)["h"])
        | (x["h"] == F.get(F.col(at), i - 1)["h"])), lambda x: x["i"])).alias(at))
    covered = F.aggregate(F.transform(at, lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col(at), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    # As the one row of a generator the measures stay where they are: a filter on
    # them is not pushed into the steps above, which would repeat their work.
    measures = F.struct(*[F.col(c).cast("long").alias(c) for c in counts],
                        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    names = [n for n in (*counts, "n_repeat_words") if n not in keep]
    out = step.select(own, F.inline(F.array(measures)))
    return out.select(F.col(f"{own}.*"), *names)


def broken(rule: Rule) -> Column:
    """Whether a measured row breaks the rule; compared in whole numbers."""
    per = F.lit(1) if rule.per is None else F.col(rule.per)
    value, bounds = F.col(rule.measure) * 1000, []
    if rule.low is not None:
        bounds.append(value < per * round(1000 * rule.low))
    if rule.high is not None:
        bounds.append(value > per * round(1000 * rule.high))
    out = reduce(Column.__or__, bounds, F.lit(False))
    return out if rule.per is None else (per > 0) & out


def judged(rows: DataFrame, rules: Sequence[Rule] = RULES, column: str = "broken") -> DataFrame:
    """Measured ``rows`` with the names of the rules each breaks."""
    names = F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]).cast("array<string>")
    return rows.withColumn(column, F.array_compact(names))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns as they are, whose ``text`` breaks
    no rule."""
    own, names = fresh([*docs.columns, *(r.measure for r in rules)], "row", "broken")
    rows = measured(docs.select(F.struct("*").alias(own), F.col(text).alias("text")), [own])
    return judged(rows, rules, names).where(F.size(names) == 0).select(F.col(f"{own}.*"))


def op13_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents measured, with the verdicts of the base rules and of all."""
    rows = judged(measured(table(spark, sf_dir, "documents")))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", base.alias("base_failed"),
                       (~base & (F.size("broken") == 0)).alias("kept"))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
m AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             length(t) - length(replace(t, '!', '')) AS n_exclamations,
             len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, list_slice(w, i, i + 2)) AS k
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (
        SELECT rid, unnest(range(i, i + 3)) AS p FROM g WHERE k > 1) GROUP BY rid),
a AS (SELECT m.*, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM m LEFT JOIN r ON r.rid = m.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > n_words OR 5 * n_exclamations > n_words
            OR 20 * n_stop_words < n_words OR 2 * n_dup_lines > n_lines
            OR n_words < 2 * n_lines) AS kept
FROM b
"""
