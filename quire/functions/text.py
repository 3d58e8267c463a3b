"""Text columns: stripping, question/prompt combination, chunking, rewrites.

All functions map ``Column -> Column`` and stay inside whole-stage codegen
(built-in expressions only, no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions._cols import as_col

# The characters Python's str.strip() removes (str.isspace),
# written as one regex character class. Java's (?U)\s misses U+001C..U+001F,
# and SQL trim() only removes spaces, so the class is spelled out.
# U+200B (zero width space) is not whitespace and is kept.
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\x{0C}\r\x{1C}\x{1D}\x{1E}\x{1F} \x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same characters as a literal set, for trim(str, chars): a linear scan
# from both ends instead of a regex.
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                    + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")

# Defaults used when a question record lacks a field.
UNKNOWN_QID = "UNKNOWN_QID"
DEFAULT_VIDEO_ID = ""
DEFAULT_URL = ""

# Prefix removed from a rewrite reply, and the characters
# trimmed after it (space, double quote, newline).
REWRITE_PREFIXES = ("rewritten question:",)
_REWRITE_TRIM_RE = r'^[ "\n]+|[ "\n]+$'

# Preview length and marker.
PREVIEW_CHARS = 150
PREVIEW_MARK = "..."


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(as_col(c), F.lit(WHITESPACE_CHARS))


def nonblank(c) -> Column:
    """True when the value is not NULL and not only whitespace."""
    c = as_col(c)
    return c.isNotNull() & (py_strip(c) != F.lit(""))


def strip_or_null(c) -> Column:
    """Stripped text, NULL when nothing is left (a model reply that is empty)."""
    return F.nullif(py_strip(c), F.lit(""))


def combine_question(question, prompt) -> Column:
    """``strip(q) + '\\n' + strip(p)`` when the prompt is non-blank, else ``strip(q)``.

    A NULL question counts as empty text. A NULL / blank prompt never adds a
    line (a missing prompt is not the text 'nan').
    """
    q = F.coalesce(py_strip(as_col(question)), F.lit(""))
    p = as_col(prompt)
    return F.when(nonblank(p), F.concat(q, F.lit("\n"), py_strip(p))).otherwise(q)


def format_prompt(question, prompt) -> Column:
    """The always-two-line form: ``strip(q or '') + '\\n' + strip(p or '')``."""
    q = F.coalesce(py_strip(as_col(question)), F.lit(""))
    p = F.coalesce(py_strip(as_col(prompt)), F.lit(""))
    return F.concat(q, F.lit("\n"), p)


def question_fallback(question_with_prompt, question) -> Column:
    """The combined field when present and non-NULL, else the plain question."""
    return F.coalesce(as_col(question_with_prompt), as_col(question))


def with_default(c, default: str) -> Column:
    return F.coalesce(as_col(c), F.lit(default))


def video_id_fallback(video_id, qid, sep: str = "_") -> Column:
    """Video id, else the part of ``qid`` before the first ``sep``."""
    return F.coalesce(F.nullif(as_col(video_id), F.lit("")),
                      F.substring_index(as_col(qid), sep, 1))


def context_chunks(c, is_array: bool = False) -> Column:
    """Split context text on '.', strip each piece and drop the blank ones.

    An array column is stripped and filtered the same way. Decimals such as
    ``3.5`` are split too, as in the source behaviour.
    """
    c = as_col(c)
    parts = c if is_array else F.split(c, r"\.", -1)
    return F.filter(F.transform(parts, lambda x: py_strip(x)),
                    lambda x: x.isNotNull() & (x != F.lit("")))


def bullet_list(chunks) -> Column:
    """``'- ' + chunk`` per chunk, joined by newlines."""
    return F.array_join(F.transform(as_col(chunks), lambda x: F.concat(F.lit("- "), x)), "\n")


def clean_rewrite(reply, prefixes=REWRITE_PREFIXES) -> Column:
    """Strip a rewrite reply; cut a leading (any case) prefix, then trim ``' "\\n'``."""
    r = py_strip(as_col(reply))
    out = r
    for prefix in reversed(tuple(prefixes)):
        n = len(prefix)
        cut = F.regexp_replace(F.substring(r, n + 1, 1 << 30), _REWRITE_TRIM_RE, "")
        out = F.when(F.lower(F.substring(r, 1, n)) == F.lit(prefix.lower()), cut).otherwise(out)
    return out


def rewrite_status(rewrite, question) -> Column:
    """'empty', 'unchanged' (same text ignoring case) or 'changed'."""
    r, q = as_col(rewrite), as_col(question)
    return (F.when(r.isNull() | (r == F.lit("")), F.lit("empty"))
            .when(F.lower(r) == F.lower(q), F.lit("unchanged"))
            .otherwise(F.lit("changed")))


def rewrite_or_fallback(rewrite, question) -> Column:
    """The rewrite when it is non-empty and differs ignoring case, else the question."""
    return F.when(rewrite_status(rewrite, question) == F.lit("changed"),
                  as_col(rewrite)).otherwise(as_col(question))


def preview(c, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters followed by the preview mark."""
    return F.concat(F.substring(as_col(c), 1, n), F.lit(PREVIEW_MARK))


def minutes_seconds(seconds) -> tuple[Column, Column]:
    """Whole minutes and remaining whole seconds of a duration in seconds."""
    s = as_col(seconds)
    return F.floor(s / 60), F.floor(F.pmod(s, F.lit(60.0)))


# Candidate count bounds (default when unset, lower, upper).
CANDIDATES_UNSET = 8
CANDIDATES_MIN = 1
CANDIDATES_MAX = 32


def clamp_candidates(n) -> Column:
    return F.least(F.greatest(F.coalesce(as_col(n), F.lit(CANDIDATES_UNSET)),
                              F.lit(CANDIDATES_MIN)), F.lit(CANDIDATES_MAX))
