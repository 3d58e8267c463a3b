"""Reply columns: error taxonomy, retry classes, JSON reply parsing, status texts,
option labels and answer-format checks.

Parsing relies on ``from_json`` (JVM-side, codegen) instead of a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions._cols import as_col
from quire.functions.text import WHITESPACE_CLASS, py_strip, strip_or_null

# Spellings that mark a stored answer as an error. The strict
# form only accepts the bare word; the taxonomy accepts every spelling the
# runtime writes ("Error", "Error:RateLimit", "Error: No response ...",
# "Error during processing: ...", "Error (run A): ..."). "Errors in ..." and
# lower-case "error" are answers, not errors.
ERROR_EXACT = "Error"
ERROR_TAXONOMY_RE = r"^Error(?:$|:| during (?:processing|fact check):| \([^)]*\):)"
ERROR_CONTEXT_PREFIX = "Error:"

# Message fragments that make a failure retryable, and the ones
# that make it final (checked first).
# A status code counts wherever no further digit touches it.
RETRYABLE_FRAGMENTS = ("rate limit", "server error", "connection error",
                       "unavailable", "timeout", "timed out")
RETRYABLE_CODES = ("429", "5[0-9][0-9]")
FATAL_FRAGMENTS = ("authentication", "permission", "not found", "invalid request")
FATAL_CODES = ("400", "401", "403", "404", "422")

# The error record a reply parser falls back to.
PARSE_ERROR_CONTEXT = "Error: Failed to parse response"
PARSE_ERROR_EXPLANATION = "Could not decode or extract valid fields from the model output."

# The error records of a context step that failed before its
# reply could be parsed, by what failed: (context, text before the message).
CALL_FAILED = ("Error: Processing failed after retries", "Failed after {retries} retries. Last error: ")
TASK_FAILED = ("Error: Task failed during concurrent execution",
               "Result was missing after asyncio.gather, likely due to an unhandled exception.")
BATCH_FAILED = ("Error: Batch processing failed", "Error during batch processing: ")
ROW_FAILED = ("Error", "Error during processing: ")

# Fact-check reply defaults.
VERDICT_NO_EXPLANATION = "No explanation provided."
VERDICT_ERROR_PREFIX = "Error during fact check: "
VERDICT_PARSE_FAILURE = "Failed to parse JSON from model. Raw reply:\n"

# Status texts for a step that produced nothing or failed.
NO_CANDIDATES_THOUGHTS = ("Step 1 (Thought Process): No detailed candidate answers were generated "
                          "or output was empty.")
NO_RESPONSE_BEST = "Error: No response from best-answer selection (Step 2)."
NO_RESPONSE_SINGLE = "Error: No response from single-shot QA."
PROCESSING_ERROR_PREFIX = "Error during processing: "
ERROR_MESSAGE_CHARS = 100

CONTEXT_SCHEMA = T.StructType([
    T.StructField("context", T.StringType()),
    T.StructField("is_contextual", T.BooleanType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("corrected_question", T.StringType()),
])
VERDICT_SCHEMA = T.StructType([
    T.StructField("is_supported", T.BooleanType()),
    T.StructField("explanation", T.StringType()),
])

_CORRUPT = "_corrupt_reply"
_JSON_OPTS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE",
              "columnNameOfCorruptRecord": _CORRUPT}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    """Same field names, all typed STRING (any JSON value reads as its text),
    plus the corrupt-record field: it is set only for a syntax error, never
    for a value of the wrong type."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(_CORRUPT, T.StringType())])


def _json_flag(s: Column, name: str) -> Column:
    """A field that is true only for a real JSON boolean (not "true", not 1)."""
    schema = T.StructType([T.StructField(name, T.BooleanType())])
    return F.from_json(s, schema, {"allowSingleQuotes": "false"})[name]


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$|?*+()[]{}\/" else ch for ch in s)


def error_kind(c, mode: str = "taxonomy") -> Column:
    """'missing' for NULL, 'error' for an error spelling, else NULL.

    ``mode='exact'`` accepts only the bare word; ``mode='prefix'`` accepts any
    text starting with ``Error:``; ``mode='taxonomy'`` (default) accepts all
    spellings the runtime writes.
    """
    c = as_col(c)
    if mode == "exact":
        hit = c == F.lit(ERROR_EXACT)
    elif mode == "prefix":
        hit = c.startswith(ERROR_CONTEXT_PREFIX)
    elif mode == "taxonomy":
        hit = c.rlike(ERROR_TAXONOMY_RE)
    else:
        raise ValueError(f"unknown error mode {mode!r}")
    return F.when(c.isNull(), F.lit("missing")).when(hit, F.lit("error"))


def is_error(c, mode: str = "taxonomy", missing_is_error: bool = False) -> Column:
    """Boolean, never NULL: the value is an error (optionally also when NULL)."""
    kind = error_kind(c, mode)
    hit = kind == F.lit("error")
    if missing_is_error:
        hit = hit | (kind == F.lit("missing"))
    return F.coalesce(hit, F.lit(False))


def _failure_re(fragments, codes) -> str:
    # "took 4001 ms" is not a 400, "http_429" is a 429; phrases match anywhere.
    # Same pattern in Java (rlike) and Python (re).
    return "|".join([_regex_quote(x) for x in fragments]
                    + [rf"(?:^|[^0-9]){x}(?:[^0-9]|$)" for x in codes])


FATAL_RE = _failure_re(FATAL_FRAGMENTS, FATAL_CODES)
RETRYABLE_RE = _failure_re(RETRYABLE_FRAGMENTS, RETRYABLE_CODES)


def retry_class(message) -> Column:
    """'fatal', 'retryable' or 'other' for a failure message; NULL when there is none."""
    m = F.lower(as_col(message))
    return (F.when(m.isNull(), F.lit(None).cast("string"))
            .when(m.rlike(FATAL_RE), F.lit("fatal"))
            .when(m.rlike(RETRYABLE_RE), F.lit("retryable"))
            .otherwise(F.lit("other")))


def strip_fences(reply) -> Column:
    """Strip; drop a leading ```json and/or ``` fence (and the whitespace after
    it), then one trailing ``` fence. Two anchored regex replaces: each input
    is scanned a fixed number of times (no nested re-evaluation)."""
    s = py_strip(as_col(reply))
    s = F.regexp_replace(s, f"^(?:```json{WHITESPACE_CLASS}*)?(?:```{WHITESPACE_CLASS}*)?", "")
    return F.regexp_replace(s, "```\\z", "")


def _is_json_object(parsed: Column) -> Column:
    # With the corrupt-record field, from_json marks everything that is not
    # a JSON object (arrays, scalars, null, broken or single-quoted text) as
    # corrupt, and gives NULL for empty text.
    return parsed.isNotNull() & parsed[_CORRUPT].isNull()


def _bool_field(s: Column, parsed: Column, name: str) -> Column:
    # The STRING-typed parse reads both true and "true" as 'true'; only then
    # is the field parsed again as BOOLEAN (lazy CASE branch) to tell them apart.
    return F.when(parsed[name] == F.lit("true"),
                  F.coalesce(_json_flag(s, name), F.lit(False))).otherwise(F.lit(False))


def _let(value: Column, build) -> Column:
    """``build(value)`` with ``value`` computed once, however often it is used: a
    lambda's variable is not inlined."""
    return F.get(F.transform(F.array(value), build), 0)


def parse_reply(reply) -> Column:
    """Parse a context reply into ``STRUCT<context, is_contextual, explanation,
    corrected_question>``.

    Empty text, invalid JSON or a non-object give the fixed error record.
    Missing or NULL ``context`` / ``explanation`` take the error texts;
    ``is_contextual`` is true only for a real JSON boolean true.
    """
    def fields(s: Column, parsed: Column) -> Column:
        good = F.struct(
            F.coalesce(parsed["context"], F.lit(PARSE_ERROR_CONTEXT)).alias("context"),
            _bool_field(s, parsed, "is_contextual").alias("is_contextual"),
            F.coalesce(parsed["explanation"], F.lit(PARSE_ERROR_EXPLANATION)).alias("explanation"),
            parsed["corrected_question"].alias("corrected_question"),
        )
        return F.when(F.coalesce(_is_json_object(parsed), F.lit(False)), good) \
            .otherwise(parse_error_struct())

    return _let(strip_fences(reply), lambda s: _let(
        F.from_json(s, _with_corrupt(CONTEXT_SCHEMA), _JSON_OPTS), lambda p: fields(s, p)))


def error_struct(context: str, explanation) -> Column:
    """A context record that stands for a failure."""
    return F.struct(
        F.lit(context).alias("context"),
        F.lit(False).alias("is_contextual"),
        as_col(explanation).alias("explanation"),
        F.lit(None).cast("string").alias("corrected_question"),
    )


def parse_error_struct() -> Column:
    return error_struct(PARSE_ERROR_CONTEXT, F.lit(PARSE_ERROR_EXPLANATION))


def call_error_struct(error, retries: int) -> Column:
    """The model call failed after its retries; the last message is kept."""
    context, text = CALL_FAILED
    return error_struct(context, F.concat(F.lit(text.format(retries=retries)), as_col(error)))


def task_error_struct() -> Column:
    """No result came back for a question that was asked."""
    return error_struct(TASK_FAILED[0], F.lit(TASK_FAILED[1]))


def batch_error_struct(error) -> Column:
    """The whole batch of a question failed."""
    return error_struct(BATCH_FAILED[0], F.concat(F.lit(BATCH_FAILED[1]), as_col(error)))


def row_error_struct(error) -> Column:
    """A question's own processing failed outside the model call."""
    return error_struct(ROW_FAILED[0], F.concat(F.lit(ROW_FAILED[1]), as_col(error)))


def context_failed(context) -> Column:
    """A context record of a failure: the bare word, or a text that starts with
    ``Error:``."""
    return is_error(context, "prefix") | is_error(context, "exact")


def context_prediction(reply, error, retries: int) -> Column:
    """The record of a context step: the failed call's, or the parsed reply."""
    return F.when(as_col(error).isNotNull(), call_error_struct(error, retries)).otherwise(
        parse_reply(reply))


def parse_verdict(reply, error=None) -> Column:
    """Parse a fact-check reply into ``STRUCT<is_supported, explanation>``; a
    failed call (``error``) gives ``(false, 'Error during fact check: <error>')``.

    The flag is true only for a real JSON boolean true; a missing explanation
    takes the default text; text that is not a JSON object gives
    ``(false, 'Error during fact check: ...')`` carrying the raw reply.
    """
    def fields(s: Column, parsed: Column) -> Column:
        good = F.struct(
            _bool_field(s, parsed, "is_supported").alias("is_supported"),
            F.coalesce(parsed["explanation"], F.lit(VERDICT_NO_EXPLANATION)).alias("explanation"),
        )
        bad = F.struct(
            F.lit(False).alias("is_supported"),
            F.concat(F.lit(VERDICT_ERROR_PREFIX + VERDICT_PARSE_FAILURE),
                     F.coalesce(s, F.lit(""))).alias("explanation"),
        )
        return F.when(F.coalesce(_is_json_object(parsed), F.lit(False)), good).otherwise(bad)

    out = _let(py_strip(as_col(reply)), lambda s: _let(
        F.from_json(s, _with_corrupt(VERDICT_SCHEMA), _JSON_OPTS), lambda p: fields(s, p)))
    if error is None:
        return out
    failed = F.struct(F.lit(False).alias("is_supported"),
                      F.concat(F.lit(VERDICT_ERROR_PREFIX), as_col(error)).alias("explanation"))
    return F.when(as_col(error).isNotNull(), failed).otherwise(out)


def reply_status(reply, error_message=None, no_response: str = NO_RESPONSE_BEST) -> Column:
    """Final answer text of one model step.

    An exception message wins: ``'Error during processing: '`` + its first 100
    characters. Otherwise a blank reply gives the fixed text ``no_response`` and
    a real reply is returned stripped.
    """
    text = strip_or_null(reply)
    out = F.when(text.isNull(), F.lit(no_response)).otherwise(text)
    if error_message is not None:
        err = as_col(error_message)
        out = F.when(err.isNotNull(),
                     F.concat(F.lit(PROCESSING_ERROR_PREFIX),
                              F.substring(err, 1, ERROR_MESSAGE_CHARS))).otherwise(out)
    return out


# Option letters of a multiple-choice question; E is
# "none of the above".
OPTION_LETTERS = "ABCDE"
NONE_OF_ABOVE = "E"
OPTION_LABEL_RE = r"^\s*(?:\d+[.)]\s*)?\(?([A-E])(?:[).:]|\s*$)"
SINGLE_OPTION_RE = r"^[A-E]$"


def option_label(line) -> Column:
    """Leading option letter of a candidate line, NULL when there is none.

    ``1. A: x`` → A, ``(B) y`` → B, ``E`` → E, ``2) C. z`` → C; a letter
    followed by a plain space (``A man``) is not a label.
    """
    return F.nullif(F.regexp_extract(as_col(line), OPTION_LABEL_RE, 1), F.lit(""))


def is_multiple_choice(question, question_type=None) -> Column:
    """A question is multiple choice if its type says so, or if it lists at
    least two options on lines of their own (``A. x``, ``(B) y``)."""
    lines = F.split(F.coalesce(as_col(question), F.lit("")), "\n", -1)
    listed = F.size(F.filter(lines, lambda x: option_label(x).isNotNull())) >= 2
    if question_type is None:
        return listed
    return F.coalesce(F.lower(as_col(question_type)).contains("multiple choice"), F.lit(False)) | listed


def answer_format(answer, is_multiple_choice) -> Column:
    """``STRUCT<checked, valid, normalized>`` for an answer.

    Multiple choice: valid only when the stripped answer is one option letter;
    ``normalized`` is the extracted label (or NULL). Open-ended answers are not
    checked.
    """
    a = py_strip(as_col(answer))
    mc = F.coalesce(as_col(is_multiple_choice), F.lit(False))
    return F.struct(
        mc.alias("checked"),
        F.when(mc, F.coalesce(a.rlike(SINGLE_OPTION_RE), F.lit(False))).alias("valid"),
        F.when(mc, option_label(a)).alias("normalized"),
    )
