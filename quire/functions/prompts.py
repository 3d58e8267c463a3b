"""Prompt rendering as a column expression.

A template with ``{slot}`` fields is split once on the driver into literal
pieces; the rendered prompt is one ``concat`` of literals and slot columns.
Like ``str.format`` it is single-pass: text inserted for one slot is never
re-scanned for another slot. The templates are our own wording; only the
slots and the rules they state follow the source.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

CANDIDATES_TEMPLATE = (
    "Watch the clip and answer the question below.\n"
    "Question:\n{question}\n\n"
    "Write {n} candidate answers, one per line, the likeliest first. Where the question "
    "lists options, begin each line with an option letter; E stands for none of them. "
    "Base every candidate on what happens in the clip. A line may be repeated if nothing "
    "else is as likely."
)

AGGREGATE_TEMPLATE = (
    "Question:\n{question}\n\n"
    "Candidate answers ({n} were requested):\n{candidates}\n\n"
    "Compare the candidates with the clip and give one final answer: an option letter "
    "where the question lists options (E only if the clip rules out all others), else a "
    "short sentence. Reply with the answer only, without reasons."
)

REWRITE_TEMPLATE = (
    "Context notes:\n{context}\n\n"
    "Original question:\n{question}\n\n"
    "Rewrite the question so it can be answered from the clip alone, keeping "
    "its meaning. Reply as: Rewritten question: <text>"
)

CONTEXT_TEMPLATE = (
    "Question about the clip:\n{question}\n\n"
    "Reply in JSON with the keys context (what in the clip the question needs), "
    "is_contextual (true or false), explanation and corrected_question."
)

ANSWER_TEMPLATE = (
    "Context notes:\n{context}\n\n"
    "Question:\n{question}\n\n"
    "Answer from the clip, using the notes where they help."
)

VALIDATION_TEMPLATE = (
    "Question about the clip:\n{question}\n\nContext found so far:\n{context}\n\n"
    "Check the context against the clip and correct it. Reply in JSON with the keys "
    "context, is_contextual (true or false), explanation and corrected_question."
)

FACT_CHECK_TEMPLATE = (
    "Question:\n{question}\n\nProposed answer:\n{answer}\n\n"
    "Is the answer supported by the question's premises? Reply in JSON with "
    "is_supported (true or false) and explanation."
)


def slots(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


def render(template: str, **values) -> Column:
    """Fill ``{slot}`` fields with columns or Python literals (single pass).

    ``{{`` / ``}}`` stand for literal braces, as in ``str.format``.
    """
    parts: list[Column] = []
    for literal, field, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if spec or conv:
            raise ValueError("format specs are not supported in templates")
        if field not in values:
            raise KeyError(f"no value for slot {field!r}")
        v = values[field]
        parts.append(F.coalesce(v.cast("string"), F.lit("")) if isinstance(v, Column)
                     else F.lit(str(v)))
    return F.concat(*parts) if parts else F.lit("")
