"""Questions enriched with predictions (left / inner), and the answer-step input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import combine_question
from quire.session import scratch_path


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN → NULL in every floating-point column (strings are NULL already)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def flatten_prediction(df: DataFrame, pred_col: str = "prediction",
                       drop: Sequence[str] = ("question_prompt",),
                       matched_col: str | None = None) -> DataFrame:
    """Lay the fields of a prediction struct onto the row.

    Prediction fields override same-named columns, but only on rows that have
    a prediction (``matched_col`` true, or a non-NULL struct); other rows keep
    the left value. ``drop`` columns are removed.
    """
    st = df.schema[pred_col].dataType
    if not isinstance(st, T.StructType):
        raise TypeError(f"{pred_col} is not a struct")
    fields = [f.name for f in st.fields]
    matched = F.col(matched_col) if matched_col else F.col(pred_col).isNotNull()
    out = []
    for c in df.columns:
        if c in (pred_col, *drop) or c == matched_col:
            continue
        if c in fields:
            out.append(F.when(matched, F.col(pred_col)[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    existing = set(df.columns)
    out += [F.col(pred_col)[f].alias(f) for f in fields if f not in existing]
    return df.select(*out)


def enrich(questions: DataFrame, predictions: DataFrame, key: str = "qid",
           pred_col: str = "prediction", how: str = "left",
           question: str | None = "question", prompt: str | None = "question_prompt",
           combined_col: str = "question_with_prompt") -> DataFrame:
    """Questions joined to deduped predictions (``how='left'`` keeps every
    question, ``'inner'`` only the answered ones), with the combined question
    text, the prediction flattened on the row and NaN turned into NULL."""
    preds = predictions.select(key, pred_col).withColumn("_matched", F.lit(True))
    joined = questions.join(preds, on=key, how=how)
    if question and prompt and question in questions.columns and prompt in questions.columns:
        joined = joined.withColumn(combined_col, combine_question(question, prompt))
    joined = joined.withColumn("_matched", F.coalesce(F.col("_matched"), F.lit(False)))
    return nan_to_null(flatten_prediction(joined, pred_col, matched_col="_matched"))


def validate_rows(df: DataFrame, question: str = "question", context: str = "context",
                  reason_col: str = "skip_reason") -> DataFrame:
    """Add why a row cannot be rewritten (NULL: it can): ``missing_question``,
    ``null_context``, ``wrong_type`` (the context is neither text nor an array
    of texts) or ``no_chunks``. Filter on the column to split the table."""
    from quire.functions.text import context_chunks

    kind = df.schema[context].dataType
    is_list = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType)
    reason = (F.when(F.col(question).isNull(), F.lit("missing_question"))
              .when(F.col(context).isNull(), F.lit("null_context")))
    if not (is_list or isinstance(kind, T.StringType)):
        reason = reason.otherwise(F.lit("wrong_type"))
    else:
        reason = reason.when(F.size(context_chunks(context, is_array=is_list)) == 0,
                             F.lit("no_chunks"))
    return df.withColumn(reason_col, reason)


def prepare_answer_input(questions: DataFrame, rewrites: DataFrame | None, contexts: DataFrame,
                         key: str = "qid", strict: bool = True) -> DataFrame:
    """Input of the answer step: ``corrected_question`` falls back to the
    question (also when there are no rewrites or they lack the column),
    ``context`` is required.

    With ``strict=True`` a missing context raises: all ids without one are
    written to a table in the shared folder, which the message names with
    their number. Otherwise ``missing_context`` flags them.
    """
    ctx = contexts.select(key, F.col("context").alias("_ctx"))
    if rewrites is not None and "corrected_question" in rewrites.columns:
        rw = rewrites.select(key, F.col("corrected_question").alias("_cq"))
        joined = questions.join(rw, on=key, how="left")
    else:
        joined = questions.withColumn("_cq", F.lit(None).cast("string"))
    out = (joined.join(ctx, on=key, how="left")
           .withColumn("corrected_question", F.coalesce("_cq", "question"))
           .withColumn("context", F.col("_ctx"))
           .withColumn("missing_context", F.col("_ctx").isNull())
           .drop("_cq", "_ctx"))
    if strict:
        missing = out.filter("missing_context").select(key)
        if missing.limit(1).count():
            path = scratch_path(out.sparkSession, "missing-context")
            missing.write.parquet(path)
            n = out.sparkSession.read.parquet(path).count()
            raise ValueError(f"{n} questions lack a context; their ids are in {path}")
    return out
