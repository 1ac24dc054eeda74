"""Scalar column functions (F1-F11). All are Catalyst built-ins, so they stay inside
whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.schemas import WORD_COUNT_SEPARATOR


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """F1: half-even rounding to 2 decimal places (2.675 -> 2.68, 2.665 -> 2.66)."""
    return F.bround(_c(x), 2)


def add_rounded(*terms) -> Column:
    """F11/AG4: sum of already-rounded terms, rounded half-even again."""
    total = None
    for t in terms:
        total = _c(t) if total is None else total + _c(t)
    return money(total)


def kind_label(kind) -> Column:
    """part-kind label, lower case with '_' turned into '-'."""
    return F.regexp_replace(F.lower(_c(kind)), "_", "-")


def split_words(text) -> Column:
    """split on single spaces; trailing empty strings dropped, leading and inner
    ones kept. '' gives [''], an all-space text gives []. Newlines and tabs are not
    separators."""
    t = _c(text)
    trimmed = F.rtrim(t)  # rtrim removes spaces only
    return (F.when(t == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def word_count_text(word, n) -> Column:
    """PRJ3/F4: ``word:::n``."""
    return F.concat(_c(word), F.lit(WORD_COUNT_SEPARATOR), _c(n).cast("string"))


def json_number(js, field: str) -> Column:
    """a number field of a JSON text as double (null when absent)."""
    return F.get_json_object(_c(js), f"$.{field}").cast("double")


def emptiness(arr) -> Column:
    """true when the array is null or has no element."""
    a = _c(arr)
    return a.isNull() | (F.size(a) == 0)


def key_bytes(k) -> Column:
    """message key as bytes."""
    return _c(k).cast("string").cast("binary")
