"""Scalar column functions: built-in Spark expressions, and one pandas UDF
(``click_score``) that shows the same processor for Python-only logic."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_substr(c, start: int) -> Column:
    """``UCASE(SUBSTRING(c, start))``: drop a prefix (1-based) and upper-case."""
    return F.upper(F.substring(_col(c), start, 2147483647))


def split_item(c, sep: str, index: int) -> Column:
    """Item ``index`` (0-based) of ``c`` split on the literal ``sep``; null
    when there are fewer items."""
    return F.get(F.split(_col(c), _regex_literal(sep)), index)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def slug(c) -> Column:
    """Name → identifier: lower case, ``/`` → ``_and_``, space and ``-`` →
    ``_``, apostrophes dropped."""
    x = F.lower(_col(c))
    x = F.replace(x, F.lit("/"), F.lit("_and_"))
    x = F.replace(x, F.lit(" "), F.lit("_"))
    x = F.replace(x, F.lit("-"), F.lit("_"))
    return F.replace(x, F.lit("'"), F.lit(""))


def status_text(c) -> Column:
    """``in_station`` → ``In Station``; null → ``---``."""
    return F.coalesce(F.initcap(F.replace(_col(c), F.lit("_"), F.lit(" "))), F.lit("---"))


def whole_number_text(c) -> Column:
    """A number shown truncated towards zero; null → ``---``."""
    return F.coalesce(_col(c).cast("long").cast("string"), F.lit("---"))


def train_id(line, number) -> Column:
    """Line initial upper-cased + ``L`` + number zero-padded to 3 digits; a
    longer number is kept whole."""
    n = _col(number).cast("string")
    padded = F.when(F.length(n) >= 3, n).otherwise(F.lpad(n, 3, "0"))
    return F.concat(F.upper(F.substring(_col(line), 1, 1)), F.lit("L"), padded)


def line_of(red, blue, green) -> Column:
    """Three line flags → one line name; the first set flag in the order red,
    blue, green wins; no flag → null."""
    return (F.when(_col(red), F.lit("red"))
            .when(_col(blue), F.lit("blue"))
            .when(_col(green), F.lit("green")))


# Line name → colour code; anything else gets the default.
LINE_COLOURS = {"blue": "#1E90FF", "red": "#DC143C", "green": "#32CD32"}
DEFAULT_COLOUR = "0xFFFFFF"


def line_colour(line) -> Column:
    expr = None
    for name, code in LINE_COLOURS.items():
        cond = _col(line) == F.lit(name)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(DEFAULT_COLOUR))


def json_get(c, path: str, cast: str | None = None) -> Column:
    """One field of a JSON text column by JSONPath."""
    v = F.get_json_object(_col(c), path)
    return v.cast(cast) if cast else v


def letter_count(c, letter: str) -> Column:
    """Occurrences of ``letter`` in ``c``."""
    return F.length(_col(c)) - F.length(F.replace(_col(c), F.lit(letter), F.lit("")))


def parse_bank_time(c) -> Column:
    """``Sep 29, 2020, 10:06:23 AM`` and ``Oct 7, 2020 12:33:34 AM`` → timestamp."""
    return F.coalesce(F.try_to_timestamp(_col(c), F.lit("MMM d, yyyy, h:mm:ss a")),
                      F.try_to_timestamp(_col(c), F.lit("MMM d, yyyy h:mm:ss a")))


def with_score(df):
    """Record processor: add a reproducible score in 0..100 to each click,
    as built-in (JVM, codegen'd) expressions; use with ``df.transform``."""
    return df.withColumn("score", F.pmod(F.col("event_id") * 7919 + F.col("user_id"), F.lit(101)))


@F.pandas_udf(LongType())
def click_score(event_id: pd.Series, user_id: pd.Series) -> pd.Series:
    """The same processor for logic that only Python can express: run
    vectorised over Arrow batches, never row by row."""
    return (event_id * 7919 + user_id) % 101
