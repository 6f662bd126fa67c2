"""Delimited text to typed columns and back, as column expressions.

A field that is missing or cannot be read becomes null; :func:`readable` and ``route``
send such rows to a branch of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator, time format, field positions of each record.
SEPARATOR = ","
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
BOOK_FIELDS = {"bid": 0, "title": 1, "writer": 2, "gender": 4}
EVENT_FIELDS = {"user_id": 0, "action": 1, "ts": 2}
WIDE_EVENT_FIELDS = {"user_id": 3, "action": 20, "ts": 5}


def field(line: str, position: int) -> Column:
    """One field of a delimited line; null when the line is too short."""
    return F.get(F.split(F.col(line), SEPARATOR), F.lit(position))


def parse_time(value: Column) -> Column:
    """A timestamp from text, with up to six digits after the second."""
    return F.try_to_timestamp(value, F.lit(TIME_FORMAT))


def parse_number(value: Column) -> Column:
    """A whole number from text."""
    return value.try_cast("bigint")


def parse_book(df: DataFrame, line: str = "value", count: bool = False) -> DataFrame:
    """Catalogue rows from lines, other columns kept; ``count`` adds ``n`` = 1 for sums."""
    out = df.withColumns({name: field(line, at) for name, at in BOOK_FIELDS.items()}).drop(line)
    return out.withColumn("n", F.lit(1).cast("bigint")) if count else out


def parse_event(df: DataFrame, line: str = "value", fields: dict[str, int] = EVENT_FIELDS) -> DataFrame:
    """Events from lines; ``fields`` says where user, action and time stand."""
    out = df.withColumns({name: field(line, at) for name, at in fields.items()}).drop(line)
    return out.withColumn("ts", parse_time(F.col("ts")))


def parse_wide_event(df: DataFrame, line: str = "value") -> DataFrame:
    """Events from log lines of at least 21 fields."""
    return parse_event(df, line, WIDE_EVENT_FIELDS)


def readable(*columns: str) -> Column:
    """True for rows in which all these columns could be read."""
    out = F.lit(True)
    for name in columns:
        out = out & F.col(name).isNotNull()
    return out


def lines_of(df: DataFrame, column: str) -> DataFrame:
    """One row per line of a text column, as ``value``."""
    return df.select(F.explode(F.split(column, "\n")).alias("value"))


def words_of(df: DataFrame, line: str = "value") -> DataFrame:
    """One row per word of each line.

    Words are what single spaces separate: inner and leading empty words count, trailing
    ones do not, an empty line is one empty word, a line of spaces has none.
    """
    trimmed = F.rtrim(F.col(line))
    words = (F.when(F.length(line) == 0, F.array(F.lit("")))
             .when(F.length(trimmed) > 0, F.split(trimmed, " ")))
    return df.select(F.explode(words).alias("word"))


def time_text(ts: Column) -> Column:
    """Text of a time with at least one digit after the second."""
    plain = ts.cast("string")
    return F.when(F.contains(plain, F.lit(".")), plain).otherwise(F.concat(plain, F.lit(".0")))


def format_row(*columns: Column) -> Column:
    """Fields joined by the separator."""
    return F.concat_ws(SEPARATOR, *columns)


def format_event() -> Column:
    """``user_id,action,ts`` of an event row."""
    return format_row(F.col("user_id"), F.col("action"), time_text(F.col("ts")))


def format_user_count() -> Column:
    """``user_id,n,window_start,window_end`` of a count row."""
    return format_row(F.col("user_id"), F.col("n"), time_text(F.col("window_start")), time_text(F.col("window_end")))


def format_tuple(*columns: str) -> Column:
    """All fields in parentheses."""
    return F.concat(F.lit("("), format_row(*columns), F.lit(")"))
