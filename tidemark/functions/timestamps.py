"""Timestamp parsing (operator J8, trap T1).

Sink timestamps come as ``M/d/yyyy h:mm:ss a`` text; text that does not
match exactly (e.g. trailing junk) becomes NULL instead of failing the job.
Row timestamps come as ISO-8601 text with 0 to 7 fraction digits and an
optional ``Z``; they are cast, not pattern-parsed, so every precision is
read exactly (a fixed ``.SSS`` pattern would misread seven digits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import SINK_TIMESTAMP_COLUMNS, SINK_TIMESTAMP_FORMAT
from tidemark.functions.columns import find_column


def parse_sink_timestamp(text: Column, fmt: str = SINK_TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_iso_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def parse_sink_columns(df: DataFrame, names=SINK_TIMESTAMP_COLUMNS) -> DataFrame:
    """Parse the sink timestamp columns present in ``df`` (string -> timestamp)."""
    cols = {}
    for n in names:
        c = find_column(df, n)
        if c is not None and df.schema[c].dataType.simpleString() == "string":
            cols[c] = parse_sink_timestamp(F.col(c))
    return df.withColumns(cols) if cols else df
