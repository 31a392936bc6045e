"""Record-key repair from the row GUID (operators J1-J4).

An exported row carries a 36-character GUID ``sl_id``.  Its first eight hex
digits are the table id; its last eight bytes, byte-reversed, are the record
id.  Both are used only where the row's own ``tableid`` / ``recid`` is NULL.
Decoding is pure built-in expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import find_column

# 1-based start positions of the record-id bytes inside the
# GUID text, most significant byte first.
RECORD_ID_BYTE_POSITIONS = (35, 33, 31, 29, 27, 25, 22, 20)
TABLE_ID_DIGITS = 8


def _hex_to_bigint(hex_text: Column, digits: int) -> Column:
    """Unsigned hex text -> bigint; NULL for non-hex text or values above 2^63-1.

    The range is checked on the text (16 digits fit only when the first is
    0-7), so the cast that runs always succeeds: no per-row failure path."""
    valid = (F.length(hex_text) == digits) & F.unhex(hex_text).isNotNull()
    if digits >= 16:
        valid = valid & (F.substring(hex_text, 1, 1) <= F.lit("7"))
    return F.when(valid, F.conv(hex_text, 16, 10).cast("bigint"))


def table_id_from_guid(guid: Column) -> Column:
    """Table id = first eight hex digits of the GUID."""
    return _hex_to_bigint(F.substring(guid, 1, TABLE_ID_DIGITS), TABLE_ID_DIGITS)


def record_id_from_guid(guid: Column) -> Column:
    """Record id = last eight GUID bytes in reverse order, read as hex."""
    text = F.concat(*[F.substring(guid, p, 2) for p in RECORD_ID_BYTE_POSITIONS])
    return _hex_to_bigint(text, 2 * len(RECORD_ID_BYTE_POSITIONS))


def guid_from_ids(table_id: Column, record_id: Column) -> Column:
    """Inverse of the two decoders: build the GUID text for (table id, record id)."""
    t = F.lpad(F.lower(F.hex(table_id)), TABLE_ID_DIGITS, "0")
    h = F.lpad(F.lower(F.hex(record_id)), 16, "0")
    pair = lambda n: F.substring(h, n, 2)
    return F.concat(t, F.lit("-0000-0000-"), pair(15), pair(13), F.lit("-"),
                    pair(11), pair(9), pair(7), pair(5), pair(3), pair(1))


def repair_keys(df: DataFrame, guid: str = "sl_id", table_id: str = "tableid",
                record_id: str = "recid") -> DataFrame:
    """Fill NULL ``tableid`` / ``recid`` from the GUID, in one projection."""
    g = find_column(df, guid)
    if g is None:
        return df
    fills = {}
    t = find_column(df, table_id)
    if t is not None:
        fills[t] = F.coalesce(F.col(t), table_id_from_guid(F.col(g)).cast(df.schema[t].dataType))
    r = find_column(df, record_id)
    if r is not None:
        fills[r] = F.coalesce(F.col(r), record_id_from_guid(F.col(g)).cast(df.schema[r].dataType))
    return df.withColumns(fills) if fills else df
