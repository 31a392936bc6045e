import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.timestamps import parse_iso_timestamp, parse_sink_timestamp


def test_sink_timestamp(spark):
    rows = [("1/2/2024 1:30:00 PM",), ("12/31/2023 12:00:05 AM",), ("1/2/2024 1:30:00 PM junk",), ("bad",), (None,)]
    out = [r[0] for r in spark.createDataFrame(rows, "s STRING")
           .select(parse_sink_timestamp(F.col("s")).cast("timestamp_ntz")).collect()]
    assert out == [dt.datetime(2024, 1, 2, 13, 30), dt.datetime(2023, 12, 31, 0, 0, 5), None, None, None]


def test_iso_timestamps_every_precision(spark):
    rows = [("2024-01-05T10:11:12Z",), ("2024-01-05T10:11:12.123Z",), ("2024-01-05T10:11:12.1234567Z",),
            ("2024-01-05T10:11:12.1234567",), ("junk",)]
    out = [r[0] for r in spark.createDataFrame(rows, "s STRING")
           .select(parse_iso_timestamp(F.col("s")).cast("timestamp_ntz")).collect()]
    base = dt.datetime(2024, 1, 5, 10, 11, 12)
    assert out == [base, base.replace(microsecond=123000), base.replace(microsecond=123456),
                   base.replace(microsecond=123456), None]
