"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def size_bucket(size: Column, resolution_kb: int = 64) -> Column:
    """Upper bound of the size bucket in KB: 0 stays 0 and an exact multiple stays in its bucket."""
    step = resolution_kb * 1024
    return (F.floor((size + (step - 1)) / step) * resolution_kb).cast("bigint")


def unix_nano_to_ts(unix_nano: Column) -> Column:
    return F.timestamp_micros(F.floor(unix_nano / 1000))


def ts_to_unix_nano(ts: Column) -> Column:
    return F.unix_micros(ts) * 1000


def relative_seq(seq: Column, start: int) -> Column:
    return seq - F.lit(start)
