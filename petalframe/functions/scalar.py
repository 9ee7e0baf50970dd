"""Scalar helpers (F3, F5-F10): thin, named Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ms(c) -> Column:
    """milliseconds to 2 digits."""
    return F.round(c, 2)


def first_path_part(c, sep: str = "/") -> Column:
    """first segment of a path (``a/b/c`` -> ``a``)."""
    return F.substring_index(c, sep, 1)


def url_host(c) -> Column:
    """F5 for URLs: the host between ``//`` and the next ``/``."""
    return F.split(c, "/").getItem(2)


def run_name(ts) -> Column:
    """F8: run folder name ``yyyyMMdd_HHmmss``."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def duration_ms(start, end) -> Column:
    """milliseconds between two timestamps."""
    return (F.unix_micros(F.col(end).cast("timestamp") if isinstance(end, str) else end.cast("timestamp"))
            - F.unix_micros(F.col(start).cast("timestamp") if isinstance(start, str) else start.cast("timestamp"))) / 1000.0
