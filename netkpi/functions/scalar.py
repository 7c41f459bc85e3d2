"""Scalar expressions. All run inside generated code; none is a Python function."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def in_range(col: Column, start: str, end: str) -> Column:
    """Half-open [start, end). The bare column is compared, so the range reaches the Parquet scan."""
    return (col >= F.lit(start).cast("timestamp_ntz")) & (col < F.lit(end).cast("timestamp_ntz"))


def in_year(col: Column, year: int) -> Column:
    """year(col) = year as a range: a function of the column would not be pushed down."""
    return in_range(col, f"{year}-01-01", f"{year + 1}-01-01")


def outside_band(actual: Column, lower: Column, upper: Column) -> Column:
    """1 outside, 0 inside or on a bound, NULL when a value is missing."""
    return ((actual < lower) | (actual > upper)).cast("int")


def band_distance(actual: Column, lower: Column, upper: Column) -> Column:
    """Distance to the nearer bound when outside, else NULL."""
    return (
        F.when(actual < lower, lower - actual).when(actual > upper, actual - upper).cast("double")
    )


def series_key(cols: Sequence[str]) -> Column:
    """Parts joined by a hyphen; a NULL part makes the key NULL instead of shortening it."""
    parts = [F.col(c).cast("string") for c in cols]
    return F.concat(*[p for c in parts for p in (F.lit("-"), c)][1:])


def label_code(col: Column, codes: Mapping[str, int]) -> Column:
    """Mapped label as int; anything not listed is NULL."""
    out = F.lit(None)
    for text, code in codes.items():
        out = F.when(col == text, F.lit(code)).otherwise(out)
    return out.cast("int")


def to_number(col: str) -> Column:
    return F.expr(f"try_cast(`{col}` AS double)")


def stamp_in_path(path: Column) -> Column:
    """Time stamp written as yyyyMMdd_HHmmss inside a path; NULL when there is none."""
    text = F.regexp_extract(path, r"(\d{8}_\d{6})", 1)
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def elapsed_seconds(ts: Column, origin: str) -> Column:
    """Seconds from `origin` to a wall-clock time; no session zone and no clock change is involved."""
    gap = ts - F.lit(origin).cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def age_in_days(stamp: Column, as_of: str) -> Column:
    """Whole elapsed days of 24 hours."""
    return F.floor(-elapsed_seconds(stamp, as_of) / 86400).cast("long")


def split_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Bucket of an integer key by a multiplicative hash; the same on any layout and in any SQL engine."""
    mixed = F.pmod((F.pmod(key, F.lit(2147483647)) + seed) * F.lit(48271), F.lit(2147483647))
    return F.pmod(mixed, F.lit(buckets)).cast("int")


def utc_instant(col: str) -> Column:
    """Wall-clock time read as UTC, whatever the session zone; streams need an instant for watermarks."""
    return F.expr(f"CAST(convert_timezone('UTC', current_timezone(), `{col}`) AS timestamp)")


def utc_wallclock(col: str) -> Column:
    """Inverse of utc_instant."""
    return F.expr(f"convert_timezone(current_timezone(), 'UTC', CAST(`{col}` AS timestamp_ntz))")
