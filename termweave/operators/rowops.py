"""Row operators on tab-separated fields: column ``f`` is the array of a line's fields (see ``sources.readers.read_fields``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at(col: int | None) -> Column:
    return F.array_join("f", "\t") if col is None else F.get("f", F.lit(col))


def grep(df: DataFrame, pattern: str, col: int | None = None, invert: bool = False) -> DataFrame:
    """Lines in which ``pattern`` is found, in one field or the whole line. Lines without that field are dropped either way."""
    hit = _at(col).rlike(pattern)
    return df.filter(~hit if invert else hit)


def replace(df: DataFrame, pattern: str, replacement: str, col: int | None = None) -> DataFrame:
    """Replace all matches (``$1`` groups) in one field or the line. Lines without the field stay as they are."""
    if col is None:
        return df.withColumn("f", F.split(F.regexp_replace(_at(None), pattern, replacement), "\t", -1))
    return df.withColumn("f", F.transform("f", lambda x, i: F.when(i == col, F.regexp_replace(x, pattern, replacement)).otherwise(x)))


def add_column(df: DataFrame, index: int, value: str) -> DataFrame:
    """Insert a constant before field ``index``; past the end it is appended; an empty line becomes the value alone."""
    empty = (F.size("f") == 1) & (F.get("f", F.lit(0)) == "")
    placed = F.when(F.size("f") <= index, F.array_append("f", F.lit(value))).otherwise(F.concat(F.slice("f", 1, index), F.array(F.lit(value)), F.slice("f", F.lit(index + 1), F.size("f"))))
    return df.withColumn("f", F.when(empty, F.array(F.lit(value))).otherwise(placed))


def fields(df: DataFrame, indexes: list[int]) -> DataFrame:
    """Subset and reorder fields; a missing field is null."""
    return df.withColumn("f", F.array(*[F.get("f", F.lit(i)) for i in indexes]))


def smaller_than(df: DataFrame, column: str, limit: int = 65_536) -> DataFrame:
    """Rows whose text has fewer than ``limit`` characters on each of its lines, as the pattern ``.{limit,}`` would judge."""
    long = F.length(column) >= limit
    return df.filter(F.col(column).isNotNull() & ~(long & F.exists(F.split(column, "\n"), lambda x: F.length(x) >= limit)))


def observed(df: DataFrame, name: str, **counts: Column):
    """(frame, Observation): run counters that are filled when the frame is evaluated once, without a second pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("lines"), *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in counts.items()]), seen
