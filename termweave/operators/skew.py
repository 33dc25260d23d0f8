"""Joins whose left side may have a few keys that hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least 1/HOT of all rows is always among the HOT most frequent, so the list below can be this short.
HOT = 256
#: Below so many rows a key needs no salt.
LEAST = 20_000


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column (names are compared without case, as Spark does)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_hash(cols: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])


def hot_keys(df: DataFrame, cols: list[str], weight: str | None = None, least: int = LEAST) -> list[int]:
    """Hashes of the at most ``HOT`` most frequent keys that have ``least`` rows or more.

    Counts are combined before the shuffle; what reaches the driver is at most ``HOT`` integers. ``weight`` names a column of row
    counts if ``df`` is already grouped. A hash shared by two keys only salts one key too many.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    found = df.groupBy(key_hash(cols).alias("_h")).agg(n.alias("_n")).filter(F.col("_n") >= least).orderBy(F.desc("_n"), "_h").limit(HOT)
    return [r["_h"] for r in found.collect()]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], unique: str, hot: list[int], how: str = "inner", salts: int | None = None) -> DataFrame:
    """Equi-join in which rows of ``left`` with a hot key are spread over ``salts`` tasks and the few hot rows of ``right`` are repeated there.

    ``right`` should hold one row (or few) per key. ``unique`` is a column of ``left`` that tells rows apart; the salt is its hash,
    so a task that runs again makes the same choice. Null keys match nothing. ``how``: inner, left, left_semi or left_anti.
    """
    if not hot:
        return left.join(right, on, how)
    salts = salts or max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot, salt = key_hash(on).isin(hot), unused("_salt", left, right)
    a = left.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(unique), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    b = right.withColumn(salt, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return a.join(b, [*on, salt], how).drop(salt)
