"""Lookups of a column in a key-value table, as joins. Which of several values wins is decided by an order column, never by chance.

The row side may be skewed: ``unique`` names a column that tells its rows apart, and hot keys are salted by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, staged
from ..sources.sinks import keep_first, keep_last
from .skew import hot_keys, salted_join


def _join(rows: DataFrame, table: DataFrame, column: str, unique: str, how: str) -> DataFrame:
    return salted_join(rows, table, [column], unique, hot_keys(rows.filter(F.col(column).isNotNull()), [column]), how)


def replace_column(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, unique: str, write_unchanged: bool = False) -> DataFrame:
    """Replace by every matching value (one row each). Rows without a match stay iff ``write_unchanged``."""
    t = table.select(F.col(key).alias(column), F.col(value).alias("_v"), F.lit(True).alias("_hit"))
    j = _join(rows, t, column, unique, "left" if write_unchanged else "inner")
    return j.withColumn(column, F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(column))).select(*rows.columns)


def filter_by(rows: DataFrame, column: str, table: DataFrame, key: str, unique: str, missing: bool = False) -> DataFrame:
    """Rows whose value is a key of the table; with ``missing``, those whose value isn't (a null is in no table)."""
    t = table.filter(F.col(key).isNotNull()).select(F.col(key).alias(column)).distinct()
    return _join(rows, t, column, unique, "left_anti" if missing else "left_semi").select(*rows.columns)


def redirects(rows: DataFrame, column: str, table: DataFrame, from_col: str, to_col: str, order: str, unique: str, add: bool = False, info: bool = True) -> DataFrame:
    """Follow the first redirect (smallest ``order``) of each URI. ``info`` says redir or nonredir; with ``add`` the row as it was comes out too."""
    first = keep_first(table.select(from_col, to_col, order), [from_col], order).select(F.col(from_col).alias(column), F.col(to_col).alias("_to"))
    j = _join(rows, first, column, unique, "left")
    old = F.struct(F.col(column).alias("c"), F.lit("nonredir").alias("i"))
    new = F.struct(F.col("_to").alias("c"), F.lit("redir").alias("i"))
    both = F.when(F.col("_to").isNull(), F.array(old)).otherwise(F.array(old, new) if add else F.array(new))
    out = j.withColumn("_x", F.explode(both)).withColumn(column, F.col("_x.c")).withColumn("info", F.col("_x.i"))
    return out.select(*rows.columns, *["info"] * info)


def disambiguations(rows: DataFrame, column: str, table: DataFrame, from_col: str, to_col: str, unique: str) -> DataFrame:
    """One row per disambiguation, tagged ``disamb``; rows without one stay, tagged ``nodisamb``."""
    t = table.select(F.col(from_col).alias(column), F.col(to_col).alias("_to"))
    j = _join(rows, t, column, unique, "left")
    return j.withColumn("info", F.when(F.col("_to").isNull(), "nodisamb").otherwise("disamb")).withColumn(column, F.coalesce("_to", column)).select(*rows.columns, "info")


def update_by_key(table: DataFrame, key: str, value: str, updates: DataFrame, update_key: str, update_value: str, order: str, unique: str) -> DataFrame:
    """Set ``value`` where ``key`` is among the updates; the last update per key (largest ``order``) wins, others change nothing."""
    last = keep_last(updates.filter(F.col(update_key).isNotNull()).select(update_key, update_value, order), [update_key], order)
    last = last.select(F.col(update_key).alias(key), F.col(update_value).alias("_v"), F.lit(True).alias("_hit"))
    return _join(table, last, key, unique, "left").withColumn(value, F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(value))).select(*table.columns)


def closed_redirects(table: DataFrame, rounds: int = 64) -> DataFrame:
    """from_uri -> the end of its chain, by pointer doubling: after k rounds chains of 2^k steps are closed.

    A URI on a circle, or on a chain that leads into one, has no end: it goes to the smallest URI of the circle. Circles are found by the
    smallest URI on the way, doubled alongside. More rounds than 2^64 steps need raise an error. Hot targets are salted.
    """
    n0 = table.groupBy("from_uri").agg(F.min("to_uri").alias("to_uri"))
    cur = staged(n0.select("from_uri", "to_uri", F.col("to_uri").alias("least"), F.lit(False).alias("done")))
    most = cur.count()  # a chain without a circle has at most so many steps
    for k in range(rounds):
        step = cur.select(F.col("from_uri").alias("to_uri"), F.col("to_uri").alias("_n"), F.col("least").alias("_l"), F.col("done").alias("_d"))
        nxt = salted_join(cur, step, ["to_uri"], "from_uri", hot_keys(cur, ["to_uri"]), "left")
        end = F.col("_n").isNull()
        new = staged(nxt.select("from_uri", F.coalesce("_n", "to_uri").alias("to_uri"), F.least("least", F.coalesce("_l", "least")).alias("least"), end.alias("done")))
        release(cur)
        cur = new
        if cur.filter(~F.col("done")).isEmpty():
            return cur.select("from_uri", "to_uri")
        if 2**k > most:  # whoever is not at an end by now goes round in a circle, and ``to_uri`` lies on it
            on = cur.filter(~F.col("done"))
            # 2^k steps from a URI of the circle go all the way round it, so its least is that of the circle
            least = on.select(F.col("from_uri").alias("to_uri"), F.col("least").alias("_l"))
            out = on.select("from_uri", "to_uri").join(least, "to_uri", "left").select("from_uri", F.coalesce("_l", "to_uri").alias("to_uri"))
            return cur.filter("done").select("from_uri", "to_uri").unionByName(out)
    raise RuntimeError(f"redirects are not closed after {rounds} rounds")
