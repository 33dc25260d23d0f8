"""References whose record is missing, comes only later, or was deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_key
from .skew import hot_keys, salted_join

# Markers that stand in place of a key and refer to nothing.
MARKERS = ("<SPURIOUS>", "<NONE OF ABOVE>")


def references(tables: dict[str, DataFrame], key: str = "cui", period: str = "umlsversion") -> DataFrame:
    """The rows of all child tables that refer to something: tab, line_no, k (clean key), period. Null keys and markers refer to nothing."""
    parts = [
        df.filter(F.col(key).isNotNull() & ~F.col(key).isin(*MARKERS)).select(F.lit(name).alias("tab"), "line_no", clean_key(key).alias("k"), F.col(period).alias("period"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_keys(refs: DataFrame, parents: DataFrame, deletions: DataFrame) -> DataFrame:
    """The distinct (k, period) that refer to nothing, with ``reason``: missing, later or deleted.

    ``parents``: key and period of every parent row, any number per key; combined to the first period per key before the shuffle.
    ``deletions``: key and the period from which it is deleted. Distinct references are anti-joined with the parents, so hot keys
    arrive here once per period. A reference without a period has no parent at that time: missing, or later if the key exists at all.
    """
    first = parents.groupBy("k").agg(F.min("period").alias("_since"))
    gone = deletions.filter(F.col("period").isNotNull()).groupBy("k").agg(F.min("period").alias("_until"))
    fk = refs.select("k", "period").distinct()
    absent = fk.alias("f").join(first.alias("p"), (F.col("f.k") == F.col("p.k")) & (F.col("p._since") <= F.col("f.period")), "left_anti").join(first, "k", "left")
    absent = absent.select("k", "period", F.when(F.col("_since").isNull(), "missing").otherwise("later").alias("reason"))
    deleted = fk.join(gone, "k").filter(F.col("_until") <= F.col("period")).select("k", "period", F.lit("deleted").alias("reason"))
    return absent.unionByName(deleted).groupBy("k", "period").agg(F.max("reason").alias("reason"))


def orphan_rows(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """The referring rows of the orphans: tab, line_no, k, period, reason. Hot orphans are salted."""
    blank = F.coalesce("period", F.lit(""))  # rows without a period match on the blank
    rows = refs.withColumn("_p", blank)
    keys = orphans.select("k", blank.alias("_p"), "reason")
    hot = hot_keys(rows, ["k", "_p"])
    return salted_join(rows.withColumn("_u", F.concat_ws(":", "tab", "line_no")), keys, ["k", "_p"], "_u", hot).select("tab", "line_no", "k", "period", "reason")


def orphan_counts(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """Per table and period: rows that refer, orphan rows, orphan rows by reason, distinct orphan keys.

    Rows are counted per (table, period, key) before the join with the orphans, so the join works on keys, not rows.
    """
    n = refs.groupBy("tab", "period", "k").agg(F.count(F.lit(1)).alias("n"))
    j = n.withColumn("_p", F.coalesce("period", F.lit(""))).join(orphans.select("k", F.coalesce("period", F.lit("")).alias("_p"), "reason"), ["k", "_p"], "left")
    part = lambda r: F.sum(F.when(F.col("reason") == r, F.col("n")).otherwise(0))
    return j.groupBy("tab", "period").agg(
        F.sum("n").alias("refs"),
        F.sum(F.when(F.col("reason").isNotNull(), F.col("n")).otherwise(0)).alias("orphans"),
        part("missing").alias("missing"), part("later").alias("later"), part("deleted").alias("deleted"),
        F.count(F.when(F.col("reason").isNotNull(), 1)).alias("orphan_keys"),
    )
