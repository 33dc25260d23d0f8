"""Preferred labels of concepts by rule-based scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import hot_keys, salted_join

# Fixed values of the scoring rules.
START, PREFERRED_BONUS, DIGIT_COST = 10, 20, 3
SHORT, SHORT_STEP, LONG, LONG_STEP, CUT = 8, 3, 12, 13, 100


def label_score(label: Column, ispref: Column) -> Column:
    """Start, less for each hyphen or digit, more if marked preferred, less if short or long, one more if title-cased."""
    n = F.length(label)
    marks = n - F.length(F.translate(label, "-0123456789", ""))
    first, next2 = F.substring(label, 1, 1), F.substring(label, 2, 2)
    title = (F.upper(first) == first) & ~(F.upper(next2) == next2)
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")  # noqa: E731  operands are never negative
    return (
        F.lit(START) - DIGIT_COST * marks
        + F.when(ispref == "Y", PREFERRED_BONUS).otherwise(0)
        - F.when(n < SHORT, div(F.lit(SHORT) - n, SHORT_STEP)).otherwise(0)
        - F.when(n > LONG, div(n, LONG_STEP)).otherwise(0)
        + F.when(title, 1).otherwise(0)
    ).cast("int")


def scored_labels(atoms: DataFrame) -> DataFrame:
    """cui, preflabel, score, ispref, vocabcount, vocabs of each (cui, ispref, str). vocabs lists every source, repeats too, sorted.

    Sources are counted per (label, source) first, so a label with many rows never lies in one list twice as long as its sources times
    their counts say; the list is then built from the counts.
    """
    per = atoms.groupBy("cui", "ispref", "str", "sab").agg(F.count(F.lit(1)).alias("k"))
    runs = F.array_sort(F.collect_list(F.when(F.col("sab").isNotNull(), F.struct("sab", "k"))))
    g = per.groupBy("cui", "ispref", "str").agg(F.sum(F.when(F.col("sab").isNotNull(), F.col("k")).otherwise(0)).cast("int").alias("vocabcount"), runs.alias("_r"))
    vocabs = F.array_join(F.flatten(F.transform("_r", lambda r: F.array_repeat(r["sab"], r["k"].cast("int")))), ",")
    label = F.substring("str", 1, CUT)
    return g.select("cui", label.alias("preflabel"), label_score(label, F.col("ispref")).alias("score"), "ispref", "vocabcount", vocabs.alias("vocabs"))


def best_labels(scored: DataFrame) -> DataFrame:
    """The rows with the best score of their concept and, among these, the shortest label: ties are kept.

    Both limits are aggregates over (cui), combined before the shuffle and joined back with salt, so a concept with very many labels is
    not gathered as a window would.
    """
    n = F.length("preflabel")
    limit = scored.groupBy("cui").agg(F.max(F.struct("score", (-n).alias("short"))).alias("_b"))
    j = salted_join(scored, limit, ["cui"], "preflabel", hot_keys(scored, ["cui"]))
    return j.filter((F.col("score") == F.col("_b.score")) & (n == -F.col("_b.short"))).select(*scored.columns, F.col("_b.score").alias("maxscore"), n.alias("minlen"))


def preferred(atoms: DataFrame) -> DataFrame:
    """cui, pref: the smallest of the best labels. One aggregation: per concept the largest (score, shortness), then the smallest label.

    Equal to the least of the least per lower-cased label.
    """
    label = F.substring("str", 1, CUT)
    one = atoms.select("cui", label.alias("pref"), label_score(label, F.col("ispref")).alias("s"), F.length(label).alias("n"))
    return one.groupBy("cui").agg(F.min(F.struct((-F.col("s")).alias("s"), "n", "pref")).alias("b")).select("cui", F.col("b.pref").alias("pref"))


def with_group_max(df: DataFrame, keys: list[str], value: str, name: str, unique: str) -> DataFrame:
    """``name``: the largest ``value`` of each row's group (what a correlated update does). Combined before the shuffle, joined back with salt."""
    return salted_join(df, df.groupBy(*keys).agg(F.max(value).alias(name)), keys, unique, hot_keys(df, keys), "left")
