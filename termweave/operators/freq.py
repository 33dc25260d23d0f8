"""Counts and ratios over corpora and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .orphans import MARKERS
from .skew import hot_keys, salted_join


def with_total(df: DataFrame, key: str, value: str, name: str, unique: str, of: DataFrame | None = None) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the same key. The sums are joined back (salted), so no key is gathered.

    ``of``: a frame with the same rows that is cheaper to read, if there is one.
    """
    of = df if of is None else of
    return salted_join(df, of.groupBy(key).agg(F.sum(value).alias(name)), [key], unique, hot_keys(of, [key]))


def mention_counts(mentions: DataFrame, mention: str = "mention", anchor: str = "anchor", ignore_case: bool = False) -> DataFrame:
    """mention, total, links (rows with a non-empty anchor), linkprop."""
    m = F.lower(mention) if ignore_case else F.col(mention)
    g = mentions.groupBy(m.alias("mention")).agg(F.count(F.lit(1)).alias("total"), F.sum(F.when(F.coalesce(F.col(anchor), F.lit("")) != "", 1).otherwise(0)).alias("links"))
    return g.withColumn("linkprop", F.col("links") / F.col("total"))


def concept_freq(mentions: DataFrame, concept: str = "cui", fallback: str = "readable") -> DataFrame:
    """cui, cnt, norm (share of all mentions). A null concept takes the readable name. Markers are kept, as concepts."""
    g = mentions.groupBy(F.coalesce(concept, fallback).alias("cui")).agg(F.count(F.lit(1)).alias("cnt"))
    return g.select("cui", "cnt", (F.col("cnt") / F.lit(mentions.count())).alias("norm"))


def label_concept_freq(mentions: DataFrame, mention: str = "mention", concept: str = "cui", fallback: str = "readable", excluded: tuple[str, ...] = MARKERS) -> DataFrame:
    """label (lower-cased, ``"`` as ``'``), cui, cnt, norm (share of the label's mentions). Excluded concepts count in the shares but don't come out."""
    g = mentions.groupBy(F.lower(mention).alias("_l"), F.coalesce(concept, fallback).alias("cui")).agg(F.count(F.lit(1)).alias("cnt"))
    t = with_total(staged(g), "_l", "cnt", "_t", "cui")
    return t.filter(F.col("cui").isNull() | ~F.col("cui").isin(*excluded)).select(F.replace("_l", F.lit('"'), F.lit("'")).alias("label"), "cui", "cnt", (F.col("cnt") / F.col("_t")).alias("norm"))


def commonness(links: DataFrame, label: str = "label", uri: str = "uri", cut: int = 1000) -> DataFrame:
    """label, uri, freq, label_freq, uri_freq, rel_by_label, rel_by_uri. Both names are cut at ``cut`` characters."""
    g = links.groupBy(F.substring(label, 1, cut).alias("label"), F.substring(uri, 1, cut).alias("uri")).agg(F.count(F.lit(1)).alias("freq"))
    g = staged(g)  # read three times below
    t = with_total(with_total(g, "label", "freq", "label_freq", "uri"), "uri", "freq", "uri_freq", "label", of=g)
    return t.select("label", "uri", "freq", "label_freq", "uri_freq", (F.col("freq") / F.col("label_freq")).alias("rel_by_label"), (F.col("freq") / F.col("uri_freq")).alias("rel_by_uri"))
