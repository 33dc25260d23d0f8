"""Concept info and label info: the tables behind the candidates of a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import is_acronym
from .labels import preferred
from .skew import hot_keys, salted_join

MAX_LABEL = 100


def comma_list(c: str) -> Column:
    """The distinct values sorted and joined by commas; null if there are none."""
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 0, F.array_join(s, ","))


def selected_types(types: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """The semantic type rows whose type belongs to the group."""
    return types.join(F.broadcast(groups.filter(F.col("styclass") == group).select("sty").distinct()), "sty", "left_semi").select(*types.columns)


def dictionary(atoms: DataFrame, selected: DataFrame) -> DataFrame:
    """str, cuis: the selected concepts of each label. The types only filter, so a concept with several of them counts once.

    Atoms are first reduced to distinct (str, cui), and a concept with many of them is salted.
    """
    pairs = atoms.filter(F.col("str").isNotNull()).select("str", "cui").distinct()
    kept = salted_join(pairs, selected.select("cui").distinct(), ["cui"], "str", hot_keys(atoms, ["cui"]), "left_semi")
    return kept.groupBy("str").agg(comma_list("cui").alias("cuis"))


def concept_info(types: DataFrame, atoms: DataFrame, freq: DataFrame, rank: DataFrame) -> DataFrame:
    """cui, tuis, stys, pref, vocabs, vocabcount, crisfreq, crisnorm, pagerank of every concept in ``types``.

    freq (cui, cnt, norm) and rank (cui, prob) have one row per concept. vocabcount counts, as a join of all would, every atom once per
    type row of the concept; each side is grouped by concept before the joins, so no join multiplies rows and a concept with a
    third of all atoms arrives as one row.
    """
    t = types.groupBy("cui").agg(comma_list("tui").alias("tuis"), comma_list("sty").alias("stys"), F.count(F.lit(1)).alias("_t"))
    a = atoms.groupBy("cui").agg(comma_list("sab").alias("vocabs"), F.count("sab").alias("_a"))
    return (
        t.join(preferred(atoms), "cui", "left").join(freq.select("cui", F.col("cnt").alias("crisfreq"), F.col("norm").alias("crisnorm")), "cui", "left").join(rank.select("cui", F.col("prob").alias("pagerank")), "cui", "left").join(a, "cui", "left")
        .select("cui", "tuis", "stys", "pref", "vocabs", (F.col("_t") * F.coalesce("_a", F.lit(0))).alias("vocabcount"), "crisfreq", "crisnorm", "pagerank")
    )


def label_info(atoms: DataFrame, info: DataFrame, label_freq: DataFrame) -> DataFrame:
    """The 12 columns of label info. Acronym-like labels keep their case, others are lower-cased; labels of 100 characters or more are left out.

    label_freq (label, cui, cnt, norm) is joined on the label as written, so its lower-cased labels meet only atoms written so; case
    variants of one label may therefore give two rows, with and without frequency.
    Atoms are grouped by (cui, label) before the joins; hot concepts are then salted.
    """
    per = atoms.filter((F.length("str") < MAX_LABEL) & F.col("cui").isNotNull()).groupBy("cui", "str").agg(F.collect_set("sab").alias("_s"))
    f = label_freq.select("cui", F.col("label").alias("str"), F.col("cnt").alias("crislabelcuifreq"), F.col("norm").alias("crislabelcuinorm"))
    per = per.join(f, ["cui", "str"], "left")
    per = per.withColumn("label", F.when(is_acronym(F.col("str")), F.col("str")).otherwise(F.lower("str"))).withColumn("_cased", is_acronym(F.col("str")))
    g = per.groupBy("_cased", "cui", "label", "crislabelcuifreq", "crislabelcuinorm").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_s")))), ",").alias("labelvocabs"))
    j = salted_join(g, info.withColumnRenamed("vocabs", "cuivocabs"), ["cui"], "label", hot_keys(g, ["cui"]))
    return j.select("label", "cui", "stys", "tuis", "pref", "labelvocabs", "cuivocabs", "crislabelcuifreq", "crislabelcuinorm", F.col("crisfreq").alias("criscuifreq"), F.col("crisnorm").alias("criscuinorm"), "pagerank").distinct()
