"""The resource pipelines end to end: release and corpus tables in, lookup resources out. Everything is lazy until a sink writes."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import ACRONYM
from ..operators import candidates, concepts, freq, graph
from ..operators.skew import hot_keys, salted_join
from ..session import staged
from ..sources import readers, sinks
from ..sources.schemas import schema


@dataclass(frozen=True)
class Config:
    """languages: ISO 639-1; group: semantic group that is kept; nlp_subset: only atoms whose CVF has the bit 256."""

    languages: tuple[str, ...] = ("en",)
    group: str = "KCX"
    nlp_subset: bool = False
    json_limit: int = candidates.LIMIT


def in_languages(atoms: DataFrame, languages: DataFrame, codes: tuple[str, ...]) -> DataFrame:
    """Inner join with the language table: an atom comes out once for each chosen code its language label stands for."""
    lang = languages.filter(F.col("iso6391").isin(list(codes))).select(F.col("umlslabel").alias("lat"))
    return atoms.join(F.broadcast(lang), "lat").select(*atoms.columns)


def nlp_subset(atoms: DataFrame, bit: int = 256) -> DataFrame:
    """Atoms whose CVF has the bit; null has none."""
    return atoms.filter(F.col("cvf").bitwiseAND(bit) != 0)


def restricted(atoms: DataFrame, languages: DataFrame, cfg: Config) -> DataFrame:
    a = in_languages(atoms, languages, cfg.languages)
    return nlp_subset(a) if cfg.nlp_subset else a


def gazetteer(atoms: DataFrame, types: DataFrame, groups: DataFrame, languages: DataFrame, group: str, codes: tuple[str, ...]) -> DataFrame:
    """Distinct labels of the chosen languages and concepts. Types and languages only filter, so both are semi-joins; hot concepts are salted."""
    t = concepts.selected_types(types, groups, group).select("cui").distinct()
    lang = languages.filter(F.col("iso6391").isin(list(codes))).select(F.col("umlslabel").alias("lat")).distinct()
    pairs = atoms.join(F.broadcast(lang), "lat", "left_semi").select("cui", "str").distinct()
    return salted_join(pairs, t, ["cui"], "str", hot_keys(atoms, ["cui"]), "left_semi").select("str").distinct()


def cased(labels: DataFrame) -> DataFrame:
    """Labels without white space and with an upper-case letter after a letter."""
    return labels.filter(~F.col("str").rlike(r"\s") & F.col("str").rlike(ACRONYM))


def uncased(labels: DataFrame) -> DataFrame:
    """part 0: labels with a blank; part 1: labels without white space and without that pattern. A label with other white space is in neither list."""
    s = F.col("str")
    a = labels.filter(s.contains(" ")).withColumn("part", F.lit(0))
    return a.unionByName(labels.filter(~s.rlike(r"\s") & ~s.rlike(ACRONYM)).withColumn("part", F.lit(1)))


def abstracts(definitions: DataFrame, types: DataFrame, unique: str) -> DataFrame:
    """cui and definition, tabs escaped; one row per definition and type row of its concept.

    Types are counted per concept, so the join brings a number, and only then is a definition repeated. Hot concepts are salted by the hash of
    ``unique``, a column that tells definitions apart.
    """
    n = types.groupBy("cui").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    j = salted_join(definitions, n, ["cui"], unique, hot_keys(definitions, ["cui"]))
    return j.withColumn("_i", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).select("cui", sinks.escape_tabs(F.col("def")).alias("def"))


def label_tables(atoms: DataFrame, types: DataFrame, groups: DataFrame, languages: DataFrame, freq: DataFrame, label_freq: DataFrame, rank: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """cuiinfo, labelinfo and candidates, from tables with one row per key in freq, label_freq and rank."""
    a = restricted(atoms, languages, cfg)
    info = concepts.concept_info(concepts.selected_types(types, groups, cfg.group), a, freq, rank)
    labels = concepts.label_info(a, info, label_freq)
    return {"cuiinfo": info, "labelinfo": labels, "candidates": candidates.label_candidates(labels, cfg.json_limit)}


# Names and types of the gazetteer lists.
LISTS = {"cased-labels.lst": ("umls", "cased"), "uncased-labels.lst": ("umls", "uncased")}


def run_all(tables: dict[str, DataFrame], out: str, cfg: Config = Config()) -> None:
    """All resources under ``out``: tables, candidates per language, gazetteer lists with their descriptor, abstracts per language."""
    t = label_tables(tables["atoms"], tables["types"], tables["groups"], tables["languages"], tables["freq"], tables["label_freq"], tables["rank"], cfg)
    sinks.write_table(t["labelinfo"], f"{out}/labelinfo")
    spark = t["labelinfo"].sparkSession
    sinks.write_per_language(candidates.label_candidates(spark.read.parquet(f"{out}/labelinfo"), cfg.json_limit), f"{out}/candidates", list(cfg.languages))
    for lang in cfg.languages:
        g = gazetteer(tables["atoms"], tables["types"], tables["groups"], tables["languages"], cfg.group, (lang,))
        cased(g).orderBy("str").select(F.col("str").alias("value")).write.mode("overwrite").text(f"{out}/gazetteer/{lang}/cased-labels.lst")
        uncased(g).orderBy("part", "str").select(F.col("str").alias("value")).write.mode("overwrite").text(f"{out}/gazetteer/{lang}/uncased-labels.lst")
        for name, kind in LISTS.items():
            line = sinks.gazetteer_definition({name: kind}).rstrip("\n")
            spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/gazetteer/{lang}/{name.replace('.lst', '.def')}")
    if "definitions" in tables:
        found = abstracts(tables["definitions"], concepts.selected_types(tables["types"], tables["groups"], cfg.group), "def")
        sinks.write_per_language(found, f"{out}/abstracts", list(cfg.languages))


def load(spark: SparkSession, folder: str, groups_file: str) -> dict[str, DataFrame]:
    """The tables of a release folder: atoms, types, definitions, cooccurrences, languages, and the groups of a group list.

    A co-occurrence is read if its file is there; an empty frame stands in for a file that isn't.
    """

    def rrf(name: str) -> DataFrame:
        try:
            return readers.read_rrf(spark, f"{folder}/{name}.RRF*", name)
        except AnalysisException:  # no such file
            return spark.createDataFrame([], schema(name))

    # line numbers of one small file, in its order
    lines = spark.read.text(groups_file, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))
    return {
        "atoms": rrf("MRCONSO"), "types": rrf("MRSTY").select("cui", "tui", "sty").distinct(), "definitions": rrf("MRDEF").filter(F.col("def").isNotNull()).select("cui", "def"),
        "cooccurrences": rrf("MRCOC"), "languages": readers.languages(spark), "groups": readers.semantic_groups(lines),
    }


def corpus_frequencies(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(freq, label_freq) of the mentions of an annotated corpus (see ``readers.read_mentions``)."""
    m = staged(mentions.filter(F.col("mention").isNotNull()))
    return freq.concept_freq(m), freq.label_concept_freq(m)


def run_release(spark: SparkSession, folder: str, groups_file: str, out: str, cfg: Config = Config(), corpus: str | None = None) -> list[tuple[str, float]]:
    """From a release folder (and an annotated corpus) to all resources; the stages and how many seconds each took, also in ``out/timings``.

    load: tables, written once; frequencies: counts of the corpus; graph: co-occurrence weights, their graph text, ranks;
    resources: ``run_all``.
    """
    took: list[tuple[str, float]] = []
    began = time.perf_counter()

    def done(stage: str) -> None:
        nonlocal began
        took.append((stage, round(time.perf_counter() - began, 3)))
        began = time.perf_counter()

    def written(df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, f"{out}/tables/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/tables/{name}")

    t = {name: written(df, name) for name, df in load(spark, folder, groups_file).items()}
    done("load")
    if corpus:
        by_concept, by_label = corpus_frequencies(readers.read_mentions(spark, corpus))
    else:
        by_concept, by_label = (spark.createDataFrame([], f"{c} string, cnt long, norm double") for c in ("cui", "label string, cui"))
    t |= {"freq": written(by_concept, "freq"), "label_freq": written(by_label, "label_freq")}
    done("frequencies")
    pairs = t["cooccurrences"].filter(F.col("cui1").isNotNull() & F.col("cui2").isNotNull())
    weights = written(graph.weights(pairs, "cui1", "cui2", "freq"), "weights")
    sinks.graph_lines(weights, "cui1", "cui2", "weight").write.mode("overwrite").text(f"{out}/graph")
    t["rank"] = written(graph.page_rank(weights, "cui1", "cui2", "weight", both_ways=True).withColumnRenamed("node", "cui"), "rank")
    done("graph")
    run_all(t, out, cfg)
    done("resources")
    spark.createDataFrame([(f"{stage}\t{s}",) for stage, s in took], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/timings")
    return took
