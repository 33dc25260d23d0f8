"""Queries of the problems tagged llm, each with SQL where there is an equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_key, core, word_bag
from ..operators.skew import hot_keys, salted_join
from ..session import staged, table
from . import copies, langid, mixing, packing, tokens, topn, truncation

CLEAN = r"upper(regexp_replace({}, '[^\p{{L}}\p{{Nd}}]', '', 'g'))"
BAG = r"array_to_string(list_sort(regexp_extract_all(lower({}), '[\p{{L}}\p{{Nd}}]+')), ' ')"

# Problem 2 -------------------------------------------------------------------------------------------------------------------------

RECORDS = {
    "mrconso": [copies.Field("cui", clean_key), copies.Field("sab", F.col), copies.Field("str", word_bag)],
    "labelinfo": [copies.Field("cui", clean_key), copies.Field("label", word_bag)],
}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = (copies.found(table(spark, d, t), "line_no", f).select(F.lit(t).alias("tab"), "line_a", "line_b") for t, f in RECORDS.items())
    return a.unionByName(b)


def p2_atoms(spark: SparkSession, d: str) -> DataFrame:
    """One record per atom with its number of copies."""
    return copies.collapse(table(spark, d, "mrconso"), "line_no", RECORDS["mrconso"]).select("line_no", "cui", "sab", "str", "copies")


def p2_labels(spark: SparkSession, d: str) -> DataFrame:
    return copies.collapse(table(spark, d, "labelinfo"), "line_no", RECORDS["labelinfo"]).select("line_no", "cui", "label", "copies")


_KEYS = {"mrconso": f"{CLEAN.format('cui')}, sab, {BAG.format('str')}", "labelinfo": f"{CLEAN.format('cui')}, {BAG.format('label')}"}


def _copies_sql(t: str, cols: str) -> str:
    w = f"(PARTITION BY {_KEYS[t]})"
    return f"SELECT line_no, {cols}, copies FROM (SELECT *, count(*) OVER {w} AS copies, min(line_no) OVER {w} AS f FROM {t}) WHERE line_no = f"


# Problem 6 -------------------------------------------------------------------------------------------------------------------------

LABELS = {"preferredlabels": ("preflabel", "exporter"), "labelfreq": ("label", "corpus")}


def _values(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, t).filter(F.col("cui").isNotNull() & F.col(c).isNotNull()).select(F.lit(t).alias("tab"), "line_no", F.col(s).alias("source"), clean_key("cui").alias("k"), core(c).alias("v"))
        for t, (c, s) in LABELS.items()
    ]
    return parts[0].unionByName(parts[1])


def _cut_labels(spark: SparkSession, d: str) -> DataFrame:
    values = _values(spark, d)
    cut = truncation.continued(values, truncation.known_labels(table(spark, d, "mrconso"), "cui", "str"))
    rows = values.withColumn("_u", F.concat_ws(":", "tab", "line_no"))
    return salted_join(rows, cut, ["k", "v"], "_u", hot_keys(values, ["k", "v"])).select("tab", "line_no", "source")


def _cut_json(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "labelinfo_json")
    return j.filter(~truncation.whole_json_array("info")).select(F.lit("labelinfo_json").alias("tab"), "line_no", F.col("writer").alias("source"))


def _cut(spark: SparkSession, d: str) -> DataFrame:
    return _cut_labels(spark, d).unionByName(_cut_json(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d).select("tab", "line_no")


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per table and source: rows, cut rows, share."""
    rows = [table(spark, d, t).select(F.lit(t).alias("tab"), F.col(s).alias("source")) for t, (_, s) in LABELS.items()]
    rows.append(table(spark, d, "labelinfo_json").select(F.lit("labelinfo_json").alias("tab"), F.col("writer").alias("source")))
    one = lambda df, k: df.groupBy("tab", F.coalesce("source", F.lit("(none)")).alias("source")).agg(F.count(F.lit(1)).alias(k))
    n = one(rows[0].unionByName(rows[1]).unionByName(rows[2]), "n_rows")
    return n.join(one(_cut(spark, d), "n_cut"), ["tab", "source"], "left").select("tab", "source", "n_rows", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), (F.coalesce("n_cut", F.lit(0)) / F.col("n_rows")).alias("share"))


def p6_length_spikes(spark: SparkSession, d: str) -> DataFrame:
    """Field limits by source: lengths in characters and bytes (from_len to len) that hold far more values than those around them."""
    fields = {**LABELS, "labelinfo_json": ("info", "writer")}
    parts = [truncation.length_spikes(truncation.length_histogram(table(spark, d, t), s, c)).select(F.lit(t).alias("tab"), "source", "unit", "from_len", "len", "n", "n_open") for t, (c, s) in fields.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p6_suspects(spark: SparkSession, d: str) -> DataFrame:
    """Values at a field limit without terminal punctuation."""
    fields = {**LABELS, "labelinfo_json": ("info", "writer")}
    parts = [truncation.suspects(table(spark, d, t), s, c, ["line_no"]).select(F.lit(t).alias("tab"), "line_no") for t, (c, s) in fields.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p6_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Each cut row, and whether its length is a field limit of its source (``limit``) or not (``transfer``)."""
    at = p6_suspects(spark, d).withColumn("hit", F.lit(True))
    return p6_found(spark, d).join(at, ["tab", "line_no"], "left").select("tab", "line_no", F.when(F.col("hit"), "limit").otherwise("transfer").alias("evidence"))


# Problem 7 -------------------------------------------------------------------------------------------------------------------------


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.top_n(table(spark, d, "preferredlabels"), "cui", "score", ["preflabel", "line_no"], 3).select("cui", "rnk", "line_no")


# Problems 8 and 9 ------------------------------------------------------------------------------------------------------------------


def p8_contents(spark: SparkSession, d: str) -> DataFrame:
    """The contents of each container of 2,048 tokens: documents, and which of their tokens."""
    sizes = tokens.with_token_counts(table(spark, d, "documents"), "text", ["doc_id"])
    return packing.pack(sizes, "doc_id", "n_tokens").select("container", "doc_id", "piece", F.col("from_unit").alias("from_token"), F.col("to_unit").alias("to_token"), F.col("n_units").alias("n_tokens"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    c = p8_contents(spark, d).filter("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return c.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), (1 - F.sum("used") / (F.count(F.lit(1)) * packing.CAPACITY)).alias("waste"))


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """Whether the promises hold on the contents: every document is in containers once and whole, none is above the capacity, only longer ones
    than a container are divided, and the containers are at most eleven ninths of the least possible number and one, best fit's bound."""
    c = staged(p8_contents(spark, d))
    per_doc = c.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pieces"), F.max("to_token").alias("size"), F.sum("n_tokens").alias("got"), F.min("from_token").alias("low"), F.max("piece").alias("last")
    ).agg(
        F.count(F.lit(1)).alias("documents"), F.bool_and((F.col("got") == F.col("size")) & (F.col("low") == 0) & (F.col("last") == F.col("pieces"))).alias("whole"),
        F.bool_and((F.col("pieces") == 1) | (F.col("size") > packing.CAPACITY)).alias("only_long_divided"),
    )
    full = c.filter("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("n"))
    total = full.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("tokens"))
    ok = F.col("k") <= F.ceil(F.col("tokens") / packing.CAPACITY) * 11 / 9 + 1
    return per_doc.join(F.broadcast(total)).select("documents", "whole", "only_long_divided", (F.col("most") <= packing.CAPACITY).alias("fits"), ok.alias("few_containers"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = tokens.with_token_counts(table(spark, d, "documents"), "text", ["doc_id", "source"])
    return mixing.mix(sizes, table(spark, d, "mix_targets"), "doc_id")


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p9_bands(spark: SparkSession, d: str) -> DataFrame:
    """Per source and band of lengths (powers of two): documents, chosen documents, tokens, chosen tokens with repeats."""
    sizes = staged(tokens.with_token_counts(table(spark, d, "documents"), "text", ["doc_id", "source"]))
    chosen = mixing.mix(sizes, table(spark, d, "mix_targets"), "doc_id")[0].select("doc_id", "copies")
    rows = sizes.filter("n_tokens > 0").join(chosen, "doc_id", "left").withColumn("band", F.floor(F.log2("n_tokens")).cast("int"))
    n, copies = F.col("n_tokens"), F.coalesce("copies", F.lit(0))
    return rows.groupBy("source", "band").agg(F.count(F.lit(1)).alias("documents"), F.count("copies").alias("chosen"), F.sum(n).alias("tokens"), F.sum(n * copies).alias("chosen_tokens"))


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per source of the targets whether the promises hold on the selection itself: cap; weight, to within a thousandth
    of all tokens or one longest document, whichever is more; a report that agrees; whole documents once."""
    chosen, shares = _mixed(spark, d)
    goal = table(spark, d, "mix_targets")
    per = chosen.groupBy("source").agg(F.max("n_tokens").alias("longest"), F.max("copies").alias("most"), F.sum(F.col("n_tokens") * F.col("copies")).alias("got"), (F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("once"))
    all_ = F.sum("got").over(Window.partitionBy())  # over one row per source of the targets
    j = F.broadcast(goal).join(per, "source", "left").join(F.broadcast(shares.select("source", "tokens")), "source").withColumn("whole", all_).withColumn("longest", F.max("longest").over(Window.partitionBy()))
    near = F.abs(F.coalesce("got", F.lit(0)) - F.col("weight") * F.col("whole")) <= F.greatest(F.col("whole") / 1000, F.col("longest"))
    return j.select("source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("cap_kept"), near.alias("share_kept"), (F.coalesce("got", F.lit(0)) == F.col("tokens")).alias("report_right"), F.coalesce("once", F.lit(True)).alias("once"))


# Problem 10 ------------------------------------------------------------------------------------------------------------------------


def _codes(spark: SparkSession, d: str) -> list[tuple[str, str, str]]:
    return [tuple(r) for r in table(spark, d, "language_codes").select("iso6391", "iso6393", "umlslabel").orderBy("iso6391").collect()]  # fixed table


_models: dict[tuple, langid.Model] = {}


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments by the model of these documents, which a session trains once."""
    docs, codes = table(spark, d, "documents"), _codes(spark, d)
    key = (spark.sparkContext.applicationId, *docs.inputFiles(), *codes)
    if key not in _models:
        _models.clear()
        _models[key] = langid.train(langid.training_docs(docs, codes))
    return langid.segments(docs, codes, _models[key])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.mislabelled(_segments(spark, d), _codes(spark, d))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment with its language, confidence and number of ambiguous sentences."""
    return _segments(spark, d).select("doc_id", "seg", "start", "stop", "n_sentences", F.col("found").alias("lang"), "confidence", "ambiguous")


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its main language, confidence, and whether its label fits."""
    codes = _codes(spark, d)
    x = langid.documents(_segments(spark, d))
    return x.select("doc_id", F.col("lang").alias("label"), F.col("found").alias("lang"), "confidence", "n_segments", "n_ambiguous", langid.label_fits(codes).alias("label_fits"))


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per document with a letter: whether its segments are numbered without gaps, follow each other, change language and have a confidence."""
    w = Window.partitionBy("doc_id").orderBy("seg")  # the segments of one document
    x = p10_segments(spark, d).withColumn("_n", F.row_number().over(w)).withColumn("_l", F.lag("lang").over(w)).withColumn("_e", F.lag("stop").over(w))
    ok = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    return x.groupBy("doc_id").agg(
        ok(F.col("_n") == F.col("seg")).alias("numbered"), ok((F.col("start") >= F.coalesce("_e", F.lit(0))) & (F.col("stop") > F.col("start"))).alias("in_order"),
        ok(F.col("_l") != F.col("lang")).alias("alternate"), ok(F.col("confidence").between(0, 1)).alias("confident"),
    )


_CORE = r"regexp_replace(lower({}), '[ \t\x{{a0}}.…]+$', '')"
_CUT_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS tab, line_no, {s} AS source FROM (SELECT line_no, {s}, {CLEAN.format('cui')} AS k, {_CORE.format(c)} AS v FROM {t} WHERE cui IS NOT NULL AND {c} IS NOT NULL) x "
    f"WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = x.k AND m.v = x.v) AND EXISTS (SELECT 1 FROM m WHERE m.k = x.k AND starts_with(m.v, x.v))"
    for t, (c, s) in LABELS.items()
)
_WITH_M = f"WITH m AS MATERIALIZED (SELECT DISTINCT {CLEAN.format('cui')} AS k, {_CORE.format('str')} AS v FROM mrconso)"
_JSON_SQL = r"SELECT 'labelinfo_json' AS tab, line_no, writer AS source FROM labelinfo_json WHERE info IS NULL OR NOT (json_valid(info) AND coalesce(json_type(CASE WHEN json_valid(info) THEN info END) = 'ARRAY', false))"


_FIELDS = {**LABELS, "labelinfo_json": ("info", "writer")}
_TERMINAL = ", ".join("'" + c.replace("'", "''") + "'" for c in truncation.TERMINAL)
_OPEN = " UNION ALL ".join(
    f"SELECT '{t}' AS tab, line_no, {s} AS source, u.unit AS unit, CASE u.unit WHEN 'chars' THEN length({c}) ELSE strlen({c}) END AS len, NOT right(rtrim({c}), 1) IN ({_TERMINAL}) OR regexp_matches({c}, '{truncation.ELLIPSES}') AS o "
    f"FROM {t}, (VALUES ('chars'), ('bytes')) u(unit) WHERE {c} IS NOT NULL"
    for t, (c, s) in _FIELDS.items()
)
_P = "PARTITION BY tab, source, unit ORDER BY len RANGE BETWEEN"
_SPIKES = (
    f"v AS MATERIALIZED ({_OPEN}), hist AS (SELECT tab, source, unit, len, count(*) AS n, CAST(count_if(o) AS BIGINT) AS n_open FROM v GROUP BY ALL), "
    f"w AS (SELECT *, coalesce(sum(n) OVER ({_P} 13 PRECEDING AND 4 PRECEDING), 0) / 10 AS below, sum(n) OVER ({_P} 3 PRECEDING AND CURRENT ROW) AS near, sum(n_open) OVER ({_P} 3 PRECEDING AND CURRENT ROW) AS near_open, "
    f"coalesce(sum(n) OVER ({_P} 1 FOLLOWING AND 10 FOLLOWING), 0) / 10 AS above, coalesce(max(CASE WHEN unit = 'chars' THEN n END) OVER (PARTITION BY tab, source ORDER BY len RANGE BETWEEN 3 PRECEDING AND CURRENT ROW), 0) AS chars FROM hist), "
    "x AS (SELECT *, unit = 'bytes' AND chars <= n AS covers, n >= 20 AND n > 5 * greatest(below, above, 1) AS alone FROM w), "
    "y AS (SELECT * FROM x WHERE alone OR (covers AND near >= 20 AND near > 8 * greatest(below, above, 1) AND n > 5 * greatest(above, 1))), "
    f"z AS (SELECT *, coalesce(bool_or(covers) OVER ({_P} 1 FOLLOWING AND 3 FOLLOWING), false) AS inside FROM y), "
    "spikes AS (SELECT tab, source, unit, CASE WHEN covers AND NOT inside THEN greatest(len - 3, 0) ELSE len END AS from_len, len, CAST(CASE WHEN covers AND NOT inside THEN near ELSE n END AS BIGINT) AS n, "
    "CAST(CASE WHEN covers AND NOT inside THEN near_open ELSE n_open END AS BIGINT) AS n_open FROM z WHERE alone OR NOT inside), "
    "suspects AS (SELECT DISTINCT v.tab, line_no FROM v JOIN spikes s ON v.tab = s.tab AND v.source IS NOT DISTINCT FROM s.source AND v.unit = s.unit AND v.len BETWEEN s.from_len AND s.len WHERE o)"
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (p2_found, p2_atoms, p2_labels, p6_found, p6_rates, p6_length_spikes, p6_suspects, p6_evidence, p7_found, p8_contents, p8_fill, p8_kept, p9_selection, p9_shares, p9_bands, p9_kept, p10_found, p10_segments, p10_documents, p10_kept)
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": " UNION ALL ".join(f"SELECT '{t}' AS tab, f AS line_a, line_no AS line_b FROM (SELECT line_no, min(line_no) OVER (PARTITION BY {k}) AS f FROM {t}) WHERE line_no <> f" for t, k in _KEYS.items()),
        "p2_atoms": _copies_sql("mrconso", "cui, sab, str"), "p2_labels": _copies_sql("labelinfo", "cui, label"),
        "p6_found": f"{_WITH_M} SELECT tab, line_no FROM ({_CUT_SQL} UNION ALL {_JSON_SQL})",
        "p6_length_spikes": f"WITH {_SPIKES} SELECT * FROM spikes", "p6_suspects": f"WITH {_SPIKES} SELECT * FROM suspects",
        "p6_evidence": f"{_WITH_M}, {_SPIKES} SELECT c.tab, c.line_no, CASE WHEN s.tab IS NULL THEN 'transfer' ELSE 'limit' END AS evidence FROM ({_CUT_SQL} UNION ALL {_JSON_SQL}) c LEFT JOIN suspects s USING (tab, line_no)",
        "p6_rates": f"{_WITH_M}, cut AS ({_CUT_SQL} UNION ALL {_JSON_SQL}), r AS ("
        + " UNION ALL ".join(f"SELECT '{t}' AS tab, coalesce({s}, '(none)') AS source FROM {t}" for t, s in (("preferredlabels", "exporter"), ("labelfreq", "corpus"), ("labelinfo_json", "writer")))
        + "), n AS (SELECT tab, source, count(*) AS n_rows FROM r GROUP BY 1, 2), c AS (SELECT tab, coalesce(source, '(none)') AS source, count(*) AS n_cut FROM cut GROUP BY 1, 2) "
        "SELECT tab, source, n_rows, coalesce(n_cut, 0) AS n_cut, coalesce(n_cut, 0) / n_rows AS share FROM n LEFT JOIN c USING (tab, source)",
        "p10_kept": r"SELECT doc_id, true AS numbered, true AS in_order, true AS alternate, true AS confident FROM documents WHERE regexp_matches(text, '\p{L}')",
        "p8_kept": "SELECT count(*) AS documents, true AS whole, true AS only_long_divided, true AS fits, true AS few_containers FROM documents",
        "p9_kept": "SELECT source, true AS cap_kept, true AS share_kept, true AS report_right, true AS once FROM mix_targets",
        "p7_found": "SELECT cui, CAST(rnk AS INTEGER) AS rnk, line_no FROM (SELECT cui, line_no, row_number() OVER (PARTITION BY cui ORDER BY score DESC NULLS LAST, preflabel NULLS FIRST, line_no) AS rnk FROM preferredlabels) WHERE rnk <= 3",
    }
