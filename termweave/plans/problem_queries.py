"""Queries of the general problems 1, 3, 4 and 5, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_key
from ..operators import chunks, orphans, packed, rejects
from ..session import table

CLEAN = r"upper(regexp_replace({}, '[^\p{{L}}\p{{Nd}}]', '', 'g'))"


def fixed_values(df: DataFrame, col: str, most: int = 10_000) -> list[str]:
    """The values of a fixed dimension table; refuses one that has grown past ``most`` rows."""
    rows = df.select(col).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col}: more than {most} values; this is no fixed table")
    return sorted(r[0] for r in rows if r[0] is not None)


def listed_sql(field: str, value: str, of: str) -> str:
    """SQL: the known values (``value`` of table ``of``) that ``field`` holds, in order. Finds what the grammar finds where every value is known."""
    known = f"(SELECT string_agg(regexp_replace({value}, '([^A-Za-z0-9 _])', '\\\\\\1', 'g'), '|' ORDER BY length({value}) DESC, {value}) FROM {of})"
    return f"regexp_extract_all({field}, {known})"


# Problem 1 -------------------------------------------------------------------------------------------------------------------------


def parsed_lines(spark: SparkSession, d: str, fil: str | None = None) -> DataFrame:
    """All lines parsed, or those of one file: others are left out before they reach the reader."""
    langs, vocabs = fixed_values(table(spark, d, "language_codes"), "umlslabel"), fixed_values(table(spark, d, "vocabularies"), "rsab")
    lines = table(spark, d, "rrf_lines").select("line_no", "fil", "rawline", "umlsversion")
    return rejects.parse_lines(lines.filter(F.col("fil") == fil) if fil else lines, langs, vocabs)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejects(parsed_lines(spark, d)).select("line_no")


def p1_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Each unusable line with its reason."""
    return rejects.rejects(parsed_lines(spark, d)).select("line_no", "fil", "reason", "rawline")


def p1_reject_counts(spark: SparkSession, d: str) -> DataFrame:
    p = parsed_lines(spark, d)
    return p.groupBy("fil", "umlsversion").agg(F.count(F.lit(1)).alias("n_lines"), F.count("reason").alias("n_rejected"))


def p1_mrconso(spark: SparkSession, d: str) -> DataFrame:
    return rejects.typed_rows(parsed_lines(spark, d, "MRCONSO.RRF"), "MRCONSO.RRF")


def p1_mrcols(spark: SparkSession, d: str) -> DataFrame:
    return rejects.typed_rows(parsed_lines(spark, d, "MRCOLS.RRF"), "MRCOLS.RRF")


def p1_mrsab(spark: SparkSession, d: str) -> DataFrame:
    return rejects.typed_rows(parsed_lines(spark, d, "MRSAB.RRF"), "MRSAB.RRF")


_FIELD = r'("(?:[^"]|"")*"|[^"|][^|]*|)\|'


def _lines_sql(name: str) -> str:
    """Cut by one regular expression per line: an independent way to the fields."""
    f = rejects.FORMATS[name]
    line = r"regexp_replace(rawline, '\r\z', '')"
    cells = ", ".join(f"CASE WHEN starts_with(c[{i}], '\"') THEN replace(c[{i}][2:-2], '\"\"', '\"') ELSE c[{i}] END AS \"{c}\"" for i, c in enumerate(f.columns, 1))
    return (
        f"(SELECT line_no, ok, {cells} FROM (SELECT line_no, "
        f"regexp_full_match({line}, '(?s)({_FIELD}){{{len(f.columns)}}}') AS ok, "
        f"list_transform(regexp_extract_all({line}, '(?s){_FIELD}'), lambda x: x[1:-2]) AS c FROM rrf_lines WHERE fil = '{name}'))"
    )


def _rules_sql(name: str) -> str:
    rule = rejects.rule_sql(rejects.FORMATS[name], [], [])
    return rule.replace("IN (NULL)", "IN (SELECT {})").replace("coalesce(\"SAB\" IN (SELECT {})", "coalesce(\"SAB\" IN (SELECT rsab FROM vocabularies)").replace("IN (SELECT {})", "IN (SELECT umlslabel FROM language_codes)")


def _typed_sql(name: str) -> str:
    f = rejects.FORMATS[name]
    cell = lambda c: f"CAST(nullif(\"{c}\", '') AS {'INTEGER' if c in f.integers else 'DECIMAL(5,2)' if c in f.decimals else 'VARCHAR'}) AS {c.lower()}"
    return f"SELECT line_no, {', '.join(cell(c) for c in f.columns)} FROM {_lines_sql(name)} WHERE ok AND {_rules_sql(name)} IS NULL"


_BAD = " UNION ALL ".join(f"SELECT line_no FROM {_lines_sql(n)} WHERE NOT ok OR {_rules_sql(n)} IS NOT NULL" for n in rejects.FORMATS)

def _reasons_sql(name: str) -> str:
    """Lines whose fields are cut well but too few, too many or not closed have a wrong column count; others have broken quoting."""
    line = r"regexp_replace(raw, '\r\z', '')"
    return (
        f"SELECT line_no, '{name}' AS fil, CASE WHEN ok THEN {_rules_sql(name)} WHEN regexp_full_match({line}, '(?s)({_FIELD})*([^\"|][^|]*)?') THEN 'column count' ELSE 'broken quoting' END AS reason, raw AS rawline "
        f"FROM {_lines_sql(name)} JOIN (SELECT line_no AS n, rawline AS raw FROM rrf_lines) ON n = line_no WHERE NOT ok OR {_rules_sql(name)} IS NOT NULL"
    )


# Problem 3 -------------------------------------------------------------------------------------------------------------------------

LISTS = ("stys", "tuis", "labelvocabs", "cuivocabs")


def packed_values(spark: SparkSession, d: str) -> DataFrame:
    tuis, stys = fixed_values(table(spark, d, "semtypes"), "tui"), fixed_values(table(spark, d, "semtypes"), "sty")
    vocabs = fixed_values(table(spark, d, "vocabularies"), "rsab")
    codes = lambda known: packed.ListGrammar(tuple(known), blanks=True)
    grammars = {"stys": packed.ListGrammar(tuple(stys)), "tuis": codes(tuis), "labelvocabs": codes(vocabs), "cuivocabs": codes(vocabs)}
    return packed.unpack(table(spark, d, "labelinfo"), grammars, ["line_no"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return packed_values(spark, d).select("line_no", "fld", "pos", "val")


def p3_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each value is listed, and how far down."""
    return packed_values(spark, d).groupBy("fld", "val").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("max_pos"))


def p3_flags(spark: SparkSession, d: str) -> DataFrame:
    """How often values are written in each way, and with which errors."""
    return packed_values(spark, d).groupBy("fld", "how", "error").agg(F.count(F.lit(1)).alias("n"))


_LISTED = "(" + " UNION ALL ".join(
    f"SELECT line_no, '{f}' AS fld, CAST(generate_subscripts(v, 1) AS INTEGER) AS pos, unnest(v) AS val FROM (SELECT line_no, {listed_sql(f, k, t)} AS v FROM labelinfo WHERE {f} IS NOT NULL)"
    for f, k, t in (("stys", "sty", "semtypes"), ("tuis", "tui", "semtypes"), ("labelvocabs", "rsab", "vocabularies"), ("cuivocabs", "rsab", "vocabularies"))
) + ")"


# Problem 4 -------------------------------------------------------------------------------------------------------------------------

CHILDREN = ("labelfreq", "cuifreq", "pagerank")


def _orphans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    refs = orphans.references({t: table(spark, d, t) for t in CHILDREN})
    parents = table(spark, d, "mrconso").filter(F.col("cui").isNotNull()).select(clean_key("cui").alias("k"), F.col("umlsversion").alias("period"))
    gone = table(spark, d, "mrcui").filter((F.col("rel") == "DEL") & F.col("cui1").isNotNull()).select(clean_key("cui1").alias("k"), F.col("ver").alias("period"))
    return refs, orphans.orphan_keys(refs, parents, gone)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_rows(*_orphans(spark, d)).select("tab", "line_no")


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_rows(*_orphans(spark, d)).select("tab", "line_no", F.col("k").alias("cui"), F.col("period").alias("umlsversion"), "reason")


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per table and release: rows that refer, orphans, and orphans by reason."""
    return orphans.orphan_counts(*_orphans(spark, d)).withColumnRenamed("period", "umlsversion")


_REFS = "(" + " UNION ALL ".join(f"SELECT '{t}' AS tab, line_no, {CLEAN.format('cui')} AS k, umlsversion FROM {t} WHERE cui IS NOT NULL AND cui NOT IN ('<SPURIOUS>', '<NONE OF ABOVE>')" for t in CHILDREN) + ")"
_JUDGED = (
    f"(SELECT r.*, CASE WHEN p.since IS NULL THEN 'missing' WHEN p.since > r.umlsversion THEN 'later' WHEN g.until <= r.umlsversion THEN 'deleted' END AS reason FROM {_REFS} r "
    f"LEFT JOIN (SELECT {CLEAN.format('cui')} AS k, min(umlsversion) AS since FROM mrconso GROUP BY 1) p ON r.k = p.k "
    f"LEFT JOIN (SELECT {CLEAN.format('cui1')} AS k, min(ver) AS until FROM mrcui WHERE rel = 'DEL' GROUP BY 1) g ON r.k = g.k)"
)

# Problem 5 -------------------------------------------------------------------------------------------------------------------------


def _pairs(spark: SparkSession, d: str, key: str) -> tuple[DataFrame, str, str, dict]:
    li = table(spark, d, "labelinfo").select("label", clean_key("cui").alias("cui"), F.coalesce("crislabelcuifreq", F.lit(0)).alias("f"), F.coalesce("pagerank", F.lit(0.0)).alias("r"))
    return li, key, "cui" if key == "label" else "label", {"freq": F.max("f"), "prob": F.max("r")}


def _ranked(spark: SparkSession, d: str, key: str) -> DataFrame:
    return chunks.ranked_items(*_pairs(spark, d, key))


def _results(spark: SparkSession, d: str, key: str) -> DataFrame:
    item = "cui" if key == "label" else "label"
    m = chunks.merge_chunks(_ranked(spark, d, key), [key], ["copies"], [item, "freq", "prob"])
    return m.select(key, F.col("copies").alias("n_rows"), F.col("n_rows").alias(f"n_{item}s"), F.col(f"first_{item}").alias(f"best_{item}"), F.col("first_freq").alias("best_freq"), F.col("first_prob").alias("best_prob"), F.col(f"last_{item}").alias(f"least_{item}"))


def p5_label_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The candidates of every label in order of merit, one row each."""
    return _ranked(spark, d, "label").select("label", F.col("row_no").alias("pos"), "cui", "copies", "freq", "prob")


def p5_label_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The candidates of every label in chunks of 50, and what each chunk brings."""
    c = chunks.ranked_items(*_pairs(spark, d, "label"), 50)
    return c.groupBy("label", "chunk_no").agg(F.count(F.lit(1)).alias("n_cuis"), F.sum("copies").alias("n_rows"), F.min_by("cui", "row_no").alias("first_cui"), F.max_by("cui", "row_no").alias("last_cui"))


def p5_label_results(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d, "label")


def p5_cui_labels(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, "cui").select("cui", F.col("row_no").alias("pos"), "label", "copies", "freq", "prob")


def p5_cui_results(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d, "cui")


def _ranked_sql(key: str) -> str:
    item = "cui" if key == "label" else "label"
    order = f"freq DESC, prob DESC, {item}"
    return (
        f"(SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pos, {item}, copies, freq, prob FROM "
        f"(SELECT label, {CLEAN.format('cui')} AS cui, count(*) AS copies, max(coalesce(crislabelcuifreq, 0)) AS freq, max(coalesce(pagerank, 0.0)) AS prob FROM labelinfo GROUP BY 1, 2))"
    )


def _results_sql(key: str) -> str:
    item = "cui" if key == "label" else "label"
    return (
        f"SELECT {key}, CAST(sum(copies) AS BIGINT) AS n_rows, count(*) AS n_{item}s, min_by({item}, pos) AS best_{item}, min_by(freq, pos) AS best_freq, min_by(prob, pos) AS best_prob, max_by({item}, pos) AS least_{item} FROM {_ranked_sql(key)} GROUP BY {key}"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_rejects, p1_reject_counts, p1_mrconso, p1_mrcols, p1_mrsab, p3_found, p3_value_counts, p3_flags, p4_found, p4_reasons, p4_counts, p5_label_candidates, p5_label_chunks, p5_label_results, p5_cui_labels, p5_cui_results)}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _BAD,
        "p1_rejects": " UNION ALL ".join(_reasons_sql(n) for n in rejects.FORMATS),
        "p1_reject_counts": f"SELECT fil, umlsversion, count(*) AS n_lines, count(b.line_no) AS n_rejected FROM rrf_lines LEFT JOIN ({_BAD}) b USING (line_no) GROUP BY 1, 2",
        "p1_mrconso": _typed_sql("MRCONSO.RRF"), "p1_mrcols": _typed_sql("MRCOLS.RRF"), "p1_mrsab": _typed_sql("MRSAB.RRF"),
        "p3_found": f"SELECT * FROM {_LISTED}", "p3_value_counts": f"SELECT fld, val, count(*) AS n, max(pos) AS max_pos FROM {_LISTED} GROUP BY 1, 2",
        "p4_found": f"SELECT tab, line_no FROM {_JUDGED} WHERE reason IS NOT NULL",
        "p4_reasons": f"SELECT tab, line_no, k AS cui, umlsversion, reason FROM {_JUDGED} WHERE reason IS NOT NULL",
        "p4_counts": f"SELECT tab, umlsversion, count(*) AS refs, count(reason) AS orphans, " + ", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in ("missing", "later", "deleted")) + f", count(DISTINCT CASE WHEN reason IS NOT NULL THEN k END) AS orphan_keys FROM {_JUDGED} GROUP BY 1, 2",
        "p5_label_candidates": f"SELECT * FROM {_ranked_sql('label')}", "p5_label_results": _results_sql("label"),
        "p5_label_chunks": f"SELECT label, (pos - 1) // 50 AS chunk_no, count(*) AS n_cuis, CAST(sum(copies) AS BIGINT) AS n_rows, min_by(cui, pos) AS first_cui, max_by(cui, pos) AS last_cui FROM {_ranked_sql('label')} GROUP BY 1, 2",
        "p5_cui_labels": f"SELECT * FROM {_ranked_sql('cui')}", "p5_cui_results": _results_sql("cui"),
    }
