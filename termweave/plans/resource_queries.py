"""Queries of the resource operators over the data tables, each with the SQL that gives the same rows.

Where the data have no table of the wanted shape, a view stands in: ``types`` are all types that label info lists for a concept; the group KCX holds the
types up to T441, BMH all of them; frequencies and ranks keep the last row per key. Concepts are cleaned everywhere (see ``clean_key``), so a
concept meets its rows however they write it. Queries ending in _bmh take the group BMH, the others KCX.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as fl
from ..functions import uris
from ..functions.text import clean_key
from ..operators import candidates, classes, concepts, freq, graph, labels, lookup, packed, rowops
from ..session import shared_path, staged, table
from ..sources import readers, schemas, sinks
from ..streaming import keyed
from . import pipelines, problem_queries, script

Q = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Q] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Q) -> Q:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Q]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Views -----------------------------------------------------------------------------------------------------------------------------


def types(spark: SparkSession, d: str) -> DataFrame:
    """The distinct types of each concept: every value listed in stys, and every code in tuis of rows that give the codes only."""
    st = table(spark, d, "semtypes")
    names, codes = problem_queries.fixed_values(st, "sty"), problem_queries.fixed_values(st, "tui")
    fields = {"stys": packed.ListGrammar(tuple(names)), "tuis": packed.ListGrammar(tuple(codes), blanks=True)}
    listed = packed.unpack(_with_concept(table(spark, d, "labelinfo")), fields, ["cui"]).select("cui", "fld", "val").distinct()
    known = st.select(F.lit("stys").alias("fld"), F.col("sty").alias("val"), "tui", "sty").unionByName(st.select(F.lit("tuis").alias("fld"), F.col("tui").alias("val"), "tui", "sty"))
    return listed.join(F.broadcast(known), ["fld", "val"]).select("cui", "tui", "sty").distinct()


def _with_concept(df: DataFrame) -> DataFrame:
    return df.filter(F.col("cui").isNotNull()).withColumn("cui", clean_key("cui"))


def groups(spark: SparkSession, d: str) -> DataFrame:
    st = table(spark, d, "semtypes")
    return st.filter(F.col("tui") <= "T441").select(F.lit("KCX").alias("styclass"), "sty").unionByName(st.select(F.lit("BMH").alias("styclass"), "sty"))


def freq_view(spark: SparkSession, d: str) -> DataFrame:
    return sinks.keep_last(_with_concept(table(spark, d, "cuifreq")).select("cui", "cnt", "norm", "line_no"), ["cui"], "line_no")


def rank_view(spark: SparkSession, d: str) -> DataFrame:
    return sinks.keep_last(_with_concept(table(spark, d, "pagerank")).select("cui", "prob", "line_no"), ["cui"], "line_no")


def label_freq_view(spark: SparkSession, d: str) -> DataFrame:
    return sinks.keep_last(_with_concept(table(spark, d, "labelfreq")).select("label", "cui", "cnt", "norm", "line_no"), ["label", "cui"], "line_no")


def atoms_view(spark: SparkSession, d: str) -> DataFrame:
    return _with_concept(table(spark, d, "mrconso")).filter("str is not null")


_CUI = problem_queries.CLEAN.format("cui")
_ATOMS = f"(SELECT * REPLACE ({_CUI} AS cui) FROM mrconso WHERE cui IS NOT NULL AND str IS NOT NULL)"
_TYPES = "(" + " UNION ".join(f"SELECT l.cui, s.tui, s.sty FROM (SELECT {_CUI} AS cui, unnest({problem_queries.listed_sql(f, k, 'semtypes')}) AS v FROM labelinfo WHERE cui IS NOT NULL) l JOIN semtypes s ON v = s.{k}" for f, k in (("stys", "sty"), ("tuis", "tui"))) + ")"
_KCX = f"(SELECT * FROM {_TYPES} WHERE sty IN (SELECT sty FROM semtypes WHERE tui <= 'T441'))"
_GROUPS = {"KCX": _KCX, "BMH": _TYPES}
_last = lambda t, cols, keys: f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY line_no DESC) AS rn FROM (SELECT * REPLACE ({_CUI} AS cui) FROM {t} WHERE cui IS NOT NULL)) WHERE rn = 1)"
_CF, _PR, _LF = _last("cuifreq", "cui, cnt, norm", "cui"), _last("pagerank", "cui, prob", "cui"), _last("labelfreq", "label, cui, cnt, norm", "label, cui")
_SCORED = (
    "(SELECT cui, substring(str, 1, 100) AS preflabel, ispref, vocabcount, vocabs, CAST(10 - 3 * (length(p) - length(translate(p, '-0123456789', ''))) + CASE WHEN ispref = 'Y' THEN 20 ELSE 0 END "
    "- CASE WHEN length(p) < 8 THEN (8 - length(p)) // 3 ELSE 0 END - CASE WHEN length(p) > 12 THEN length(p) // 13 ELSE 0 END "
    "+ CASE WHEN upper(p[1:1]) = p[1:1] AND NOT upper(p[2:3]) = p[2:3] THEN 1 ELSE 0 END AS INTEGER) AS score FROM "
    f"(SELECT cui, ispref, str, substring(str, 1, 100) AS p, CAST(count(sab) AS INTEGER) AS vocabcount, coalesce(string_agg(sab, ',' ORDER BY sab), '') AS vocabs FROM {_ATOMS} GROUP BY cui, ispref, str))"
)
_BEST = f"(SELECT cui, preflabel, score, ispref, vocabcount, vocabs, maxscore, minlen FROM (SELECT *, CAST(min(length(preflabel)) OVER (PARTITION BY cui) AS INTEGER) AS minlen FROM (SELECT *, max(score) OVER (PARTITION BY cui) AS maxscore FROM {_SCORED}) WHERE score = maxscore) WHERE length(preflabel) = minlen)"
_PREF = f"(SELECT cui, min(preflabel) AS pref FROM {_BEST} GROUP BY cui)"
_ACR = "(regexp_matches(a.str, '[a-zA-Z][A-Z]') AND a.str NOT LIKE '% %')"


def _info_sql(group: str) -> str:
    return (
        "(SELECT t.*, p.pref, a.vocabs, t.k * coalesce(a.n, 0) AS vocabcount, f.cnt AS crisfreq, f.norm AS crisnorm, r.prob AS pagerank FROM "
        f"(SELECT cui, string_agg(DISTINCT tui, ',' ORDER BY tui) AS tuis, string_agg(DISTINCT sty, ',' ORDER BY sty) AS stys, count(*) AS k FROM {_GROUPS[group]} GROUP BY cui) t "
        f"LEFT JOIN {_PREF} p ON p.cui = t.cui LEFT JOIN {_CF} f ON f.cui = t.cui LEFT JOIN {_PR} r ON r.cui = t.cui "
        f"LEFT JOIN (SELECT cui, string_agg(DISTINCT sab, ',' ORDER BY sab) AS vocabs, count(sab) AS n FROM {_ATOMS} GROUP BY cui) a ON a.cui = t.cui)"
    )


def _labels_sql(group: str) -> str:
    return (
        f"(SELECT DISTINCT CASE WHEN {_ACR} THEN a.str ELSE lower(a.str) END AS label, a.cui, i.stys, i.tuis, min(i.pref) AS pref, string_agg(DISTINCT a.sab, ',' ORDER BY a.sab) AS labelvocabs, min(i.vocabs) AS cuivocabs, "
        "f.cnt AS crislabelcuifreq, f.norm AS crislabelcuinorm, min(i.crisfreq) AS criscuifreq, min(i.crisnorm) AS criscuinorm, min(i.pagerank) AS pagerank "
        f"FROM {_ATOMS} a JOIN {_info_sql(group)} i ON a.cui = i.cui LEFT JOIN {_LF} f ON a.cui = f.cui AND a.str = f.label WHERE length(a.str) < 100 "
        f"GROUP BY a.cui, CASE WHEN {_ACR} THEN a.str ELSE lower(a.str) END, {_ACR}, i.stys, i.tuis, f.cnt, f.norm)"
    )


def _number_sql(c: str) -> str:
    """A double as the JVM prints it: a point and a digit behind it, powers of ten below a thousandth and from ten million."""
    sign, x = f"CASE WHEN {c} < 0 THEN '-' ELSE '' END", f"abs({c})"
    digits = f"rtrim(ltrim(replace(split_part(CAST({x} AS VARCHAR), 'e', 1), '.', ''), '0'), '0')"
    power = f"CAST(floor(log10({x}) + 1e-12) AS INTEGER)"
    plain = f"CASE WHEN contains(CAST({x} AS VARCHAR), '.') THEN CAST({x} AS VARCHAR) ELSE CAST({x} AS VARCHAR) || '.0' END"
    return f"CASE WHEN {c} IS NULL THEN 'null' WHEN {c} = 0 THEN '0.0' WHEN {x} >= 0.001 AND {x} < 1e7 THEN {sign} || {plain} ELSE {sign} || {digits}[1:1] || '.' || CASE WHEN length({digits}) > 1 THEN {digits}[2:] ELSE '0' END || 'E' || {power} END"


def _json_sql(group: str) -> str:
    def value(c: str, name: str) -> str:
        return _number_sql(c) if name.startswith("sc") and not name.endswith("Freq") else f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"

    fields = " || ',' || ".join(f"'\"{name}\":' || {value(c, name)}" for c, name in candidates.NAMES.items())
    return f"SELECT label, '[' || string_agg(j, ',' ORDER BY cui, j) || ']' AS info FROM (SELECT label, cui, '{{' || {fields} || '}}' AS j FROM {_labels_sql(group)}) GROUP BY label HAVING sum(length(j)) + count(*) + 1 < {candidates.LIMIT}"


# ALG-01 to ALG-04 ------------------------------------------------------------------------------------------------------------------


@query(f"SELECT cui, preflabel, score, ispref, vocabcount, vocabs FROM {_SCORED}")
def label_scores(spark, d):
    return labels.scored_labels(atoms_view(spark, d))


@query(f"SELECT * FROM {_BEST}")
def best_labels(spark, d):
    return labels.best_labels(labels.scored_labels(atoms_view(spark, d)))


@query(f"SELECT cui, pref FROM {_PREF}")
def preferred_label(spark, d):
    return labels.preferred(atoms_view(spark, d))


def _both(name: str, make: Callable[[SparkSession, str, str], DataFrame], sql: Callable[[str], str]) -> None:
    """A query for the group KCX, and the same ending in _bmh for the group BMH, which keeps the most frequent concepts."""
    for suffix, group in (("", "KCX"), ("_bmh", "BMH")):
        _QUERIES[name + suffix] = lambda s, d, g=group: make(s, d, g)
        _SQL[name + suffix] = sql(group)


def _selected(spark, d, group) -> DataFrame:
    return concepts.selected_types(types(spark, d), groups(spark, d), group)


def _info(spark, d, group) -> DataFrame:
    return concepts.concept_info(_selected(spark, d, group), atoms_view(spark, d), freq_view(spark, d), rank_view(spark, d))


def _labels(spark, d, group) -> DataFrame:
    return concepts.label_info(atoms_view(spark, d), _info(spark, d, group), label_freq_view(spark, d))


_both("semantic_group_filter", _selected, lambda g: f"SELECT * FROM {_GROUPS[g]}")
_both("concept_info", _info, lambda g: f"SELECT cui, tuis, stys, pref, vocabs, vocabcount, crisfreq, crisnorm, pagerank FROM {_info_sql(g)}")
_both("label_info", _labels, lambda g: f"SELECT * FROM {_labels_sql(g)}")
_both("label_candidates_json", lambda s, d, g: candidates.label_candidates(staged(_labels(s, d, g))), _json_sql)
# the arrays read back into rows are label info again, but for the labels whose array reaches the limit
_both(
    "label_candidates_back", lambda s, d, g: candidates.read_candidates(candidates.label_candidates(staged(_labels(s, d, g)))).drop("pos"),
    lambda g: f"SELECT * FROM {_labels_sql(g)} WHERE label IN (SELECT label FROM ({_json_sql(g)}))",
)


@query("SELECT line_no, label FROM labelinfo_json WHERE length(info) < 65536")
def oversize_filter(spark, d):
    return rowops.smaller_than(table(spark, d, "labelinfo_json"), "info").select("line_no", "label")


@query("SELECT label, crislabelcuifreq AS n, cui FROM labelinfo ORDER BY label, cui")
def sorted_labels(spark, d):
    return table(spark, d, "labelinfo").select("label", F.col("crislabelcuifreq").alias("n"), "cui").orderBy("label", "cui")


# Frequencies -----------------------------------------------------------------------------------------------------------------------


def _mentions(spark, d) -> DataFrame:
    return table(spark, d, "labelfreq").select(F.col("label").alias("mention"), F.coalesce("cui", F.lit("")).alias("anchor"), "cui", F.col("label").alias("readable"))


@query("SELECT label AS mention, count(*) AS total, CAST(sum(CASE WHEN coalesce(cui, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS links, sum(CASE WHEN coalesce(cui, '') <> '' THEN 1 ELSE 0 END) / count(*) AS linkprop FROM labelfreq GROUP BY 1")
def mention_counts(spark, d):
    return freq.mention_counts(_mentions(spark, d))


@query("SELECT event_type AS mention, count(*) AS total, CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS links, sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) / count(*) AS linkprop FROM events GROUP BY 1")
def event_mention_counts(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("mention"), F.when(F.col("value") > 100, F.col("user_id").cast("string")).otherwise("").alias("anchor"))
    return freq.mention_counts(e)


@query("SELECT coalesce(cui, label) AS cui, count(*) AS cnt, count(*) / (SELECT count(*) FROM labelfreq) AS norm FROM labelfreq GROUP BY 1")
def concept_freq(spark, d):
    return freq.concept_freq(_mentions(spark, d))


@query(
    "SELECT replace(l, '\"', '''') AS label, cui, cnt, cnt / t AS norm FROM (SELECT *, sum(cnt) OVER (PARTITION BY l) AS t FROM (SELECT lower(label) AS l, coalesce(cui, label) AS cui, count(*) AS cnt FROM labelfreq GROUP BY 1, 2)) "
    "WHERE cui NOT IN ('<SPURIOUS>', '<NONE OF ABOVE>')"
)
def label_concept_freq(spark, d):
    return freq.label_concept_freq(_mentions(spark, d))


@query(
    "SELECT label, uri, freq, CAST(sum(freq) OVER (PARTITION BY label) AS BIGINT) AS label_freq, CAST(sum(freq) OVER (PARTITION BY uri) AS BIGINT) AS uri_freq, freq / sum(freq) OVER (PARTITION BY label) AS rel_by_label, freq / sum(freq) OVER (PARTITION BY uri) AS rel_by_uri "
    "FROM (SELECT substring(label, 1, 1000) AS label, substring(cui, 1, 1000) AS uri, count(*) AS freq FROM labelinfo GROUP BY 1, 2)"
)
def commonness(spark, d):
    return freq.commonness(table(spark, d, "labelinfo"), "label", "cui")


# Graphs ----------------------------------------------------------------------------------------------------------------------------


@query("SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS weight FROM lineitem GROUP BY 1, 2 HAVING sum(CAST(l_quantity AS INTEGER)) > 1")
def cooccurrence_weights(spark, d):
    return graph.weights(table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int")), "l_partkey", "l_suppkey", "q")


_REL = "(SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1, 2 HAVING count(*) > 1)"


@query(f"SELECT * FROM {_REL}")
def relation_counts(spark, d):
    return graph.relation_counts(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


def _as_text(c: str):
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["count"].cast("string"), x["other"].cast("string"))), " ")


@query(f"SELECT l_partkey AS node, CAST(0 AS BIGINT) AS chunk_no, string_agg(n || ':' || l_suppkey, ' ' ORDER BY l_suppkey) AS edges FROM {_REL} GROUP BY 1")
def adjacency_out(spark, d):
    return graph.adjacency(relation_counts(spark, d), "l_partkey", "l_suppkey", "n").select(F.col("l_partkey").alias("node"), "chunk_no", _as_text("edges").alias("edges"))


@query(f"SELECT l_suppkey AS node, CAST(0 AS BIGINT) AS chunk_no, string_agg(n || ':' || l_partkey, ' ' ORDER BY l_partkey) AS edges FROM {_REL} GROUP BY 1")
def adjacency_in(spark, d):
    return graph.adjacency(relation_counts(spark, d), "l_suppkey", "l_partkey", "n").select(F.col("l_suppkey").alias("node"), "chunk_no", _as_text("edges").alias("edges"))


@query(
    "SELECT node, row_number() OVER (ORDER BY k) - 1 AS id FROM (SELECT node, min(k) AS k FROM (SELECT cui1 AS node, line_no * 2 AS k FROM mrcui WHERE cui2 IS NOT NULL UNION ALL SELECT cui2, line_no * 2 + 1 FROM mrcui WHERE cui2 IS NOT NULL) GROUP BY node)"
)
def graph_node_ids(spark, d):
    return graph.node_ids(table(spark, d, "mrcui").filter("cui2 is not null"), "cui1", "cui2", "line_no")


@query("SELECT 'u:' || l_partkey || ' v:' || l_suppkey || ' w:' || CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS value FROM lineitem GROUP BY l_partkey, l_suppkey HAVING sum(CAST(l_quantity AS INTEGER)) > 1")
def ppr_graph_text(spark, d):
    return sinks.graph_lines(cooccurrence_weights(spark, d), "l_partkey", "l_suppkey", "weight")


def _named(c: str):
    return F.concat(F.lit(c[2:3]), F.col(c).cast("string"))


_WEIGHTS = "(SELECT 'p' || l_partkey AS a, 's' || l_suppkey AS b, CAST(sum(CAST(l_quantity AS INTEGER)) AS DOUBLE) AS w FROM lineitem GROUP BY 1, 2 HAVING sum(CAST(l_quantity AS INTEGER)) > 1)"
_ROUND = "(SELECT n.node, 0.15 / (SELECT count(*) FROM nodes) + 0.85 * coalesce(x.p, 0) AS p FROM nodes n LEFT JOIN (SELECT t AS node, sum(r.p * e.w) AS p FROM e JOIN {} r ON e.s = r.node GROUP BY t) x USING (node))"


@query(
    f"WITH g AS MATERIALIZED (SELECT a AS s, b AS t, w FROM {_WEIGHTS} UNION ALL SELECT b, a, w FROM {_WEIGHTS}), e AS MATERIALIZED (SELECT s, t, w / sum(w) OVER (PARTITION BY s) AS w FROM g), nodes AS MATERIALIZED (SELECT DISTINCT s AS node FROM e), "
    "r0 AS MATERIALIZED (SELECT node, 1.0 / (SELECT count(*) FROM nodes) AS p FROM nodes), " + ", ".join(f"r{k} AS MATERIALIZED {_ROUND.format(f'r{k - 1}')}" for k in range(1, 31)) + " SELECT node, round(p / (SELECT sum(p) FROM r30), 9) AS prob FROM r30"
)
def static_pagerank(spark, d):
    """Ranks of the co-occurrence graph, to nine decimals."""
    w = cooccurrence_weights(spark, d).select(_named("l_partkey").alias("a"), _named("l_suppkey").alias("b"), "weight")
    return graph.page_rank(w, "a", "b", "weight", both_ways=True).select("node", F.round("prob", 9).alias("prob"))


_IDS = "(SELECT node, row_number() OVER (ORDER BY k) - 1 AS id FROM (SELECT node, min(k) AS k FROM (SELECT 'p' || l_partkey AS node, (l_partkey * 1000000 + l_suppkey) * 2 AS k FROM r UNION ALL SELECT 's' || l_suppkey, (l_partkey * 1000000 + l_suppkey) * 2 + 1 FROM r) GROUP BY node))"
_CHUNKS = "SELECT {0} AS node, (row_number() OVER (PARTITION BY {0} ORDER BY {1}) - 1) // 5 AS chunk_no, n || ':' || {1} AS edge, {1} AS other FROM x"


@query(
    f"WITH r AS MATERIALIZED {_REL}, ids AS MATERIALIZED {_IDS}, x AS MATERIALIZED (SELECT i.id AS a, j.id AS b, n FROM r JOIN ids i ON i.node = 'p' || l_partkey JOIN ids j ON j.node = 's' || l_suppkey) "
    + " UNION ALL ".join(f"SELECT '{way}' AS way, node, chunk_no, string_agg(edge, ' ' ORDER BY other) AS edges FROM ({_CHUNKS.format(*ends)}) GROUP BY node, chunk_no" for way, ends in (("out", "ab"), ("in", "ba")))
)
def graph_file(spark, d):
    """Relation counts as a graph of numbered nodes: written in both directions, in lists of at most five edges, and read back."""
    r = staged(relation_counts(spark, d).select(_named("l_partkey").alias("a"), _named("l_suppkey").alias("b"), "n", (F.col("l_partkey").cast("long") * 1_000_000 + F.col("l_suppkey")).alias("at")))
    ids = staged(graph.node_ids(r, "a", "b", "at"))
    e = staged(graph.with_ids(r.select("a", "b", "n"), ids, "a", "b"))
    at = _place(spark)
    sinks.write_graph(ids, graph.adjacency(e, "a", "b", "n", 5), graph.adjacency(e, "b", "a", "n", 5), at)
    way = lambda name, c: spark.read.parquet(f"{at}/{name}").select(F.lit(name).alias("way"), F.col(c).alias("node"), "chunk_no", _as_text("edges").alias("edges"))
    return way("out", "a").unionByName(way("in", "b"))


@query(
    "WITH RECURSIVE e AS (SELECT DISTINCT p_size AS a, p_size // 2 AS b FROM part WHERE p_size > 1), c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a) SELECT a, b FROM c"
)
def superclass_closure(spark, d):
    return graph.closure(table(spark, d, "part").filter("p_size > 1").selectExpr("p_size AS a", "p_size div 2 AS b").withColumn("b", F.col("b").cast("int")), "a", "b")


# Gazetteer and exports -------------------------------------------------------------------------------------------------------------


def _gazetteer(spark, d, group) -> DataFrame:
    return pipelines.gazetteer(atoms_view(spark, d), types(spark, d), groups(spark, d), table(spark, d, "language_codes"), group, ("en", "de"))


def _gaz_sql(group: str) -> str:
    return f"(SELECT DISTINCT a.str FROM {_ATOMS} a WHERE a.cui IN (SELECT cui FROM {_GROUPS[group]}) AND a.lat IN (SELECT umlslabel FROM language_codes WHERE iso6391 IN ('en', 'de')))"


_both("gazetteer_cased", lambda s, d, g: pipelines.cased(_gazetteer(s, d, g)).orderBy("str"), lambda g: f"SELECT str FROM {_gaz_sql(g)} WHERE NOT regexp_matches(str, '\\s') AND regexp_matches(str, '[a-zA-Z][A-Z]') ORDER BY str")
_both(
    "gazetteer_uncased", lambda s, d, g: pipelines.uncased(_gazetteer(s, d, g)),
    lambda g: f"SELECT str, CASE WHEN contains(str, ' ') THEN 0 ELSE 1 END AS part FROM {_gaz_sql(g)} WHERE contains(str, ' ') OR (NOT regexp_matches(str, '[\\t\\n\\x0b\\f\\r ]') AND NOT regexp_matches(str, '[a-zA-Z][A-Z]'))",
)


def _abstracts(spark, d, group) -> DataFrame:
    return pipelines.abstracts(_with_concept(table(spark, d, "documents")).select("doc_id", "cui", F.col("text").alias("def")), _selected(spark, d, group), "doc_id")


_both("abstracts_export", _abstracts, lambda g: f"SELECT x.cui, replace(x.text, chr(9), '&#x0009;') AS def FROM (SELECT * REPLACE ({_CUI} AS cui) FROM documents WHERE cui IS NOT NULL) x JOIN {_GROUPS[g]} t ON x.cui = t.cui")


def _dictionary_sql(group: str) -> str:
    return f"SELECT str, string_agg(DISTINCT cui, ',' ORDER BY cui) AS cuis FROM {_ATOMS} WHERE cui IN (SELECT cui FROM {_GROUPS[group]}) GROUP BY str"


def _dictionary(spark, d, group) -> DataFrame:
    return concepts.dictionary(atoms_view(spark, d), _selected(spark, d, group))


_both("dictionary", _dictionary, _dictionary_sql)
_both("dictionary_text", lambda s, d, g: sinks.dictionary_lines(_dictionary(s, d, g), "str", "cuis"), lambda g: f"SELECT replace(str, ' ', '_') || ' ' || replace(cuis, ',', ' ') AS value FROM ({_dictionary_sql(g)}) WHERE cuis IS NOT NULL")


@query("SELECT doc_id, i[-4:-3] || '/' || i[-2:] || '.finf' AS path FROM (SELECT doc_id, '0000' || doc_id AS i FROM documents)")
def sharded_path(spark, d):
    return table(spark, d, "documents").select("doc_id", sinks.shard_path(F.col("doc_id"), 2).alias("path"))


@query("SELECT concat_ws(chr(9), cui, cast(cnt AS VARCHAR)) AS value FROM (SELECT coalesce(cui, 'null') AS cui, coalesce(cast(cnt AS VARCHAR), 'null') AS cnt FROM cuifreq)")
def sql_rows(spark, d):
    table(spark, d, "cuifreq").createOrReplaceTempView("cuifreq_rows")
    return readers.sql_rows(spark, "select cui, cnt from cuifreq_rows")


@query("SELECT iso6391, lat, count(*) AS n FROM mrconso m JOIN language_codes l ON m.lat = l.umlslabel WHERE iso6391 IN ('en', 'hr', 'sr') GROUP BY 1, 2")
def script_counts(spark, d):
    """A templated script run statement by statement."""
    for t in ("mrconso", "language_codes"):
        table(spark, d, t).createOrReplaceTempView(f"s_{t}")
    text = """
-- atoms of the chosen languages
CREATE OR REPLACE TEMPORARY VIEW s_chosen AS
SELECT iso6391, lat FROM s_mrconso JOIN s_language_codes ON lat = umlslabel WHERE iso6391 IN ###LANGLIST;

// counts
SELECT iso6391, lat, count(*) AS n FROM s_chosen GROUP BY iso6391, lat;
"""
    done, error = script.run_script(spark, script.filled(text, LANGLIST=script.sql_list("en hr sr")))
    if error:
        raise error
    return done[-1]


# Filters ---------------------------------------------------------------------------------------------------------------------------


@query("SELECT line_no, cui, cvf FROM mrconso WHERE (cvf & 256) <> 0")
def bitmask_subset(spark, d):
    return pipelines.nlp_subset(table(spark, d, "mrconso")).select("line_no", "cui", "cvf")


@query("SELECT m.line_no, m.lat FROM mrconso m JOIN language_codes l ON m.lat = l.umlslabel WHERE l.iso6391 IN ('en', 'hr', 'sr', 'zh')")
def language_filter(spark, d):
    return pipelines.in_languages(table(spark, d, "mrconso"), table(spark, d, "language_codes"), ("en", "hr", "sr", "zh")).select("line_no", "lat")


@query("SELECT line_no, str FROM mrconso WHERE regexp_matches(str, '[a-zA-Z][A-Z]') AND str NOT LIKE '% %'")
def acronym_labels(spark, d):
    return table(spark, d, "mrconso").filter(fl.is_acronym(F.col("str"))).select("line_no", "str")


@query("SELECT line_no, str FROM mrconso WHERE NOT regexp_matches(str, '[a-zA-Z][A-Z]') OR str LIKE '% %'")
def other_labels(spark, d):
    return table(spark, d, "mrconso").filter(~fl.is_acronym(F.col("str"))).select("line_no", "str")


def _lines(spark, d) -> DataFrame:
    """Preferred labels as tab-separated lines, split again."""
    p = table(spark, d, "preferredlabels").select(F.col("line_no").cast("string").alias("a"), F.coalesce("cui", F.lit("")).alias("b"), F.replace(F.coalesce("preflabel", F.lit("")), F.lit("\t"), F.lit(" ")).alias("c"))
    return sinks.tsv_lines(p).select(F.split("value", "\t", -1).alias("f"))


def _text(df: DataFrame) -> DataFrame:
    return df.select(F.array_join("f", "\t").alias("line"))


_L = "(SELECT CAST(line_no AS VARCHAR) AS a, coalesce(cui, '') AS b, replace(coalesce(preflabel, ''), chr(9), ' ') AS c FROM preferredlabels)"


@query(f"SELECT a || chr(9) || b || chr(9) || c AS line FROM {_L} WHERE regexp_matches(c, '[0-9]')")
def grep_lines(spark, d):
    return _text(rowops.grep(_lines(spark, d), "[0-9]", 2))


@query(f"SELECT a || chr(9) || b || chr(9) || c AS line FROM {_L} WHERE NOT regexp_matches(c, '[0-9]')")
def grep_lines_inverted(spark, d):
    return _text(rowops.grep(_lines(spark, d), "[0-9]", 2, invert=True))


@query(f"SELECT a || chr(9) || b || chr(9) || regexp_replace(c, '([a-z])-([a-z])', '\\1 \\2', 'g') AS line FROM {_L}")
def replace_column(spark, d):
    return _text(rowops.replace(_lines(spark, d), "([a-z])-([a-z])", "$1 $2", 2))


@query(f"SELECT a || chr(9) || 'en' || chr(9) || b || chr(9) || c AS line FROM {_L}")
def add_column(spark, d):
    return _text(rowops.add_column(_lines(spark, d), 1, "en"))


@query(f"SELECT c || chr(9) || a AS line FROM {_L}")
def field_subset(spark, d):
    return _text(rowops.fields(_lines(spark, d), [2, 0]))


@query()
def filter_literals(spark, d):
    return fl.filter_literals(table(spark, d, "mrconso").select("line_no", "str"), "str")


@query()
def normalize_labels(spark, d):
    return fl.normalize_labels(table(spark, d, "mrconso").select("line_no", "str"), "str")


# URIs ------------------------------------------------------------------------------------------------------------------------------


def _uris(spark, d) -> DataFrame:
    one = lambda c: F.concat(F.lit(uris.BASE), F.replace(c, F.lit(" "), F.lit("_")))
    return table(spark, d, "labelinfo").filter("pref is not null").select("line_no", F.concat(one("pref"), F.lit("|"), one("label")).alias("uri"))


_SHORT = "(SELECT line_no, replace(pref, ' ', '_') || '|' || replace(label, ' ', '_') AS uri FROM labelinfo WHERE pref IS NOT NULL)"


@query(f"SELECT * FROM {_SHORT}")
def uri_shorten(spark, d):
    return uris.map_items(_uris(spark, d), "uri", uris.shorten)


@query(f"SELECT line_no, 'http://dbpedia.org/resource/' || replace(uri, '|', '|http://dbpedia.org/resource/') AS uri FROM {_SHORT}")
def uri_expand(spark, d):
    return uris.map_items(uri_shorten(spark, d), "uri", uris.expand)


@query("SELECT sab AS prefix, count(DISTINCT code) AS n_distinct, count(*) AS n FROM mrconso GROUP BY 1")
def uri_prefix_counts(spark, d):
    return uris.prefix_counts(table(spark, d, "mrconso").select(F.concat_ws(":", "sab", F.coalesce("code", F.lit(""))).alias("u")), "u").orderBy("prefix")


_ENCODED = "url_encode(pref)"
for _c in "!$&'()*+,/:;=@":
    _ENCODED = f"replace({_ENCODED}, '%{ord(_c):02X}', '{_c.replace(chr(39), chr(39) * 2)}')"


@query(f"SELECT line_no, {_ENCODED} AS uri FROM labelinfo WHERE pref IS NOT NULL")
def uri_recode(spark, d):
    return uris.recode(table(spark, d, "labelinfo").select("line_no", F.col("pref").alias("uri")), "uri")


# Lookups ---------------------------------------------------------------------------------------------------------------------------

_MOVED = "(SELECT * FROM mrcui WHERE cui2 IS NOT NULL)"


def _moved(spark, d) -> DataFrame:
    return table(spark, d, "mrcui").filter("cui2 is not null")


def _refs(spark, d) -> DataFrame:
    return table(spark, d, "labelfreq").select("line_no", "label", "cui")


@query(f"SELECT f.line_no, f.label, m.cui2 AS cui FROM labelfreq f JOIN {_MOVED} m ON f.cui = m.cui1")
def lookup_replace(spark, d):
    return lookup.replace_column(_refs(spark, d), "cui", _moved(spark, d), "cui1", "cui2", "line_no")


@query(f"SELECT f.line_no, f.label, CASE WHEN m.cui1 IS NULL THEN f.cui ELSE m.cui2 END AS cui FROM labelfreq f LEFT JOIN {_MOVED} m ON f.cui = m.cui1")
def lookup_replace_keep(spark, d):
    return lookup.replace_column(_refs(spark, d), "cui", _moved(spark, d), "cui1", "cui2", "line_no", write_unchanged=True)


@query("SELECT line_no, label, cui FROM labelfreq WHERE cui IN (SELECT cui FROM mrconso WHERE cui IS NOT NULL)")
def lookup_filter_in(spark, d):
    return lookup.filter_by(_refs(spark, d), "cui", table(spark, d, "mrconso"), "cui", "line_no")


@query("SELECT line_no, label, cui FROM labelfreq f WHERE NOT EXISTS (SELECT 1 FROM mrconso m WHERE m.cui = f.cui)")
def lookup_filter_out(spark, d):
    return lookup.filter_by(_refs(spark, d), "cui", table(spark, d, "mrconso"), "cui", "line_no", missing=True)


_FIRST = f"(SELECT cui1, min_by(cui2, line_no) AS cui2 FROM {_MOVED} GROUP BY 1)"


@query(f"SELECT f.line_no, f.label, coalesce(m.cui2, f.cui) AS cui, CASE WHEN m.cui2 IS NULL THEN 'nonredir' ELSE 'redir' END AS info FROM labelfreq f LEFT JOIN {_FIRST} m ON f.cui = m.cui1")
def redirect_replace(spark, d):
    return lookup.redirects(_refs(spark, d), "cui", _moved(spark, d), "cui1", "cui2", "line_no", "line_no")


@query(
    "SELECT l_orderkey, l_linenumber, CASE WHEN p.b IS NULL THEN l.k ELSE p.b END AS k, CASE WHEN p.b IS NULL THEN 'nonredir' ELSE 'redir' END AS info FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS k FROM lineitem) l "
    "LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS a, min_by(p_brand, p_partkey) AS b FROM part GROUP BY 1) p ON l.k = p.a"
)
def redirect_replace_large(spark, d):
    """Redirects over the largest table: the lookup whose rate is compared."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("k"))
    moved = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("a"), F.col("p_brand").alias("b"), F.col("p_partkey").alias("n"))
    return lookup.redirects(rows, "k", moved, "a", "b", "n", "l_orderkey")


@query("SELECT l_orderkey, l_linenumber, p_brand AS k FROM lineitem JOIN part ON l_partkey = p_partkey")
def lookup_replace_large(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("k"))
    return lookup.replace_column(rows, "k", table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("a"), F.col("p_brand").alias("b")), "a", "b", "l_orderkey")


@query(f"SELECT line_no, label, cui, 'nonredir' AS info FROM labelfreq UNION ALL SELECT f.line_no, f.label, m.cui2, 'redir' FROM labelfreq f JOIN {_FIRST} m ON f.cui = m.cui1")
def redirect_add(spark, d):
    return lookup.redirects(_refs(spark, d), "cui", _moved(spark, d), "cui1", "cui2", "line_no", "line_no", add=True)


@query(f"SELECT f.line_no, f.label, coalesce(m.cui2, f.cui) AS cui, CASE WHEN m.cui2 IS NULL THEN 'nodisamb' ELSE 'disamb' END AS info FROM labelfreq f LEFT JOIN {_MOVED} m ON f.cui = m.cui1")
def disambiguate(spark, d):
    return lookup.disambiguations(_refs(spark, d), "cui", _moved(spark, d), "cui1", "cui2", "line_no")


@query(
    "SELECT c.line_no, c.cui, CASE WHEN u.cui IS NULL THEN c.prob ELSE u.norm END AS prob FROM pagerank c LEFT JOIN (SELECT cui, arg_max(CASE WHEN norm IS NULL THEN [] ELSE [norm] END, line_no)[1] AS norm FROM cuifreq WHERE cui IS NOT NULL GROUP BY 1) u ON c.cui = u.cui"
)
def update_by_key(spark, d):
    return lookup.update_by_key(table(spark, d, "pagerank").select("line_no", "cui", "prob"), "cui", "prob", table(spark, d, "cuifreq"), "cui", "norm", "line_no", "line_no")


@query("SELECT cui, label, line_no FROM (SELECT cui, label, line_no, row_number() OVER (PARTITION BY cui ORDER BY line_no) AS rn FROM labelinfo) WHERE rn = 1")
def keep_first(spark, d):
    return sinks.keep_first(table(spark, d, "labelinfo").select("cui", "label", "line_no"), ["cui"], "line_no")


@query("SELECT cui, label, line_no FROM (SELECT cui, label, line_no, row_number() OVER (PARTITION BY cui ORDER BY line_no DESC) AS rn FROM labelinfo) WHERE rn = 1")
def keep_last(spark, d):
    return sinks.keep_last(table(spark, d, "labelinfo").select("cui", "label", "line_no"), ["cui"], "line_no")


@query("SELECT a AS line_no, b AS cui, c AS label FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY CAST(a AS BIGINT)) AS rn FROM " + _L + ") WHERE rn = 1")
def import_first(spark, d):
    """Field projection and the first row per key, as inserting under a primary key does."""
    rows = _lines(spark, d).withColumn("n", F.get("f", F.lit(0)).cast("long"))
    return sinks.import_rows(rows, {"line_no": 0, "cui": 1, "label": 2}, ["cui"], "n")[0].select("line_no", "cui", "label")


# Sources and sinks ------------------------------------------------------------------------------------------------------------------


def _place(spark) -> str:
    return shared_path(spark, "files")


_MRCONSO = "cui lat ts lui stt sui ispref aui saui scui sdui sab tty code str srl suppress cvf".split()


@query("SELECT " + ", ".join(c if c in ("srl", "cvf") else f"nullif({c}, '') AS {c}" for c in _MRCONSO) + " FROM mrconso")
def rrf_scan(spark, d):
    """Atoms written as a release file and read back."""
    at = _place(spark)
    table(spark, d, "mrconso").select(F.concat(*[F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|")) for c in _MRCONSO]).alias("value")).write.text(at)
    return readers.read_rrf(spark, at, "MRCONSO")


@query("SELECT CAST(line_no AS VARCHAR) AS a, coalesce(label, '') AS b, coalesce(CAST(cnt AS VARCHAR), '') AS c FROM labelfreq")
def tsv_gz_scan(spark, d):
    """Tab-separated lines written with gzip and read back as fields."""
    at = _place(spark)
    sinks.write_tsv(table(spark, d, "labelfreq").select("line_no", F.replace("label", F.lit("\t"), F.lit(" ")).alias("label"), "cnt"), at, gz=True)
    return readers.read_fields(spark, at).select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate("abc")])


_SQL["tsv_gz_scan"] = _SQL["tsv_gz_scan"].replace("coalesce(label, '')", "replace(coalesce(label, ''), chr(9), ' ')")


@query("SELECT tui AS col, sty AS des, CAST(NULL AS VARCHAR) AS ref, 1 AS min, CAST(2.5 AS DECIMAL(5, 2)) AS av, 3 AS max, 'MRSTY.RRF' AS fil, CAST(NULL AS VARCHAR) AS dty FROM semtypes")
def mrcols_scan(spark, d):
    """A column list written as a release file and read back with its numbers."""
    at = _place(spark)
    table(spark, d, "semtypes").select(F.concat_ws("|", "tui", "sty", F.lit(""), F.lit("1"), F.lit("2.50"), F.lit("3"), F.lit("MRSTY.RRF"), F.lit(""), F.lit("")).alias("value")).write.text(at)
    return readers.read_rrf(spark, at, "MRCOLS")


def _quoted(c: str, q: str, more: str = ""):
    return F.concat(F.lit(q), F.replace(F.coalesce(c, F.lit("-")), F.lit(q), F.lit("")), F.lit(more + q))


@query("SELECT replace(coalesce(label, '-'), '\"', '') || chr(9) || 'x' AS label, cnt FROM labelfreq")
def quoted_tsv_scan(spark, d):
    """Tab-separated with quotes, which may hold tabs."""
    at = _place(spark)
    table(spark, d, "labelfreq").select(F.concat(_quoted("label", '"', "\tx"), F.lit("\t"), F.coalesce(F.col("cnt").cast("string"), F.lit(""))).alias("value")).write.text(at)
    return readers.read_tsv(spark, at, "label string, cnt int")


@query("SELECT replace(coalesce(label, '-'), '\"', '') || '|x' AS label, cnt FROM labelfreq")
def quoted_pipe_scan(spark, d):
    """Pipe-separated with quotes, which may hold pipes."""
    at = _place(spark)
    table(spark, d, "labelfreq").select(F.concat(_quoted("label", '"', "|x"), F.lit("|"), F.coalesce(F.col("cnt").cast("string"), F.lit(""))).alias("value")).write.text(at)
    return readers.read_pipe(spark, at, "label string, cnt int")


@query("SELECT tui, replace(sty, chr(39), '') AS sty FROM semtypes")
def quoted_csv_scan(spark, d):
    """Comma-separated with single quotes, which may hold commas."""
    at = _place(spark)
    table(spark, d, "semtypes").select(F.concat(F.col("tui"), F.lit(","), _quoted("sty", "'")).alias("value")).write.text(at)
    return readers.read_quoted_csv(spark, at, "tui string, sty string")


@query(
    "SELECT 'http://x/' || tui AS subj, 'http://x/label' AS pred, sty AS obj, 'en' AS lang, '' AS datatype FROM semtypes UNION ALL "
    "SELECT 'http://x/' || tui, 'http://x/size', CAST(length(sty) AS VARCHAR), '', 'http://www.w3.org/2001/XMLSchema#integer' FROM semtypes"
)
def turtle_scan(spark, d):
    """Types as Turtle with a prefix and lists of predicates, read back as triples."""
    at = _place(spark)
    line = F.concat(F.lit("@prefix x: <http://x/> . x:"), F.col("tui"), F.lit(' x:label "'), F.col("sty"), F.lit('"@en ; x:size '), F.length("sty").cast("string"), F.lit(" ."))
    table(spark, d, "semtypes").select(line.alias("value")).write.text(at)
    return readers.read_turtle(spark, at).drop("_corrupt")


def _write_xml(rows: DataFrame, root: str, at: str) -> None:
    """Rows (``value``) as one document under ``root``, as dumps and ontologies are one document."""
    ends = rows.sparkSession.createDataFrame([(0, f"<{root}>"), (2, f"</{root}>")], "n int, value string")
    rows.withColumn("n", F.lit(1)).select("n", "value").unionByName(ends).coalesce(1).sortWithinPartitions("n").select("value").write.text(at)


def _wiki(spark, d, most: int | None = None) -> DataFrame:
    """Labels as pages of a dump: every third is a talk page, every fifth a redirect."""
    at, n = _place(spark), F.col("line_no")
    text = F.regexp_replace(F.when(n % 5 == 0, F.concat(F.lit("#REDIRECT "), "label")).otherwise(F.col("label")), "[&<>]", " ")
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>"))
    revision = tag("revision", F.concat(tag("id", n * 2), tag("timestamp", F.lit("2016")), tag("text", text)))
    page = tag("page", F.concat(tag("title", F.lit("t")), tag("ns", F.when(n % 3 == 0, 1).otherwise(0)), tag("id", n), revision))
    _write_xml(table(spark, d, "labelinfo_json").filter("label is not null").select(page.alias("value")), "mediawiki", at)
    return readers.read_wiki(spark, at, most).select("id", "rev_id", "text")


_PAGES = "(SELECT CAST(line_no AS VARCHAR) AS id, CAST(line_no * 2 AS VARCHAR) AS rev_id, trim(regexp_replace(label, '[&<>]', ' ', 'g')) AS text FROM labelinfo_json WHERE line_no % 3 <> 0 AND line_no % 5 <> 0 AND label IS NOT NULL)"


@query(f"SELECT * FROM {_PAGES} WHERE text <> ''")
def wiki_scan(spark, d):
    return _wiki(spark, d)


@query(f"SELECT * FROM {_PAGES} WHERE text <> '' ORDER BY CAST(id AS BIGINT) LIMIT 100")
def wiki_first_documents(spark, d):
    """The option that reads the first so many documents."""
    return _wiki(spark, d, 100)


@query("SELECT DISTINCT 'c' || p_size AS a, 'c' || p_size // 2 AS b, 'sub' AS edge FROM part WHERE p_size > 1 UNION ALL SELECT DISTINCT 'c' || p_size, p_brand, 'same' FROM part")
def ontology_scan(spark, d):
    """Sizes as classes of an RDF/XML ontology, each below its half, with brands as equivalent names."""
    at = _place(spark)
    res = lambda tag, c: F.concat(F.lit(f'<{tag} rdf:resource="'), c, F.lit('"/>'))
    name = lambda e: F.concat(F.lit("c"), F.expr(e).cast("string"))
    body = F.concat(F.when(F.col("p_size") > 1, res("rdfs:subClassOf", name("p_size div 2"))).otherwise(""), res("owl:equivalentClass", F.col("p_brand")))
    head = F.concat(F.lit('<owl:Class xmlns:owl="o" xmlns:rdf="r" xmlns:rdfs="s" rdf:about="'), name("p_size"), F.lit('">'))
    _write_xml(table(spark, d, "part").select("p_size", "p_brand").distinct().select(F.concat(head, body, F.lit("</owl:Class>")).alias("value")), "ontology", at)
    sub, same = readers.read_ontology(spark, at)
    return sub.distinct().withColumn("edge", F.lit("sub")).unionByName(same.distinct().withColumn("edge", F.lit("same")))


@query("SELECT * FROM (VALUES " + ", ".join(str(row) for row in schemas.LANGUAGES) + ") v(iso6391, iso6393, umlslabel)")
def languages_table(spark, d):
    return readers.languages(spark)


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL")
def unescape_import(spark, d):
    """Texts escaped into lines, and imported with the escapes undone."""
    lines = sinks.tsv_lines(table(spark, d, "documents").filter("text is not null").select("doc_id", sinks.escape_tabs(F.col("text")).alias("t")))
    f = lines.select(F.split("value", "\t", -1).alias("f"))
    return f.select(F.get("f", F.lit(0)).cast("long").alias("doc_id"), sinks.unescape_tabs(F.get("f", F.lit(1))).alias("text"))


@query("SELECT a AS line_no, b AS cui, c AS label FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY CAST(a AS BIGINT) DESC) AS rn FROM " + _L + ") WHERE rn = 1")
def import_last(spark, d):
    """The last row per key, as merging row by row leaves."""
    rows = _lines(spark, d).withColumn("n", F.get("f", F.lit(0)).cast("long"))
    return sinks.import_rows(rows, {"line_no": 0, "cui": 1, "label": 2}, ["cui"], "n", last_wins=True)[0].select("line_no", "cui", "label")


@query("SELECT cui, cnt FROM cuifreq")
def replaced_table(spark, d):
    """A table created, and replaced by another."""
    at = _place(spark)
    sinks.write_table(table(spark, d, "labelfreq"), at)
    sinks.write_table(table(spark, d, "cuifreq").select("cui", "cnt"), at)
    return spark.read.parquet(at)


@query(f"SELECT count(*) AS lines, CAST(count_if(regexp_matches(c, '[0-9]')) AS BIGINT) AS digits, CAST(count_if(b = '') AS BIGINT) AS blank FROM {_L}")
def run_counters(spark, d):
    """Counters that are filled while the lines pass."""
    df, seen = rowops.observed(_lines(spark, d), "lines", digits=F.get("f", F.lit(2)).rlike("[0-9]"), blank=F.get("f", F.lit(1)) == "")
    df.write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(got["lines"], got["digits"], got["blank"])], "lines long, digits long, blank long")


@query("SELECT line_no, CAST(cnt AS VARCHAR) AS n, CAST(to_json('x' || label) AS VARCHAR) AS s FROM labelfreq WHERE label IS NOT NULL AND cnt IS NOT NULL")
def untyped_json(spark, d):
    """Fields without types as JSON: numbers bare, others quoted."""
    t = table(spark, d, "labelfreq").filter("label is not null and cnt is not null")
    return t.select("line_no", candidates.scalar(F.col("cnt").cast("string")).alias("n"), candidates.scalar(F.concat(F.lit("x"), "label")).alias("s"))


@query("SELECT 'KCX' AS styclass, sty FROM semtypes WHERE tui <= 'T441' UNION ALL SELECT 'BMH', sty FROM semtypes")
def semantic_group_list(spark, d):
    """The group list as text, with headers and comments, parsed."""
    lines = ["# groups"]
    for g in ("KCX", "BMH"):
        own = groups(spark, d).filter(F.col("styclass") == g).orderBy("sty").collect()  # a fixed table
        lines += [f"{g}:", *[f"'{r['sty']}'" for r in own], "", "# end"]
    return readers.semantic_groups(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string"))


@query("SELECT 'http://x/' || line_no AS subj, 'http://x/label' AS pred, replace(label, chr(9), ' ') AS obj, 'en' AS lang, '' AS datatype FROM labelinfo WHERE label IS NOT NULL UNION ALL SELECT 'http://x/' || line_no, 'http://x/freq', CAST(crislabelcuifreq AS VARCHAR), '', 'http://www.w3.org/2001/XMLSchema#integer' FROM labelinfo WHERE crislabelcuifreq IS NOT NULL")
def ntriples_scan(spark, d):
    """Label info as N-Triples lines, parsed."""
    li = table(spark, d, "labelinfo")
    quoted = F.replace(F.replace(F.replace("label", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\t"), F.lit("\\t"))
    head = lambda p: F.concat(F.lit("<http://x/"), F.col("line_no").cast("string"), F.lit(f"> <http://x/{p}> "))
    a = li.filter("label is not null").select(F.concat(head("label"), F.lit('"'), quoted, F.lit('"@en .')).alias("value"))
    b = li.filter("crislabelcuifreq is not null").select(F.concat(head("freq"), F.lit('"'), F.col("crislabelcuifreq").cast("string"), F.lit('"^^<http://www.w3.org/2001/XMLSchema#integer> .')).alias("value"))
    return readers.triples(a.unionByName(b)).drop("_corrupt")


@query("SELECT label, lang, crislabelcuifreq AS n FROM labelinfo CROSS JOIN (VALUES ('de'), ('en')) v(lang)")
def per_language_copies(spark, d):
    at = _place(spark)
    sinks.write_per_language(table(spark, d, "labelinfo").select("label", F.col("crislabelcuifreq").alias("n")), at, ["de", "en"])
    return spark.read.parquet(at).select("label", "lang", "n")


@query("SELECT line_no, cui, score, max(score) OVER (PARTITION BY cui) AS best FROM preferredlabels WHERE cui IS NOT NULL")
def group_max(spark, d):
    return labels.with_group_max(table(spark, d, "preferredlabels").filter("cui is not null").select("line_no", "cui", "score"), ["cui"], "score", "best", "line_no")


@query(
    "WITH RECURSIVE m AS (SELECT cui1 AS a, min(cui2) AS b FROM mrcui WHERE cui2 IS NOT NULL GROUP BY 1), c AS (SELECT a, b FROM m UNION SELECT c.a, m.b FROM c JOIN m ON c.b = m.a), "
    "e AS (SELECT c.a, coalesce(min(CASE WHEN m.a IS NULL THEN c.b END), min(l.b)) AS b FROM c LEFT JOIN m ON c.b = m.a LEFT JOIN c l ON l.a = l.b AND l.b = c.b GROUP BY 1), "
    "x AS (SELECT line_no, label, trim(cui) AS k FROM labelfreq WHERE trim(coalesce(cui, '')) <> ''), y AS (SELECT line_no, label, coalesce(b, k) AS k FROM x LEFT JOIN e ON k = a) "
    "SELECT line_no, label, CASE WHEN k IN (SELECT cui1 FROM mrcui WHERE rel = 'DEL') THEN '' ELSE k END AS cui FROM y WHERE NOT contains(k, '\\u')"
)
def uri_canonical(spark, d):
    """References moved to the end of their chain of redirects; concepts that have no canonical form are left empty."""
    moved = lookup.closed_redirects(_moved(spark, d).select(F.col("cui1").alias("from_uri"), F.col("cui2").alias("to_uri")))
    gone = table(spark, d, "mrcui").filter("rel = 'DEL'").select(F.col("cui1").alias("from_uri"))
    return uris.canonical(_refs(spark, d), "cui", redirects=moved, disambiguations=gone, unique="line_no")


@query(
    "WITH RECURSIVE sub AS (SELECT DISTINCT 'dbpo:' || p_size AS a, 'dbpo:' || (p_size // 2) AS b FROM part WHERE p_size > 1), same AS (SELECT p_brand AS a, min('dbpo:' || p_size) AS b FROM part GROUP BY 1), eq AS (SELECT a, b FROM same UNION SELECT b, a FROM same), "
    "own AS (SELECT c, c AS e FROM (SELECT a AS c FROM sub UNION SELECT b FROM sub UNION SELECT a FROM eq) UNION SELECT a, b FROM eq), i AS (SELECT * FROM (VALUES (0, 'dbpo:2'), (1, 'dbpo:3')) v(k, v)), "
    "canon AS (SELECT * FROM (SELECT c, coalesce(arg_min(i.v, i.k), min(CASE WHEN starts_with(e, 'dbpo:') THEN e END)) AS u FROM own LEFT JOIN i ON e = i.v AND e <> c GROUP BY c) WHERE u IS NOT NULL), "
    "up AS (SELECT a, b FROM sub UNION SELECT up.a, sub.b FROM up JOIN sub ON up.b = sub.a), above AS (SELECT DISTINCT up.a AS c, canon.u AS bu FROM up JOIN canon ON up.b = canon.c WHERE up.a <> up.b), "
    "firsts AS (SELECT c, arg_min(i.v, i.k) AS v FROM (SELECT c, u AS bu FROM canon UNION SELECT c, bu FROM above) LEFT JOIN i ON bu = i.v GROUP BY c) "
    "SELECT 'map:hasCanonicalUri' AS property, c AS orig, u AS mapped FROM canon UNION SELECT 'map:hasInterestingClass', u, coalesce(v, 'owl:Thing') FROM canon JOIN firsts USING (c) "
    "UNION SELECT 'map:hasSuperClass', u, bu FROM canon JOIN above USING (c) WHERE u <> bu UNION SELECT 'map:hasSuperClass', u, 'owl:Thing' FROM canon"
)
def ontology_mapping(spark, d):
    """The size tree as an ontology: every size is a class below its half; brands are equivalent names."""
    name = lambda c: F.concat(F.lit("dbpo:"), F.col(c).cast("string"))
    part = table(spark, d, "part")
    sub = part.filter("p_size > 1").select(name("p_size").alias("a"), F.concat(F.lit("dbpo:"), F.expr("p_size div 2").cast("string")).alias("b")).distinct()
    same = part.select(F.col("p_brand").alias("a"), name("p_size").alias("b")).groupBy("a").agg(F.min("b").alias("b"))
    return classes.ontology_mapping(sub, same, interesting=("dbpo:2", "dbpo:3"))


# Folds -----------------------------------------------------------------------------------------------------------------------------


@query(
    "SELECT label, cui, list_reduce(list(w ORDER BY line_no), lambda acc, v: CASE WHEN contains(acc, v) THEN acc ELSE acc || '|' || v END) AS writer, list_reduce(list(r ORDER BY line_no), lambda acc, v: CASE WHEN contains(acc, v) THEN acc ELSE acc || '|' || v END) AS release "
    "FROM (SELECT label, cui, line_no, coalesce(corpus, '') AS w, coalesce(umlsversion, '') AS r FROM labelfreq) GROUP BY 1, 2"
)
def label_uri_info_merge(spark, d):
    lf = table(spark, d, "labelfreq").select("label", "cui", "line_no", F.col("corpus").alias("writer"), F.col("umlsversion").alias("release"))
    return classes.merge_label_info(lf, ["label", "cui"], ["writer", "release"], "line_no")


_FOLD = (
    "WITH RECURSIVE h AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS a, CAST(p_size // 2 AS VARCHAR) AS b FROM part WHERE p_size > 1), up AS (SELECT a, b FROM h UNION SELECT up.a, h.b FROM up JOIN h ON up.b = h.a), "
    "x AS (SELECT p_brand AS uri, c, CASE WHEN c <= '3' THEN c ELSE '' END AS w, row_number() OVER (PARTITION BY p_brand ORDER BY min(p_partkey), c) AS i FROM (SELECT p_brand, p_partkey, CAST(p_size AS VARCHAR) AS c FROM part) GROUP BY p_brand, c), "
    "y AS (SELECT x.*, coalesce(u.l, []) AS above, coalesce(v.l, []) AS below FROM x LEFT JOIN (SELECT a, list(b) AS l FROM up GROUP BY 1) u ON u.a = c LEFT JOIN (SELECT b, list(a) AS l FROM up GROUP BY 1) v ON v.b = c), "
    "f AS (SELECT uri, i, [c] AS s, CASE WHEN w = '' THEN CAST([] AS VARCHAR[]) ELSE [w] END AS t FROM y WHERE i = 1 UNION ALL "
    "SELECT uri, i, CASE WHEN p = 0 THEN list_append(s, c) WHEN stay THEN s ELSE list_concat(list_append(s[1:p - 1], c), s[p + 1:]) END, CASE WHEN stay OR w = '' OR list_contains(t, w) THEN t ELSE list_append(t, w) END FROM "
    "(SELECT q.*, p > 0 AND (s[p] = c OR list_contains(below, s[p])) AS stay FROM (SELECT f.uri, y.i, f.s, f.t, y.c, y.w, y.below, "
    "coalesce(list_position(list_transform(f.s, lambda e: e = y.c OR list_contains(y.below, e) OR list_contains(y.above, e)), true), 0) AS p FROM f JOIN y ON f.uri = y.uri AND y.i = f.i + 1) q)) "
    "SELECT uri, array_to_string(arg_max(s, i), '|') AS specific, array_to_string(arg_max(t, i), '|') AS interesting FROM f GROUP BY uri"
)


@query(_FOLD)
def specific_class_fold(spark, d):
    """Sizes as classes, each below its half: every brand keeps its most specific sizes, in the order of its parts."""
    part = _brands(table(spark, d, "part"))
    return classes.specific_classes(part, *_sizes(spark, d))


def _brands(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_brand").alias("uri"), F.col("p_size").cast("string").alias("cls"), F.col("p_partkey").alias("line_no"))


def _sizes(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Canonical, interesting and superclasses of the sizes."""
    up = superclass_closure(spark, d).select(F.col("a").cast("string").alias("cls"), F.col("b").cast("string").alias("to"))
    own = _brands(table(spark, d, "part")).select("cls").distinct().select("cls", F.col("cls").alias("to"))
    return own, own.select("cls", F.when(F.col("cls") <= "3", F.col("cls")).otherwise(classes.THING).alias("to")), up


@query(_FOLD)
def stream_class_fold(spark, d):
    """The class fold on a stream of parts."""
    rows = _brands(spark.readStream.schema(table(spark, d, "part").schema).parquet(f"{d}/part.parquet*"))
    at = shared_path(spark, "stream")
    return keyed.drained(keyed.running_classes(rows, *_sizes(spark, d), "uri", "cls", "line_no"), f"{at}/out", f"{at}/state", ["uri"])


@query("SELECT label AS mention, count(*) AS total, CAST(sum(CASE WHEN coalesce(cui, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS links, sum(CASE WHEN coalesce(cui, '') <> '' THEN 1 ELSE 0 END) / count(*) AS linkprop FROM labelfreq GROUP BY 1")
def stream_mention_counts(spark, d):
    src = table(spark, d, "labelfreq")
    rows = spark.readStream.schema(src.schema).parquet(f"{d}/labelfreq.parquet*").select(F.col("label").alias("mention"), F.col("cui").alias("anchor"))
    at = shared_path(spark, "stream")
    return keyed.drained(keyed.running_mention_counts(rows), f"{at}/out", f"{at}/state", ["mention"])


@query(_SQL["label_uri_info_merge"].replace(" AS writer", " AS v0").replace(" AS release", " AS v1").replace("SELECT label, cui, list_reduce", "SELECT label, cui AS uri, '' AS v2, list_reduce"))
def stream_label_uri_merge(spark, d):
    src = table(spark, d, "labelfreq")
    rows = spark.readStream.schema(src.schema).parquet(f"{d}/labelfreq.parquet*").withColumn("none", F.lit(""))
    at = shared_path(spark, "stream")
    return keyed.drained(keyed.running_merge(rows, "label", "cui", ["corpus", "umlsversion", "none"], "line_no"), f"{at}/out", f"{at}/state", ["label", "uri"])
