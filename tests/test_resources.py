"""Resource operators on hand-made rows: edge cases and quirks."""

import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from termweave.functions import labels as fl
from termweave.functions import uris
from termweave.operators import candidates, classes, concepts, freq, graph, labels, lookup, rowops
from termweave.plans import pipelines, script
from termweave.sources import readers, schemas, sinks

ATOM = "cui string, ispref string, str string, sab string"


def test_label_score(spark):
    cases = {"DNA": 9, "Aspirin": 11, "aspirin": 10, "a-1": 3, "Aspirin tab": 11, "Aspirin tab xx": 10, "x" * 12: 10, "x" * 13: 9, "x" * 100: 3, "1234567": -11, "É": 8, "": 8}
    df = spark.createDataFrame([(k, "N") for k in cases], "s string, p string").select("s", labels.label_score(F.col("s"), F.col("p")).alias("v"), labels.label_score(F.col("s"), F.lit("Y")).alias("y"))
    got = {r.s: r.v for r in df.collect()}
    assert got == cases
    assert all(r.y == r.v + 20 for r in df.collect())


def test_preferred(spark, rows):
    atoms = spark.createDataFrame([("C1", "Y", "Fever", "A"), ("C1", "Y", "Chill", "A"), ("C1", "Y", "Chill", "B"), ("C1", "N", "x", "A"), ("C2", "Y", "a" * 120, None), ("C3", None, None, "A")], ATOM)
    assert rows(labels.preferred(atoms.filter("str is not null"))) == [("C1", "Chill"), ("C2", "a" * 100)]
    best = labels.best_labels(labels.scored_labels(atoms.filter("str is not null")))
    assert rows(best.filter("cui = 'C1'").select("preflabel", "score", "maxscore", "minlen", "vocabcount", "vocabs")) == [("Chill", 30, 30, 5, 2, "A,B"), ("Fever", 30, 30, 5, 1, "A")]
    assert {r.preflabel for r in best.filter("cui = 'C1'").collect()} == {"Chill", "Fever"}
    assert labels.preferred(atoms.limit(0)).count() == 0


def test_concept_and_label_info(spark, rows):
    types = spark.createDataFrame([("C1", "T1", "S1"), ("C1", "T2", "S2"), ("C2", "T3", "S3")], "cui string, tui string, sty string")
    groups = spark.createDataFrame([("G", "S1"), ("G", "S2"), ("H", "S3")], "styclass string, sty string")
    atoms = spark.createDataFrame([("C1", "Y", "DNA", "A"), ("C1", "N", "DNA", "B"), ("C1", "N", "Hiv", "A"), ("C1", "N", "hiv", "B"), ("C1", "N", "HIV test", "A"), ("C1", "N", "x" * 100, "A"), ("C2", "N", "no", "A")], ATOM)
    nums = spark.createDataFrame([("C1", 5, 0.5)], "cui string, cnt int, norm double")
    info = concepts.concept_info(concepts.selected_types(types, groups, "G"), atoms, nums, spark.createDataFrame([], "cui string, prob double"))
    assert [tuple(r) for r in info.collect()] == [("C1", "T1,T2", "S1,S2", "DNA", "A,B", 12, 5, 0.5, None)]
    lf = spark.createDataFrame([("hiv", "C1", 3, 0.3), ("dna", "C1", 9, 0.9)], "label string, cui string, cnt int, norm double")
    got = rows(concepts.label_info(atoms, info, lf).select("label", "labelvocabs", "crislabelcuifreq"))
    # a case variant without frequency and the lower-case one with it stay apart; a frequency never meets another case
    assert got == [("DNA", "A,B", None), ("hiv", "A", None), ("hiv", "B", 3), ("hiv test", "A", None)]


LABEL = "label string, cui string, stys string, tuis string, pref string, labelvocabs string, cuivocabs string, crislabelcuifreq int, crislabelcuinorm double, criscuifreq int, criscuinorm double, pagerank double"


def test_candidates_json(spark):
    row = ("S", "T", "P", "A", "A", None, 0.5, 1, 1e-7, None)
    df = spark.createDataFrame([("123", "C2", *row), ("123", "C1", *row), ('q"\\', "C1", *row)], LABEL)
    got = {r.label: json.loads(r.info) for r in candidates.label_candidates(df).collect()}
    assert [c["inst"] for c in got["123"]] == ["C1", "C2"] and got["123"][0]["scPageRank"] is None and got['q"\\'][0]["label"] == 'q"\\' and got["123"][0]["scCRISCUINorm"] == 1e-7
    compat = {r.label: json.loads(r.info) for r in candidates.label_candidates(df, compat=True).collect()}
    assert compat["123"][0]["scPageRank"] == "null"
    assert candidates.read_candidates(candidates.label_candidates(df)).count() == 3


def test_json_limit(spark):
    df = spark.createDataFrame([("a", 1, "x" * n) for n in (10,)] + [("b", i, "y" * 20) for i in range(3)], "k string, o int, j string")
    whole = {r.k: r.info for r in candidates.json_per_key(df, "k", F.col("j"), ["o"], None).collect()}
    assert {k: len(v) for k, v in whole.items()} == {"a": 12, "b": 64}
    assert [r.k for r in candidates.json_per_key(df, "k", F.col("j"), ["o"], 64).collect()] == ["a"]
    assert {r.k for r in candidates.json_per_key(df, "k", F.col("j"), ["o"], 65).collect()} == {"a", "b"}


def test_scalar_sniff(spark):
    cases = {"123": "123", "1e5": "100000.0", "NaN": '"NaN"', "1d": "1.0", " 12 ": "12.0", "null": '"null"', "abc": '"abc"', "-7": "-7", "99999999999": "9.9999999999E10", 'a"b': '"a\\"b"', "": '""'}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r.s: r.j for r in df.select("s", candidates.scalar(F.col("s")).alias("j")).collect()} == cases


def test_frequencies(spark, rows):
    m = spark.createDataFrame([("A", "x", "C1", "r"), ("a", "", "C1", "r"), ("a", None, None, "r1"), ('q"', "y", "<SPURIOUS>", "r"), ('q"', "y", "C2", "r")], "mention string, anchor string, cui string, readable string")
    assert rows(freq.mention_counts(m)) == [("A", 1, 1, 1.0), ("a", 2, 0, 0.0), ('q"', 2, 2, 1.0)]
    assert rows(freq.mention_counts(m, ignore_case=True)) == [("a", 3, 1, 1 / 3), ('q"', 2, 2, 1.0)]
    assert rows(freq.concept_freq(m)) == [("<SPURIOUS>", 1, 0.2), ("C1", 2, 0.4), ("C2", 1, 0.2), ("r1", 1, 0.2)]
    assert rows(freq.label_concept_freq(m)) == [("a", "C1", 2, 2 / 3), ("a", "r1", 1, 1 / 3), ("q'", "C2", 1, 0.5)]
    c = freq.commonness(spark.createDataFrame([("l" * 1500, "u"), ("l" * 1200, "u"), ("k", "u")], "label string, uri string")).collect()
    assert sorted((len(r.label), r.freq, r.rel_by_label, round(r.rel_by_uri, 3)) for r in c) == [(1, 1, 1.0, 0.333), (1000, 2, 1.0, 0.667)]


def test_row_operators(spark):
    df = spark.createDataFrame([(["a", "b1", ""],), (["x"],), ([""],)], "f array<string>")
    t = lambda d: ["\t".join(r.f) for r in d.collect()]
    assert t(rowops.grep(df, "[0-9]", 1)) == ["a\tb1\t"] and t(rowops.grep(df, "[0-9]", 1, invert=True)) == [] and t(rowops.grep(df, "^$")) == [""]
    assert t(rowops.grep(df, "z", 0, invert=True)) == ["a\tb1\t", "x", ""]
    assert t(rowops.replace(df, "([ab])", "<$1>", 0)) == ["<a>\tb1\t", "x", ""] and t(rowops.replace(df, "\t", "|")) == ["a|b1|", "x", ""]
    assert t(rowops.add_column(df, 0, "N")) == ["N\ta\tb1\t", "N\tx", "N"] and t(rowops.add_column(df, 9, "N")) == ["a\tb1\t\tN", "x\tN", "N"] and t(rowops.add_column(df, 1, "N")) == ["a\tN\tb1\t", "x\tN", "N"]
    assert [r.f for r in rowops.fields(df, [1, 0]).collect()] == [["b1", "a"], [None, "x"], [None, ""]]
    big = spark.createDataFrame([("x" * 65_535,), ("x" * 65_536,), (("x" * 40_000 + "\n") * 2,), (None,)], "info string")
    assert sorted(len(r.info) for r in rowops.smaller_than(big, "info").collect()) == [65_535, 80_002]
    out, seen = rowops.observed(spark.range(10), "run", even=F.col("id") % 2 == 0)
    out.count()
    assert seen.get == {"lines": 10, "even": 5}


def test_filter_literals(spark):
    cases = {"a-b": "a-b", " - x": "x", "b4r word": "word", "?!,": None, "x, y": "x y", "\tpad ": "pad", "a  b": "a b", "é-ü": "é-ü", "": None, "12": None}
    df = spark.createDataFrame([(k, k) for k in cases] + [("n", None)], "k string, s string")
    assert {r.k: r.s for r in fl.filter_literals(df, "s").collect()} == {k: v for k, v in cases.items() if v}


def normal(label):
    """Brute force of the label rules."""
    s = unicodedata.normalize("NFKC", label)
    pat, info = re.compile(r"[ \t\n\r\f\v]*\([ \t\n\r\f\v]*([^)]+)[ \t\n\r\f\v]*\)[ \t\n\r\f\v]*$"), "NONE"
    if m := pat.search(s):
        info, s = m[1], pat.sub("", s)
    trim = "".join(map(chr, range(33)))
    s = s.strip(trim)
    s = (s[:-1] if s.endswith(",") else s).strip(trim).replace("&quot;", '"')
    s = re.sub("''(.+)''", r"\1", re.sub('"(.+)"', r"\1", s))
    if not (1 < len(s) <= 50 and re.search(r"[^\W\d_]", s)):
        return []
    low = s.lower()
    out = []
    if re.search("[üöä]", low):
        out.append(low.replace("ä", "ae").replace("ö", "oe").replace("ü", "ue"))
    plain = unicodedata.normalize("NFKC", "".join(c for c in unicodedata.normalize("NFD", low) if not "̀" <= c <= "ͯ"))
    return [(x, s, info) for x in [*out, *([plain] if plain != low else []), low]]


def test_normalize_labels(spark):
    cases = ["Foo (bar)", "Foo (a) (b)", "Foo,", " Foo , ", "&quot;x y&quot;", "''xy''", "Été", "Übung", "Äöü É", "a", "x" * 50, "x" * 51, "1234", "ＦＵＬＬ ｗｉｄｔｈ", "", "(only)", "Ǆ", 'say "hi" now', "ﬁne"]
    df = spark.createDataFrame([(i, c, "k") for i, c in enumerate(cases)] + [(99, None, "k")], "i int, s string, variant2 string")
    got = {}
    for r in sorted(fl.normalize_labels(df, "s").collect(), key=lambda r: (r.i, r.variant)):
        got.setdefault(r.i, []).append((r.s, r.labelOrig, r.parenthesesInfo))
    assert got == {i: normal(c) for i, c in enumerate(cases) if normal(c)}


SPECIAL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ éß漢€ ñø"


@pytest.mark.parametrize("c", sorted(set(SPECIAL)))
def test_recode_special_characters(spark, c):
    from urllib.parse import unquote

    df = spark.createDataFrame([(f"{uris.BASE}{c}x",), (f"{uris.BASE}\\u{ord(c):04x}x",)], "u string")
    out = [r.u for r in uris.recode(df, "u").collect()]
    if c == "%":
        assert out[0] == f"{uris.BASE}%25x"
    elif c != "\\":
        assert len(set(out)) == 1 and unquote(out[0]) == f"{uris.BASE}{c}x" and out[0].isascii()


def test_uri_items(spark):
    df = spark.createDataFrame([(1, f"{uris.BASE}A|{uris.BASE}B"), (2, "plain"), (3, ""), (4, f"{uris.BASE}A||plain")], "i int, u string")
    got = {r.i: r.u for r in uris.map_items(df, "u", uris.shorten, "keep").collect()}
    assert got == {1: "A|B", 2: "plain", 3: "", 4: "A||plain"}
    assert {r.i for r in uris.map_items(df, "u", uris.shorten, "drop").collect()} == {1, 3}
    with pytest.raises(Exception, match="not changed"):
        uris.map_items(df, "u", uris.shorten).collect()
    ns = spark.createDataFrame([("http://dbpedia.org/ontology/Person",)], "u string")
    short = uris.map_items(ns, "u", lambda x: uris.shorten(x, base=False))
    assert short.first().u == "dbpo:Person" and uris.map_items(short, "u", lambda x: uris.expand(x, base=False)).first().u == ns.first().u
    p = spark.createDataFrame([("a:1",), ("a:1",), ("a:2:3",), ("nocolon",), ("",), (None,), (":x",)], "u string")
    assert sorted(tuple(r) for r in uris.prefix_counts(p, "u").collect()) == [("", 1, 1), ("a", 2, 3)]


def test_canonical(spark, rows):
    t = lambda *x: spark.createDataFrame(list(x), "from_uri string, to_uri string")
    df = spark.createDataFrame([(1, " a "), (2, "b"), (3, ""), (4, "dis"), (5, "x\\u0041"), (6, None)], "i int, u string")
    moved = lookup.closed_redirects(t(("a", "b"), ("b", "c"), ("c", "d")))
    assert rows(moved) == [("a", "d"), ("b", "d"), ("c", "d")]
    kw = dict(redirects=moved, disambiguations=t(("dis", "q")))
    assert rows(uris.canonical(df, "u", **kw)) == [(1, "d"), (2, "d"), (4, "")]
    assert rows(uris.canonical(df, "u", drop_empty=True, **kw)) == [(1, "d"), (2, "d")]
    assert rows(uris.canonical(df, "u", keep_empty=True, **kw)) == [(1, "d"), (2, "d"), (3, ""), (4, ""), (6, "")]
    assert lookup.closed_redirects(t(("a", "b"), ("b", "a"))).count() == 2  # a circle ends


def test_lookups(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "i int, k string")
    kv = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("c", "z", 3), (None, "n", 4)], "key string, val string, n int")
    assert rows(lookup.replace_column(df, "k", kv, "key", "val", "i")) == [(1, "x"), (1, "y"), (4, "x"), (4, "y")]
    assert rows(lookup.replace_column(df, "k", kv, "key", "val", "i", True)) == [(1, "x"), (1, "y"), (2, "b"), (3, None), (4, "x"), (4, "y")]
    assert rows(lookup.filter_by(df, "k", kv, "key", "i")) == [(1, "a"), (4, "a")] and rows(lookup.filter_by(df, "k", kv, "key", "i", True)) == [(2, "b"), (3, None)]
    assert rows(lookup.redirects(df, "k", kv, "key", "val", "n", "i")) == [(1, "y", "redir"), (2, "b", "nonredir"), (3, None, "nonredir"), (4, "y", "redir")]
    assert lookup.redirects(df, "k", kv, "key", "val", "n", "i", add=True).count() == 6 and lookup.redirects(df, "k", kv, "key", "val", "n", "i", info=False).columns == ["i", "k"]
    assert rows(lookup.disambiguations(df, "k", kv, "key", "val", "i"))[-2:] == [(4, "x", "disamb"), (4, "y", "disamb")]
    up = lookup.update_by_key(df.withColumn("v", F.lit("old")), "k", "v", kv, "key", "val", "n", "i")
    assert rows(up) == [(1, "a", "x"), (2, "b", "old"), (3, None, "old"), (4, "a", "x")]


def test_imports(spark, rows):
    f = spark.createDataFrame([(1, ["a", "x", "p"]), (2, ["b", "y"]), (3, ["a", "z", "q"])], "n int, f array<string>")
    first, again = sinks.import_rows(f, {"k": 0, "v": 2}, ["k"], "n")
    assert rows(first) == [(1, "a", "p"), (2, "b", None)] and rows(again) == [("a", 1)]
    assert rows(sinks.import_rows(f, {"k": 0, "v": 2}, ["k"], "n", last_wins=True)[0]) == [(2, "b", None), (3, "a", "q")]


def test_text_sinks(spark):
    e = spark.createDataFrame([("a", "b", 2), ("a", None, 1)], "s string, t string, w int")
    assert [r.value for r in sinks.graph_lines(e, "s", "t", "w").collect()] == ["u:a v:b w:2"]
    d = spark.createDataFrame([("big word", "C1,C2"), ("x", None)], "h string, c string")
    assert [r.value for r in sinks.dictionary_lines(d, "h", "c").collect()] == ["big_word C1 C2"]
    ids = spark.createDataFrame([("123456789",), ("7",)], "i string").select(sinks.shard_path(F.col("i"), 4).alias("p"), sinks.shard_path(F.col("i"), 0).alias("q"))
    assert [tuple(r) for r in ids.collect()] == [("2345/6789.finf", "123456789.finf"), ("0000/0007.finf", "7.finf")]
    assert sinks.gazetteer_definition({"a.lst": ("umls", "cased")}) == "a.lst:umls:cased\n"
    assert spark.createDataFrame([("a\tb",)], "s string").select(sinks.unescape_tabs(sinks.escape_tabs(F.col("s"))).alias("s")).first().s == "a\tb"


def test_merge_fold(spark, rows):
    data = [("l", "u", "wp-anchor", 1), ("l", "u", "wp", 2), ("l", "u", "db", 3), ("l", "u", "wp-anchor", 4), ("l", "v", None, 5), ("l", "u", "dbx", 6)]
    df = spark.createDataFrame(data, "label string, uri string, src string, line_no int")
    assert rows(classes.merge_label_info(df, ["label", "uri"], ["src"], "line_no")) == [("l", "u", "wp-anchor|db|dbx"), ("l", "v", "")]


def fold(rows_, canonical, interesting, supers):
    out = {}
    for uri, cls in rows_:
        c = canonical.get(cls)
        if c is None:
            continue
        i = "" if interesting[c] == "owl:Thing" else interesting[c]
        if uri not in out:
            out[uri] = [[c], [i] if i else []]
            continue
        spec, ints = out[uri]
        changed = True
        for k, s in enumerate(spec):
            if s == c or c in supers.get(s, ()):
                changed = False
                break
            if s in supers.get(c, ()):
                spec[k] = c
                break
        else:
            spec.append(c)
        if changed and i and i not in ints:
            ints.append(i)
    return {(u, "|".join(s), "|".join(i)) for u, (s, i) in out.items()}


def test_specific_classes(spark):
    import random

    rng = random.Random(4)
    supers = {"C": {"A", "B", "T"}, "A": {"T"}, "B": {"T"}, "D": {"A", "T"}, "E": {"D", "A", "T"}}
    canonical = {x: x for x in "ABCDET"} | {"a2": "A"}
    interesting = {"A": "I1", "B": "I2", "C": "I1", "D": "I3", "E": "owl:Thing", "T": "owl:Thing"}
    data = [("first", x) for x in ("A", "B", "C")] + [(f"u{rng.randint(0, 60)}", rng.choice([*canonical, "unknown"])) for _ in range(500)]
    f = lambda d, s: spark.createDataFrame(d, s)
    got = classes.specific_classes(f([(u, c, i) for i, (u, c) in enumerate(data)], "uri string, cls string, line_no int"), f(list(canonical.items()), "cls string, to string"), f(list(interesting.items()), "cls string, to string"), f([(a, b) for a, s in supers.items() for b in s], "cls string, to string"))
    got = {tuple(r) for r in got.collect()}
    assert got == fold(data, canonical, interesting, supers) and ("first", "C|B", "I1|I2") in got


def test_ontology_mapping(spark):
    sub = spark.createDataFrame([("dbpo:Athlete", "dbpo:Person"), ("x:Runner", "dbpo:Athlete"), ("dbpo:Person", "owl:Agent"), ("x:Lone", "y:Other")], "a string, b string")
    eq = spark.createDataFrame([("x:Runner", "dbpo:Runner"), ("foaf:Person", "dbpo:Person")], "a string, b string")
    got = {tuple(r) for r in classes.ontology_mapping(sub, eq).collect()}
    assert {("map:hasCanonicalUri", "foaf:Person", "dbpo:Person"), ("map:hasCanonicalUri", "x:Runner", "dbpo:Runner"), ("map:hasInterestingClass", "dbpo:Runner", "dbpo:Person"), ("map:hasSuperClass", "dbpo:Runner", "dbpo:Athlete"), ("map:hasSuperClass", "dbpo:Runner", "owl:Thing")} <= got
    assert not any(o in ("x:Lone", "y:Other", "owl:Agent") for _, o, _ in got)


def test_page_rank(spark):
    import numpy as np

    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("d", "e"), ("a", "b")]
    got = {r.node: r.prob for r in graph.page_rank(spark.createDataFrame(edges, "s string, t string"), "s", "t", iterations=60).collect()}
    names = sorted(got)
    m = np.zeros((5, 5))
    for s, t in edges:
        m[names.index(t), names.index(s)] += 1
    out = m.sum(0)
    m = np.where(out > 0, m / np.where(out > 0, out, 1), 1 / 5)
    p = np.full(5, 0.2)
    for _ in range(200):
        p = 0.15 / 5 + 0.85 * m @ p
    assert np.allclose([got[n] for n in names], p, atol=1e-4) and abs(sum(got.values()) - 1) < 1e-9
    assert graph.page_rank(spark.createDataFrame([], "s string, t string"), "s", "t").count() == 0


def test_closure_of_a_circle(spark, rows):
    assert rows(graph.closure(spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "a string, b string"), "a", "b")) == [("a", "a"), ("a", "b"), ("a", "c"), ("b", "a"), ("b", "b"), ("b", "c")]


def test_scripts(spark):
    assert script.statements("-- c\nSELECT 1;\n\n// x\nSELECT\n2\n\n\n") == ["SELECT 1", "SELECT\n2"]
    assert script.filled("x IN ###LANGLIST", LANGLIST=script.sql_list("a b'")) == "x IN ('a','b''')"
    with pytest.raises(KeyError):
        script.filled("###NONE")
    done, error = script.run_script(spark, "SELECT 1 AS a\n\nSELECT nonsense FROM nowhere\n\nSELECT 2")
    assert [d.first().a for d in done] == [1] and error is not None


def test_pipeline_filters(spark, rows):
    atoms = spark.createDataFrame([("C1", "SCR", "x", 256), ("C1", "ENG", "ABc", 257), ("C1", "ENG", "a\tb", None), ("C1", "ENG", "two words", 1), ("C2", "ENG", "no", 256)], "cui string, lat string, str string, cvf int")
    lang = readers.languages(spark)
    assert lang.count() == 28 and rows(pipelines.in_languages(atoms, lang, ("hr", "sr")).select("str")) == [("x",), ("x",)]
    assert rows(pipelines.nlp_subset(atoms).select("str")) == [("ABc",), ("no",), ("x",)]
    types = spark.createDataFrame([("C1", "T", "S"), ("C1", "T2", "S")], "cui string, tui string, sty string")
    groups = spark.createDataFrame([("G", "S")], "styclass string, sty string")
    g = pipelines.gazetteer(atoms, types, groups, lang, "G", ("en", "hr"))
    assert rows(pipelines.cased(g)) == [("ABc",)] and rows(pipelines.uncased(g)) == [("two words", 0), ("x", 1)]
    defs = spark.createDataFrame([("C1", "a\tb")], "cui string, def string")
    assert rows(pipelines.abstracts(defs, types, "def")) == [("C1", "a&#x0009;b")] * 2


def test_run_all(spark, tmp_path):
    atoms = spark.createDataFrame([("C1", "ENG", "Y", "DNA", "A", 256), ("C1", "GER", "N", "dna", "B", None)], "cui string, lat string, ispref string, str string, sab string, cvf int")
    t = {
        "atoms": atoms, "types": spark.createDataFrame([("C1", "T", "S")], "cui string, tui string, sty string"), "groups": spark.createDataFrame([("KCX", "S")], "styclass string, sty string"), "languages": readers.languages(spark),
        "freq": spark.createDataFrame([("C1", 1, 0.1)], "cui string, cnt int, norm double"), "rank": spark.createDataFrame([("C1", 0.2)], "cui string, prob double"), "label_freq": spark.createDataFrame([], "label string, cui string, cnt int, norm double"),
        "definitions": spark.createDataFrame([("C1", "text")], "cui string, def string"),
    }
    pipelines.run_all(t, str(tmp_path), pipelines.Config(languages=("en", "de")))
    assert {r.lang for r in spark.read.parquet(f"{tmp_path}/candidates").collect()} == {"en", "de"}
    assert [r.value for r in spark.read.text(f"{tmp_path}/gazetteer/en/cased-labels.lst").collect()] == ["DNA"] and [r.value for r in spark.read.text(f"{tmp_path}/gazetteer/de/uncased-labels.lst").collect()] == ["dna"]
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/abstracts").collect()) == [("C1", "text", "de"), ("C1", "text", "en")]


def test_release_files(spark, tmp_path):
    (tmp_path / "MRCOLS.RRF").write_text('COL|a "b|\\|1|2.50||F|int|\nX|||||||\n')
    got = readers.read_rrf(spark, str(tmp_path / "MRCOLS.RRF"), "MRCOLS").collect()
    assert (got[0].des, got[0].ref, got[0].min, str(got[0].av), got[0].max) == ('a "b', "\\", 1, "2.50", None) and got[1].des is None
    assert readers.read_rrf(spark, str(tmp_path / "MRCOLS.RRF"), "MRCOLS", first_line_is_header=True).count() == 1
    assert len(schemas.schema("MRSAB")) == 25 and "scit" in schemas.required("MRSAB") and all(schemas.schema(n) for n in schemas.LAYOUTS)
    (tmp_path / "g.csv").write_text("BMH,'Type, one'\n")
    assert readers.read_quoted_csv(spark, str(tmp_path / "g.csv"), "a string, b string").first().b == "Type, one"


def test_triples(spark, tmp_path):
    lines = ['<s> <p> "a\\tb\\"c\\\\n\\u00e9"@en-GB .', "<s> <p> <o> . # c", '_:b <p> "1"^^<dt> .', "bad line", "# c", "", None, '<s> <p> "x" ']
    got = [tuple(r) for r in readers.triples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [("s", "p", 'a b"c\\né', "en-GB", "", None), ("s", "p", "o", "", "", None), ("_:b", "p", "1", "", "dt", None), (None,) * 5 + ("bad line",), (None,) * 5 + ('<s> <p> "x" ',)]
    kept = readers.triples(spark.createDataFrame([(lines[0],)], "value string"), keep_original=True).first()
    assert kept.obj == 'a\tb"c\\né'
    (tmp_path / "a.ttl").write_text('@prefix x: <http://x/> .\n@base <http://b/> .\nx:a a x:C ; x:p "l"@en , 1.5 , true ; x:q [ x:r <rel> ] .\nx:l x:m ( 1 "two" ) .')
    (tmp_path / "b.ttl").write_text("<http://a> <http://b> nonsense .")
    t = {tuple(r)[:3] for r in readers.read_turtle(spark, str(tmp_path / "a.ttl")).collect()}
    assert {("http://x/a", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://x/C"), ("http://x/a", "http://x/p", "l"), ("http://x/a", "http://x/p", "1.5"), ("_:b1", "http://x/r", "http://b/rel")} <= t and len(t) == 11
    assert readers.read_turtle(spark, str(tmp_path / "b.ttl")).first()._corrupt


def test_xml_sources(spark, tmp_path):
    page = lambda i, ns, text: f"<page><title>t{i}</title><ns>{ns}</ns><id>{i}</id><revision><id>9</id><timestamp>z</timestamp><text xml:space='preserve'>{text}</text></revision></page>"
    (tmp_path / "w.xml").write_text("<mediawiki>" + page(1, 0, "''A'' [[b|c]] {{x}} &amp;lt; [[d]]") + page(2, 1, "talk") + page(3, 0, "#redirect [[x]]") + page(4, 0, " ") + "</mediawiki>")
    w = readers.read_wiki(spark, str(tmp_path / "w.xml"))
    assert [(r.id, r.title, r.p) for r in w.withColumn("p", readers.wiki_plain(F.col("text"))).collect()] == [("1", "t1", "A c  < d")]
    assert readers.read_wiki(spark, str(tmp_path / "w.xml"), max_docs=1).count() == 1
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "d.xml").write_text('<Document><AnnotationSet Name="Key"><Annotation Id="1" Type="Mention" StartNode="0" EndNode="4"><Feature><Name>inst</Name><Value>C1</Value></Feature></Annotation><Annotation Id="2" Type="Other" StartNode="0" EndNode="4"></Annotation></AnnotationSet></Document>')
    a = readers.read_annotations(spark, str(tmp_path / "g")).collect()
    assert len(a) == 1 and a[0].features == {"inst": "C1"} and (a[0].start, a[0].stop) == (0, 4)
    (tmp_path / "o.owl").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s"><owl:Class rdf:about="A"><rdfs:subClassOf rdf:resource="B"/><owl:equivalentClass rdf:resource="C"/></owl:Class></rdf:RDF>')
    sub, eq = readers.read_ontology(spark, str(tmp_path / "o.owl"))
    assert [tuple(r) for r in sub.collect()] == [("A", "B")] and [tuple(r) for r in eq.collect()] == [("A", "C")]
