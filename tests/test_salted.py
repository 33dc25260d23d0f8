"""Joins whose keys may be hot: with a low limit their keys are salted, and the rows are those of plain joins."""

import random

import pytest

from termweave.functions import uris
from termweave.operators import concepts, graph, labels, lookup, skew
from termweave.plans import pipelines


def frames(spark):
    rng = random.Random(8)
    key = lambda: rng.choice(["hot"] * 6 + ["b", "c", None, "é"])
    atoms = spark.createDataFrame([(key(), rng.choice(["ENG", "GER"]), f"S{i % 40}", rng.choice("YN"), f"label {i % 70}") for i in range(600)], "cui string, lat string, sab string, ispref string, str string")
    types = spark.createDataFrame([("hot", "T1", "A"), ("hot", "T2", "B"), ("b", "T1", "A"), ("x", "T1", "A")], "cui string, tui string, sty string")
    groups = spark.createDataFrame([("G", "A"), ("G", "B")], "styclass string, sty string")
    langs = spark.createDataFrame([("en", "eng", "ENG")], "iso6391 string, iso6393 string, umlslabel string")
    rows = spark.createDataFrame([(i, key(), "old") for i in range(400)], "i long, k string, v string")
    pairs = spark.createDataFrame([("hot", "n1", 1), ("hot", "n2", 2), ("b", None, 3)], "from_uri string, to_uri string, n int")
    edges = spark.createDataFrame([(rng.choice(["hot"] * 6 + ["b", "c"]), f"t{rng.randint(0, 60)}", 1.0) for _ in range(500)], "a string, b string, w double")
    return atoms, types, groups, langs, rows, pairs, edges


JOINS = {
    "best_labels": lambda f: labels.best_labels(labels.scored_labels(f[0])),
    "dictionary": lambda f: concepts.dictionary(f[0], f[1]),
    "gazetteer": lambda f: pipelines.gazetteer(*f[:4], "G", ("en",)),
    "abstracts": lambda f: pipelines.abstracts(f[4].selectExpr("i", "k AS cui", "concat('text ', i) AS def"), f[1], "i"),
    "update_by_key": lambda f: lookup.update_by_key(f[4], "k", "v", f[5], "from_uri", "to_uri", "n", "i"),
    "canonical": lambda f: uris.canonical(f[4], "k", redirects=f[5].filter("n > 1"), disambiguations=f[5].filter("n = 3"), unique="i"),
    "canonical_by_rows": lambda f: uris.canonical(f[4], "k", redirects=f[5].filter("n > 1")),
    "page_rank": lambda f: graph.page_rank(f[6], "a", "b", "w", iterations=4, both_ways=True).selectExpr("node", "round(prob, 9) AS prob"),
    "with_ids": lambda f: graph.with_ids(f[6], graph.node_ids(f[6].groupBy("a", "b").count().selectExpr("a", "b", "CAST(abs(hash(a, b)) AS LONG) AS n"), "a", "b", "n").selectExpr("node", "length(node) AS id"), "a", "b"),
}


@pytest.mark.parametrize("name", JOINS)
def test_salted_the_same(spark, rows, monkeypatch, name):
    f = frames(spark)
    want = rows(JOINS[name](f))
    salted = []
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (None, 20))
    plain = skew.unused
    monkeypatch.setattr(skew, "unused", lambda n, *x: salted.append(n) or plain(n, *x))
    assert rows(JOINS[name](f)) == want and len(want) > 2 and "_salt" in salted


def test_redirects_end_or_go_round(spark, rows):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(100)]
    pairs = [*chain, ("a", "b"), ("b", "c"), ("c", "a"), ("t", "s"), ("s", "b"), ("0", "s"), ("self", "self"), ("two", "x"), ("two", "y"), ("null", None)]
    got = dict(rows(lookup.closed_redirects(spark.createDataFrame(pairs, "from_uri string, to_uri string"))))
    assert got == {**{f"c{i}": "c100" for i in range(100)}, **dict.fromkeys(["a", "b", "c", "t", "s", "0"], "a"), "self": "self", "two": "x", "null": None}
    assert lookup.closed_redirects(spark.createDataFrame([], "from_uri string, to_uri string")).count() == 0


def test_an_end_without_a_number(spark):
    with pytest.raises(Exception, match="node not found"):
        graph.with_ids(spark.createDataFrame([("a", "b")], "a string, b string"), spark.createDataFrame([("a", 1)], "node string, id long"), "a", "b").collect()


def test_closure_that_does_not_end_is_an_error(spark):
    with pytest.raises(RuntimeError):
        graph.closure(spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int"), "a", "b", rounds=2)
