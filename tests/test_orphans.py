from termweave.operators import orphans, skew

SCHEMA = "line_no long, cui string, umlsversion string, k int, tab string"


def run(spark, refs, parents, gone):
    r = orphans.references({"t": spark.createDataFrame([(*x, 0, "clash") for x in refs], SCHEMA)})
    p = spark.createDataFrame(parents, "k string, period string")
    g = spark.createDataFrame(gone, "k string, period string")
    return r, orphans.orphan_keys(r, p, g)


def test_reasons(spark, rows):
    refs = [(1, "C1", "2014AA"), (2, " c-1 ", "2014AB"), (3, "C2", "2014AA"), (4, None, "2014AA"), (5, "<SPURIOUS>", "2014AA"), (6, "C3", "2015AA"), (7, "C3", "2014AA"), (8, "C1", None), (9, "", "2014AA"), (3, "C2", "2014AA")]
    r, o = run(spark, refs, [("C1", "2014AB"), ("C1", "2016AA"), ("C3", "2013AA"), (None, "2013AA")], [("C3", "2015AA"), ("C3", None)])
    assert rows(orphans.orphan_rows(r, o).select("line_no", "reason")) == [(1, "later"), (3, "missing"), (3, "missing"), (6, "deleted"), (8, "later"), (9, "missing")]
    c = {x.period: (x.refs, x.orphans, x.missing, x.later, x.deleted, x.orphan_keys) for x in orphans.orphan_counts(r, o).collect()}
    assert c == {"2014AA": (5, 4, 3, 1, 0, 3), "2014AB": (1, 0, 0, 0, 0, 0), "2015AA": (1, 1, 0, 0, 1, 1), None: (1, 1, 0, 1, 0, 1)}


def test_empty(spark):
    r, o = run(spark, [], [], [])
    assert o.count() == 0 and orphans.orphan_rows(r, o).count() == 0 and orphans.orphan_counts(r, o).count() == 0


def test_hot_orphan_is_salted(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 5)
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (None, 5))
    r, o = run(spark, [(i, "C9" if i % 3 else f"D{i}", "2014AA") for i in range(200)], [(f"D{i}", "2014AA") for i in range(200)], [])
    out = orphans.orphan_rows(r, o)
    assert out.count() == sum(1 for i in range(200) if i % 3)
    assert "_salt" in out._jdf.queryExecution().toString()
