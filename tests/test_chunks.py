import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from termweave.operators import chunks, skew


@pytest.mark.parametrize("n,parts", [(0, 4), (1, 4), (2000, 7), (2000, 1)])
def test_numbers_against_sort(spark, n, parts):
    rng = random.Random(n + parts)
    data = [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 60)}", rng.randint(0, 5), i, 1) for i in range(n)]
    df = spark.createDataFrame(data, "k string, v int, i long, _pid int")
    got = {r.i: r.row_no for r in chunks.number_rows(df, ["k"], [F.desc("v"), F.col("i")], partitions=parts).collect()}
    want, groups = {}, defaultdict(list)
    for k, v, i, _ in data:
        groups[k].append((-v, i))
    for g in groups.values():
        want |= {i: j for j, (_, i) in enumerate(sorted(g), 1)}
    assert got == want


def test_two_keys_and_replaced_column(spark):
    df = spark.createDataFrame([("a", 1, 5, 0), ("a", 1, 6, 0), ("a", 2, 7, 0), ("b", 1, 8, 0)], "k string, j int, i int, row_no int")
    assert sorted((r.i, r.row_no) for r in chunks.number_rows(df, ["k", "j"], [F.col("i")]).collect()) == [(5, 1), (6, 2), (7, 1), (8, 1)]


def test_ranked_items_and_merge(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 9)}", f"c{rng.randint(0, 300)}", rng.choice([None, 1, 2, 3]), "x") for _ in range(4000)]
    df = spark.createDataFrame(data, "k string, item string, s int, copies string")
    got = chunks.ranked_items(df, "k", "item", {"score": F.max("s")}, chunk_rows=50)
    best = defaultdict(lambda: defaultdict(lambda: None))
    copies = Counter()
    for k, c, s, _ in data:
        copies[k, c] += 1
        best[k][c] = max(x for x in (best[k][c], s, -1) if x is not None)
    want = {k: sorted(v, key=lambda c: (-v[c], c)) for k, v in best.items()}
    rows = got.collect()
    assert {(r.k, r.row_no): r.item for r in rows} == {(k, j): c for k, cs in want.items() for j, c in enumerate(cs, 1)}
    assert all(r.copies == copies[r.k, r.item] and r.chunk_no == (r.row_no - 1) // 50 for r in rows)
    m = {r.k: r for r in chunks.merge_chunks(got, ["k"], ["copies"], ["item"]).collect()}
    assert {k: (r.n_rows, r.copies, r.first_item, r.last_item) for k, r in m.items()} == {k: (len(c), sum(copies[k, x] for x in c), c[0], c[-1]) for k, c in want.items()}


def test_work_is_spread(spark):
    """A key with most rows is cut over the partitions."""
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    n = chunks.number_rows(df, ["k"], [F.col("id")], partitions=8)
    assert n.filter("row_no <> id + 1").count() == 0


def test_salted_join_keeps_rows(spark):
    left = spark.range(1000).selectExpr("id", "CASE WHEN id < 600 THEN 'hot' WHEN id < 650 THEN NULL ELSE 'k' || id END AS k")
    right = spark.createDataFrame([("hot", 1), ("k700", 2), ("none", 3)], "k string, v int")
    hot = skew.hot_keys(left.filter("k is not null"), ["k"], least=100)
    assert len(hot) == 1
    for how, n in (("inner", 601), ("left", 1000), ("left_semi", 601), ("left_anti", 399)):
        assert skew.salted_join(left, right, ["k"], "id", hot, how).count() == left.join(right, "k", how).count() == n
