import random
from collections import defaultdict

import pytest

from termweave.llm import topn


def brute(data, n):
    g = defaultdict(list)
    for cui, s, label, line in data:
        g[cui].append((s is None, -(s or 0), label is not None, label or "", line))
    return sorted(((k is None, k or "", j, r[4]) for k, v in g.items() for j, r in enumerate(sorted(v)[:n], 1)))


@pytest.mark.parametrize("parts", [1, 2, 6, 40])
def test_against_brute_force(spark, parts):
    rng = random.Random(parts)
    data = [(rng.choice(["hot", "hot", "warm", None, f"c{rng.randint(0, 200)}"]), rng.choice([None, 5, 5, 5, 7, -2]), rng.choice([None, "a", "b", "é", "𝒳", "～"]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "cui string, score int, preflabel string, line_no long").repartition(parts)
    got = topn.top_n(df, "cui", "score", ["preflabel", "line_no"], 3)
    assert sorted((r.cui is None, r.cui or "", r.rnk, r.line_no) for r in got.collect()) == brute(data, 3)


def test_large_scores_and_names(spark, rows):
    data = [("a", 2**53 + i % 2, str(i), i) for i in range(40)]
    df = spark.createDataFrame(data, "rnk string, _s long, _t0 string, _g long")
    got = topn.top_n(df, "rnk", "_s", ["_t0", "_g"], 2).toDF("k", "rnk", "t", "i")
    assert rows(got.select("rnk", "i")) == [(1, 1), (2, 11)]


def test_empty_and_small(spark):
    df = spark.createDataFrame([("a", 1, "x", 1)], "cui string, score int, l string, i long")
    assert topn.top_n(df, "cui", "score", ["l", "i"], 3).count() == 1
    assert topn.top_n(df.limit(0), "cui", "score", ["l", "i"], 3).count() == 0
