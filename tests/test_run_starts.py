import random

import pytest
from pyspark.sql import functions as F

from termweave.operators import chunks
from termweave.session import release


@pytest.mark.parametrize("hot", [False, True])
def test_run_starts_against_brute_force(spark, rows, hot):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", None, "", "b", "é", f"k{rng.randint(0, 300)}"]) if not hot or rng.random() < 0.3 else "hot", rng.choice([None, 1, 2]), i) for i in range(5000)]
    df = spark.createDataFrame(data, "k string, m int, row long").repartition(7)
    first = {}
    for k, m, i in data:
        first[k, m] = min(i, first.get((k, m), i))
    got = rows(chunks.run_starts(df, ["k", "m"], [F.col("row")], "row", ["row"], "start"))
    assert got == sorted((i, first[k, m]) for k, m, i in data)
    later = chunks.run_starts(df, ["k", "m"], [F.col("row")], "row", ["row"], "start", later=True)
    assert rows(later) == sorted((i, first[k, m]) for k, m, i in data if first[k, m] != i)
    release(later)
    ids = {}
    for k, m, i, n in chunks.run_starts(df, ["k", "m"], [F.col("row")], None, ["k", "m", "row"], "id").collect():
        ids.setdefault((k, m), set()).add(n)
    assert set(ids) == set(first) and all(len(x) == 1 for x in ids.values()) and len({next(iter(x)) for x in ids.values()}) == len(ids)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, row long")
    assert chunks.run_starts(df, ["k"], [F.col("row")], "row", ["row"], "start").count() == 0
