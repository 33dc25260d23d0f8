import random
import re
from collections import Counter, defaultdict

from termweave.functions.text import clean_key, word_bag
from termweave.llm import copies
from termweave.operators import skew

FIELDS = [copies.Field("cui", clean_key), copies.Field("raw", word_bag)]


def brute(data):
    sets = defaultdict(list)
    for i, cui, text, *_ in data:
        words = None if text is None else tuple(sorted(re.findall(r"[^\W_]+", text.lower())))
        sets[None if cui is None else "".join(c for c in cui.upper() if c.isalnum()), words].append(i)  # nulls are alike
    return sets


def make(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = [rng.choice(["Aa", "b", "Éx", "12"]) for _ in range(rng.randint(0, 3))]
        rng.shuffle(w)
        text = rng.choice([" ", ", ", "-", "\t", "_"]).join(x.upper() if rng.random() < 0.3 else x for x in w) + rng.choice(["", ".", " !"])
        out.append((i, rng.choice(["C1", "c-1 ", "C2", None]), None if rng.random() < 0.05 else text, "id", "n"))
    return out


SCHEMA = "line_no long, cui string, raw string, id string, tuple string"


def test_found_against_brute_force(spark, rows):
    data = make(1500, 1)
    got = copies.found(spark.createDataFrame(data, SCHEMA), "line_no", FIELDS)
    assert rows(got) == sorted((min(s), i) for s in brute(data).values() for i in s if i != min(s))


def test_salted_the_same(spark, rows, monkeypatch):
    data = make(800, 2)
    want = rows(copies.found(spark.createDataFrame(data, SCHEMA), "line_no", FIELDS))
    monkeypatch.setattr(copies, "small", lambda df: False)
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (None, 3))
    assert rows(copies.found(spark.createDataFrame(data, SCHEMA), "line_no", FIELDS)) == want


def test_collapse_counts(spark):
    data = make(500, 3)
    got = {r.line_no: r.copies for r in copies.collapse(spark.createDataFrame(data, SCHEMA), "line_no", FIELDS).collect()}
    assert got == {min(s): len(s) for s in brute(data).values()}


def test_multisets_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "C1", "a a b"), (2, "C1", "a b b"), (3, "C1", "b A,a"), (4, "C1", ""), (5, "C1", "..."), (6, "C1", "x" * 200_000), (7, "c1", "X" * 200_000)], "line_no long, cui string, raw string")
    assert rows(copies.found(df, "line_no", FIELDS)) == [(1, 3), (4, 5), (6, 7)]
    assert copies.found(df.limit(0), "line_no", FIELDS).count() == 0
    assert Counter(r.copies for r in copies.collapse(df, "line_no", FIELDS).collect()) == {1: 1, 2: 3}
