import json
import random

import pytest
from pyspark.sql import functions as F

from termweave.functions.text import clean_key, core
from termweave.llm import truncation as t


@pytest.mark.parametrize("seed", [1, 2])
def test_continued_against_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab é") for _ in range(rng.randint(0, 6)))
    known = [(rng.choice(["C1", "C2", "C3"]), word()) for _ in range(150)]
    vals = [(rng.choice(["C1", "C2", "C4"]), word()) for _ in range(300)] + [("C1", "")]
    k, v = (spark.createDataFrame(x, "k string, v string") for x in (known, vals))
    want = sorted({(a, b) for a, b in vals if (a, b) not in known and any(a == c and d.startswith(b) for c, d in known)})
    assert rows(t.continued(v, k)) == want
    assert t.continued(v.limit(0), k).count() == 0 and t.continued(v, k.limit(0)).count() == 0


def test_core_and_nulls(spark):
    df = spark.createDataFrame([("c-1", "ABC … ."), (None, "x"), ("c1", None)], "cui string, s string")
    assert [tuple(r) for r in t.known_labels(df, "cui", "s").collect()] == [("C1", "abc")]
    assert df.select(core("s"), clean_key("cui")).first()[0] == "abc"


def test_spikes_in_characters_and_bytes(spark):
    rng = random.Random(5)
    free = [("s1", "é" * rng.randint(1, 30) + "b" * rng.randint(1, 40)) for _ in range(800)]
    chars = [("s2", "ab c" * 10) for _ in range(100)]  # 40 characters
    nbytes = [("s3", ("é" * rng.randint(0, 20)).ljust(100, "x").encode()[:50].decode(errors="ignore")) for _ in range(200)]
    other = [(s, "w" * rng.randint(1, 20)) for s in ("s2", "s3") for _ in range(300)]
    df = spark.createDataFrame([(i, *x, "n") for i, x in enumerate(free + chars + nbytes + other)] + [(9000, None, None, "n")], "line_no long, src string, v string, n string")
    spikes = {(r.source, r.unit, r.len) for r in t.length_spikes(t.length_histogram(df, "src", "v")).collect()}
    assert {("s2", "chars", 40), ("s2", "bytes", 40), ("s3", "bytes", 50)} <= spikes and not any(s == "s1" for s, *_ in spikes)
    cut = {r.line_no for r in t.suspects(df, "src", "v", ["line_no"]).collect()}
    assert set(range(800, 900)) <= cut and len(cut & set(range(900, 1100))) > 150
    assert t.suspects(df.limit(0), "src", "v", ["line_no"]).count() == 0


def test_a_byte_limit_takes_in_the_lengths_just_below(spark):
    cut = lambda n, x, size: [(x * k + "é" * 40).encode()[:size].decode(errors="ignore") for k in (0, 1) for _ in range(n)]
    few = ["€" * 16 + x for x in ("ab", "a", "") for _ in range(12)]  # 50, 49 and 48 bytes, none of them a spike alone
    in_chars = ["x" * (40 - k) + "é" * k for k, n in ((0, 100), (1, 30), (2, 10)) for _ in range(n)]
    texts = [("s1", v) for v in cut(15, "x", 51)] + [("s1", "x" * 51)] * 60 + [("s2", v) for v in few] + [("s4", v) for v in in_chars]
    other = [("s3", "w" * n) for n in range(1, 40) for _ in range(15)] + [("s4", "w" * n) for n in (37, 38, 39) for _ in range(3)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(texts + other)], "line_no long, src string, v string")
    got = {(r.source, r.from_len, r.len, r.n) for r in t.length_spikes(t.length_histogram(df, "src", "v")).collect() if r.unit == "bytes"}
    assert got == {("s1", 48, 51, 90), ("s2", 47, 50, 36), ("s4", 40, 40, 100), ("s4", 41, 41, 30)}  # 40 characters are no limit in bytes
    assert {r.line_no for r in t.suspects(df, "src", "v", ["line_no"]).collect()} == set(range(len(texts)))


JSON = {
    "[]": True, " [1, {\"a\": [2]}]\n": True, "[1": False, "[1]]": False, "[1][2]": False, "{}": False, "": False, "[NaN]": False, "[1] x": False, '["a': False, "['a']": False, '["]"]': True, "null": False,
    "[" * 50_000 + "]" * 50_000: True, "[" * 50_000 + "]" * 49_999: False, json.dumps(["x" * 500_000]): True,
}


def test_json(spark):
    df = spark.createDataFrame([*((k,) for k in JSON), (None,)], "s string").withColumn("ok", t.whole_json_array("s"))
    got = {r.s: r.ok for r in df.collect()}
    assert got == JSON | {None: False}
    assert df.filter(F.lit(False)).count() == 0
