import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termweave.llm import packing, tokens


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_each_rank_once(hist):
    runs, n = packing.plan(hist, 64)
    used, ranks = Counter(), defaultdict(set)
    for r in runs:
        for k in range(r.each * r.bins):
            assert r.start + k not in ranks[r.size]
            ranks[r.size].add(r.start + k)
            used[r.first + k // r.each] += r.size
    assert {s: len(v) for s, v in ranks.items()} == hist and all(max(v) == len(v) for v in ranks.values())
    assert set(used) == set(range(n)) and all(0 < u <= 64 for u in used.values())
    # best fit decreasing item by item needs as many containers
    rooms: list[int] = []
    for size in sorted((s for s, k in hist.items() for _ in range(k)), reverse=True):
        fit = [(r, i) for i, r in enumerate(rooms) if r >= size]
        if fit:
            rooms[min(fit)[1]] -= size
        else:
            rooms.append(64 - size)
    assert n == len(rooms)


def test_counts_do_not_slow_the_plan():
    rng = random.Random(1)
    hist = {s: rng.randint(10**8, 10**9) for s in range(1, 2049)}
    runs, n = packing.plan(hist)
    total = sum(s * k for s, k in hist.items())
    assert len(runs) < 40_000 and n * 2048 < 1.02 * total


@pytest.mark.parametrize("seed", [1, 2])
def test_pack(spark, seed):
    rng = random.Random(seed)
    sizes = [7 if rng.random() < 0.4 else rng.choice([None, 0, 1, 5, 64, 65, 128, 1000, rng.randint(1, 64)]) for _ in range(700)]
    df = spark.createDataFrame([(i, s, 0) for i, s in enumerate(sizes)], "doc_id long, n int, piece int")
    got = packing.pack(df, "doc_id", "n", 64).collect()
    parts, used = defaultdict(list), Counter()
    for r in got:
        assert r.n_units == r.to_unit - r.from_unit and r.n_units <= 64
        parts[r.doc_id].append((r.from_unit, r.to_unit))
        if r.container is not None:
            used[r.container] += r.n_units
    for i, s in enumerate(sizes):
        edges = sorted(parts[i])
        assert edges[0][0] == 0 and edges[-1][1] == (s or 0) and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
        assert len(edges) == (1 if not s else -(-s // 64))
    assert set(used) == set(range(len(used))) and max(used.values()) <= 64
    assert len(used) <= 1.02 * sum(s or 0 for s in sizes) / 64 + 1


def test_nothing_to_pack(spark):
    df = spark.createDataFrame([], "doc_id long, n int")
    assert packing.pack(df, "doc_id", "n").count() == 0


def test_token_counts_round_trip(spark):
    texts = ["Hello world", "", None, "Ünïcode 漢字 <|endoftext|>", "a" * 100_000, "x y\n\n z  " * 2000]
    enc = tokens.encoder()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in tokens.with_token_counts(df, "text", ["doc_id"]).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts if t)
