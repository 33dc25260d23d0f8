"""Mixing sources to target weights: budgets in units, met exactly where subset sums allow.

The total is the largest for which no source is used more than its cap: min over sources of cap x size / weight. A source's budget is
its weight of that total. It is used whole as often as fits. Of the remaining budget B out of the source's size S:

1. The documents of a source are numbered in order of (length, seeded hash, id), by exact numbering that spreads a source over many tasks.
   Of each 1/p documents in a row (p = B/S) the first is taken: rank r is taken iff ceil(r p) > ceil((r-1) p), up to floor(n p) documents.
   So every range of lengths gives its share of documents to within one (that of the longest, two), and what is left of B is less than two longest documents:
   a block's first document is its shortest, and the differences between blocks' means and firsts add up to less than one longest.
2. The rest is fitted by a bounded knapsack over the lengths that still have documents: subset sums, longest lengths first, so that few
   documents do it. It is tried over the ``STEPS`` shortest lengths of each half power of two. A sum that is the budget can't be bettered. If
   they miss it, ``fit`` does it over every length and every document of the source, taken ones too: its sum is the largest of all selections
   that keep the budget. Documents of a length are taken in order of their rank.

Whether a document is taken is a function of its rank, so the only lengths joined are those the knapsack changes. What reaches the driver: one row per
source of the targets, and per source less than 1,000 lengths with their counts; of a source where these miss the budget, all its lengths with
their counts, at most as many as the longest document has units. ``STEPS`` says how many are tried first; the sum reached doesn't depend on it.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterable
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.chunks import number_rows
from ..session import release, staged

#: The first knapsack of a source is over so many lengths, the shortest, of each half power of two.
STEPS = 16
SEED = 42


def subset_sum(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length to take so that the sum is as large as possible but at most ``budget``.

    Bounded counts are split into powers of two; each part, longest first, shifts the set of reachable sums once. For each sum the part that
    first reached it is kept, so the way back is exact. Memory: 5 bytes per unit of the budget.
    """
    parts: list[tuple[int, int]] = []
    for length in sorted((x for x in counts if 0 < x <= budget), reverse=True):
        left, k = min(counts[length], budget // length), 1
        while left > 0:
            k = min(k, left)
            parts.append((length, k))
            left -= k
            k *= 2
    if not parts:
        return {}
    reach, by = np.zeros(budget + 1, dtype=bool), np.zeros(budget + 1, dtype=np.int32)
    reach[0] = True
    for i, (length, k) in enumerate(parts):
        step = length * k
        if step > budget:
            continue
        new = np.flatnonzero(reach[:-step] & ~reach[step:]) + step
        reach[new] = True
        by[new] = i
        if reach[budget]:
            break
    take: dict[int, int] = {}
    s = int(np.flatnonzero(reach)[-1])
    while s:
        length, k = parts[by[s]]
        take[length] = take.get(length, 0) + k
        s -= length * k
    return take


def _parts(counts: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """(units, length, documents) of groups of documents of a length, none above ``most`` units, by which any number up to the count can be put together.

    Single documents of every length come first, then pairs and so on. Lengths are mixed by a hash: few neighbouring parts then make many different sums.
    """
    parts = []
    for length, left in counts.items():
        k, top, turn = 1, max(1, most // length), 0
        while left > 0:
            k = min(k, left)
            parts.append((turn, length * 0x9E3779B1 & 0xFFFFFFFF, length, k))
            left -= k
            k, turn = k * 2 if k * 2 <= top else k, turn + 1
    return [(length * k, length, k) for _, _, length, k in sorted(parts)]


def fit(counts: dict[int, tuple[int, int]], gap: int) -> dict[int, int]:
    """How many documents of each length to add, or if negative to give back, so that the sum is the largest that is at most ``gap`` (0 or more).

    ``counts``: length -> (taken, not taken). Exact: no length and no document is left out. Balanced subset sums (Pisinger 1999): parts are added while the
    sum is at most the gap and given back while it is above, so sums stay within one longest document of the gap, and every selection can be reached like that.
    Added parts go in one fixed order, given back ones in another; ``kept[sum]`` is how many of the latter were not passed yet, and of two ways to
    a sum the one with more left is as good for whatever follows. Each improvement of ``kept`` is a step that names the one before it, so the way back is exact.

    Of a length at most longest + gap / length documents are changed, as more never help: in a best change with the fewest documents no added ones
    weigh the same as some given back, and among any ``length`` documents some weigh a multiple of ``length``, at most ``longest`` times.

    So the work is bounded by the longest document and the units of the source, never by its budget; it ends as soon as the gap is met.
    """
    unit = math.gcd(*counts)  # sums are multiples of it
    if gap < unit or not unit:
        return {}
    counts, gap = {x // unit: c for x, c in counts.items()}, gap // unit
    most = max(counts)
    adds, backs = (_parts({x: min(c[i], most + gap // x) for x, c in counts.items()}, most) for i in (1, 0))
    backs.reverse()
    weight = np.array([w for w, _, _ in backs], dtype=np.int64)
    later = np.full(len(backs), len(backs))  # the next part of the same weight: it is given back before this one
    order = np.argsort(weight, kind="stable")
    same = weight[order][1:] == weight[order][:-1]
    later[order[:-1][same]] = order[1:][same]
    low = min(0, gap - most + 1)
    top = gap - low  # where the gap is in the arrays; they go one longest document beyond it
    kept, step, seen = (np.full(top + most + 1, x, dtype=np.int64) for x in (-1, 0, 0))
    kept[-low] = len(backs)
    before, part = array("q", [0]), array("q", [0])  # of each step: the one before; i for the i-th added part, -i for the i-th given back, from 1

    def note(at: np.ndarray, value: np.ndarray, steps: np.ndarray, parts: np.ndarray) -> None:
        kept[at], step[at] = value, np.arange(len(before), len(before) + len(at))
        before.frombytes(np.ascontiguousarray(steps, dtype=np.int64).tobytes())
        part.frombytes(np.ascontiguousarray(parts, dtype=np.int64).tobytes())

    idle: dict[int, int] = {}
    for i, (w, _, _) in enumerate(adds, 1):
        if kept[top] >= 0:
            break
        if idle.get(w) == len(before):  # an equal part changed nothing, and nothing has changed since
            continue
        better = np.flatnonzero(kept[: top + 1] > kept[w : w + top + 1])
        idle[w] = len(before)
        note(better + w, kept[better], step[better], np.full(len(better), i))
        above = (-(better + w)[better + w > top]).tolist()
        heapq.heapify(above)
        while above and kept[top] < 0:
            s = -heapq.heappop(above)
            a, b = int(seen[s]), int(kept[s])
            if a >= b:
                continue
            seen[s] = b
            j = a + np.flatnonzero(later[a:b] >= b)
            at = s - weight[j]
            good = kept[at] < j
            at, j = at[good], j[good]
            note(at, j, np.full(len(j), step[s]), -j - 1)
            for x in (-at[at > top]).tolist():
                heapq.heappush(above, x)
    change: dict[int, int] = {}
    at = int(step[np.flatnonzero(kept[: top + 1] >= 0)[-1]])
    while at:
        i = part[at]
        _, length, k = adds[i - 1] if i > 0 else backs[-i - 1]
        change[length * unit] = change.get(length * unit, 0) + (k if i > 0 else -k)
        at = before[at]
    return {x: k for x, k in change.items() if k}


def taken_up_to(rank: Column, budget: Column, size: Column, rows: Column) -> Column:
    """How many of the first ``rank`` documents are taken: min(ceil(rank x budget / size), floor(rows x budget / size)), exact for sizes below 10^18."""
    wide = lambda c: c.cast("decimal(19,0)") * budget.cast("decimal(18,0)")
    div = lambda a: F.call_function("div", a, size.cast("decimal(19,0)"))
    return F.least(div(wide(rank) + size.cast("decimal(19,0)") - F.lit(1)), div(wide(rows)))


def budgets(sizes: dict[str, int], targets: Iterable[tuple[str, float, int]]) -> dict[str, int]:
    """Units each source is to give. Sources without documents or weight give none and don't bound the total."""
    use = [(s, Fraction(w).limit_denominator(10**9), m) for s, w, m in targets if w and w > 0 and sizes.get(s, 0) > 0 and m and m > 0]
    if not use:
        return {}
    total = min(Fraction(m * sizes[s]) / w for s, w, m in use)
    return {s: int(total * w) for s, w, _ in use}


def mix(sizes: DataFrame, targets: DataFrame, row_id: str, source: str = "source", size: str = "n_tokens", seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: ``row_id``, source, size and ``copies`` >= 1 of every chosen document. shares: per source of ``targets`` its weight, cap, size,
    target_tokens, tokens reached, share reached, repeats (tokens / size) and documents. Documents of size 0 or of other sources are never
    chosen. A document's copies never pass the cap. ``row_id`` must be unique; targets must have one row per source.
    """
    ranked, plan, extras, shares = _planned(sizes, targets, row_id, source, size, seed)
    upto = lambda r: taken_up_to(r, F.col("_b"), F.col("_s"), F.col("_rows"))
    # of the documents of a length that are not taken by rank, the first _k are extra; if _k < 0, the first -_k that are taken are given back
    before = (F.col("_rank") - F.col("_a") + 1) - (F.col("_upto") - upto(F.col("_a") - 1))
    rows = ranked.join(F.broadcast(plan), "source").withColumn("_upto", upto(F.col("_rank"))).withColumn("_hit", F.col("_upto") > upto(F.col("_rank") - 1))
    rows = rows.join(F.broadcast(extras), ["source", "n_tokens"], "left")  # lengths the knapsack changes: no more than the longest document has units
    back = F.col("_hit") & (F.col("_upto") - upto(F.col("_a") - 1) <= -F.col("_k"))
    extra = ~F.col("_hit") & (before <= F.col("_k"))
    chosen = F.when(F.col("_k").isNull(), F.col("_hit")).otherwise((F.col("_hit") & ~back) | extra)
    selection = rows.withColumn("copies", F.col("_passes") + chosen.cast("long")).filter("copies > 0").select(row_id, "source", "n_tokens", "copies")
    return selection, shares


def _by_source(counted: DataFrame) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in counted.select("source", "n_tokens", "n", "_a", "_t").orderBy("source", "n_tokens").collect():
        out.setdefault(r["source"], []).append(r)
    return out


def _planned(sizes: DataFrame, targets: DataFrame, row_id: str, source: str, size: str, seed: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ranked documents; per source _b, _s, _rows, _passes; per length with more or fewer documents its first rank _a and the difference _k; the report."""
    spark = sizes.sparkSession
    goal = targets.select(F.col("source").alias("_s"), "weight", "max_repeats").collect()  # fixed table
    rows = staged(sizes.filter(F.col(size) > 0).select(row_id, F.col(source).alias("source"), F.col(size).cast("long").alias("n_tokens")).filter(F.col("source").isin([g["_s"] for g in goal])))
    ranked = number_rows(rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(row_id))), ["source"], [F.col("n_tokens"), F.col("_h"), F.col(row_id)], "_rank").drop("_h")
    hist = staged(ranked.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("_a")))
    sums = {r["source"]: r for r in hist.groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n_tokens")).alias("size")).collect()}  # a row per source
    release(rows)
    whole = {s: r["size"] for s, r in sums.items()}
    want = budgets(whole, [(g["_s"], g["weight"], g["max_repeats"]) for g in goal])
    use = {s: divmod(b, whole[s]) for s, b in want.items()}
    # one row per source of the targets
    plan = spark.createDataFrame([(s, rest, whole[s], sums[s]["n"], passes) for s, (passes, rest) in use.items()] or [("", 0, 1, 0, 0)], "source string, _b long, _s long, _rows long, _passes long")
    upto = lambda r: taken_up_to(r, F.col("_b"), F.col("_s"), F.col("_rows"))
    counted = hist.join(F.broadcast(plan), "source").withColumn("_t", upto(F.col("_a") + F.col("n") - 1) - upto(F.col("_a") - 1))
    base = {r["source"]: r for r in counted.groupBy("source").agg(F.sum(F.col("_t") * F.col("n_tokens")).alias("units"), F.sum("_t").alias("docs")).collect()}  # a row per source
    left = {s: rest - base[s]["units"] for s, (_, rest) in use.items()}
    half = F.floor(2 * F.log2("n_tokens"))
    step = counted.filter("_b > 0").withColumn("_h", half).withColumn("_i", F.row_number().over(Window.partitionBy("source", "_h").orderBy("n_tokens"))).filter(F.col("_i") <= STEPS)
    lengths = _by_source(step)  # at most STEPS x 62 rows per source
    changes = {s: subset_sum({r["n_tokens"]: r["n"] - r["_t"] for r in lengths.get(s, [])}, gap) for s, gap in left.items()}
    missed = [s for s, gap in left.items() if sum(x * k for x, k in changes[s].items()) < gap]
    if missed:
        for s, own in _by_source(counted.filter(F.col("source").isin(missed))).items():  # a row per length of a source
            lengths[s], changes[s] = own, fit({r["n_tokens"]: (r["_t"], r["n"] - r["_t"]) for r in own}, left[s])
    extras, report = [], []
    for g in goal:
        s = g["_s"]
        (passes, _), own, change = use.get(s, (0, 0)), lengths.get(s, []), changes.get(s, {})
        extras += [(s, r["n_tokens"], r["_a"], change[r["n_tokens"]]) for r in own if change.get(r["n_tokens"])]
        docs = sums[s]["n"] if passes else (base[s]["docs"] if s in base else 0) + sum(change.values())
        reached = passes * whole.get(s, 0) + (base[s]["units"] if s in base else 0) + sum(x * k for x, k in change.items())
        report.append((s, g["weight"], g["max_repeats"], whole.get(s, 0), want.get(s, 0), reached, docs))
    release(hist)
    everything = sum(r[5] for r in report) or 1
    shares = spark.createDataFrame(
        [(s, w, m, n, b, t, t / everything, t / n if n else 0.0, docs) for s, w, m, n, b, t, docs in report],
        "source string, weight double, max_repeats int, source_tokens long, target_tokens long, tokens long, share double, repeats double, documents long",
    )
    return ranked, plan, spark.createDataFrame(extras or [("", -1, 0, 0)], "source string, n_tokens long, _a long, _k long"), shares
