"""Relation graphs: weights, adjacency, static PageRank, closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed, release, staged
from .chunks import chunked, number_rows
from .skew import hot_keys, salted_join

#: Our choice; the original leaves both to an external tool.
DAMPING, ITERATIONS = 0.85, 30
#: Rounds between two staged tables.
STAGE = 5


def weights(pairs: DataFrame, a: str, b: str, freq: str, least: int = 1) -> DataFrame:
    """a, b, weight = sum of freq, where above ``least``."""
    return pairs.groupBy(a, b).agg(F.sum(freq).alias("weight")).filter(F.col("weight") > least)


def relation_counts(pairs: DataFrame, a: str, b: str, least: int = 1) -> DataFrame:
    """a, b, n for pairs of different ends that occur more than ``least`` times."""
    return pairs.filter(F.col(a) != F.col(b)).groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)


def adjacency(edges: DataFrame, node: str, other: str, count: str, chunk: int = 10_000) -> DataFrame:
    """node, chunk_no, edges: its neighbours as an array of (count, other), by other, in lists of at most ``chunk``."""
    own = staged(edges.select(node, other, count))  # cutting it into ranges reads it twice
    c = chunked(own, [node], [F.col(other), F.col(count)], chunk)
    release(own)
    e = F.array_sort(F.collect_list(F.struct("row_no", count, other)))
    return c.groupBy(node, "chunk_no").agg(e.alias("_e")).select(node, "chunk_no", F.transform("_e", lambda x: F.struct(x[count].alias("count"), x[other].alias("other"))).alias("edges"))


def node_ids(edges: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """node, id: numbers 0.. in the order in which nodes are first seen (``a`` before ``b`` of a row)."""
    seen = edges.select(F.explode(F.array(F.struct(F.col(a).alias("node"), (F.col(order) * 2).alias("at")), F.struct(F.col(b).alias("node"), (F.col(order) * 2 + 1).alias("at")))).alias("s")).select("s.*")
    first = seen.groupBy("node").agg(F.min("at").alias("at")).withColumn("_all", F.lit(0))
    return number_rows(first, ["_all"], [F.col("at")], "id").select("node", (F.col("id") - 1).alias("id"))


def page_rank(edges: DataFrame, a: str, b: str, weight: str | None = None, damping: float = DAMPING, iterations: int = ITERATIONS, both_ways: bool = False) -> DataFrame:
    """node, prob; ranks add up to 1, and nodes without a way out give their rank to all.

    Giving lost rank to all nodes alike only scales every rank by the same factor, so rounds leave it out and the end result is scaled
    to 1: no round needs a sum over all nodes. The edges with their share of the node's rank are written once, bucketed by their source (hot
    sources also by a salt), and the nodes by themselves: a round reads both where they lie and moves only ranks and their partial sums.
    Every ``STAGE`` rounds the ranks are staged, which ends the lineage.
    """
    e = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("s"), F.col(b).alias("t"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    if both_ways:
        e = e.unionByName(e.select(F.col("t").alias("s"), F.col("s").alias("t"), "w"))
    e = staged(e.groupBy("s", "t").agg(F.sum("w").alias("w")))
    hot = hot_keys(e, ["s"])
    total = e.groupBy("s").agg(F.sum("w").alias("_t"))
    shares = salted_join(e, total, ["s"], "t", hot).select("s", "t", (F.col("w") / F.col("_t")).alias("w"))
    nodes = bucketed(e.select(F.explode(F.array("s", "t")).alias("node")).distinct(), ["node"])
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("prob"))
    salts = max(2, int(e.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = F.xxhash64("s").isin(hot) if hot else F.lit(False)
    on = ["s", "salt"] if hot else ["s"]
    out = bucketed(shares.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("t"), F.lit(salts))).otherwise(F.lit(0)).cast("int")) if hot else shares, on)
    release(e)

    def given(rank: DataFrame) -> DataFrame:
        r = rank.select(F.col("node").alias("s"), "prob")
        if hot:
            r = r.withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
        # the ranks of a bucket are hashed, so the edges need no sort in any round
        return out.join(r.hint("shuffle_hash"), on).groupBy(F.col("t").alias("node")).agg(F.sum(F.col("prob") * F.col("w")).alias("in"))

    rank, old = nodes.select("node", F.lit(1.0 / n).alias("prob")), None
    for k in range(iterations):
        rank = nodes.join(given(rank).hint("shuffle_hash"), "node", "left").select("node", (F.lit((1 - damping) / n) + damping * F.coalesce("in", F.lit(0.0))).alias("prob"))
        if k % STAGE == STAGE - 1 or k == iterations - 1:
            rank = staged(rank)
            if old is not None:
                release(old)
            old = rank
    whole = rank.agg(F.sum("prob").alias("x")).first()["x"]
    return rank.select("node", (F.col("prob") / F.lit(whole)).alias("prob"))


def with_ids(edges: DataFrame, ids: DataFrame, a: str, b: str) -> DataFrame:
    """``edges`` with the numbers of ``ids`` (node, id) in place of both ends. Hot ends are salted. An end without a number raises an error."""
    out = edges
    for end, other in ((a, b), (b, a)):
        j = salted_join(out, ids.select(F.col("node").alias(end), F.col("id").alias("_id")), [end], other, hot_keys(out, [end]), "left")
        known = F.when(F.col("_id").isNull(), F.raise_error(F.concat(F.lit("node not found: "), F.col(end).cast("string")))).otherwise(F.col("_id"))
        out = j.withColumn(end, known).select(*edges.columns)
    return out


def closure(edges: DataFrame, a: str, b: str, rounds: int = 64) -> DataFrame:
    """(a, b) for every b that can be reached from a: paths double in length each round, until nothing is new. Circles end.

    64 rounds are paths of 2^64 steps; should they not do, an error is raised. Only the last round's table is kept.
    """
    cur = staged(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    n = cur.count()
    for _ in range(rounds):
        step = cur.join(cur.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        new = staged(cur.unionByName(step).distinct())
        release(cur)
        cur, before, n = new, n, new.count()
        if n == before:
            return cur.select(F.col("a").alias(a), F.col("b").alias(b))
    raise RuntimeError(f"the closure is not complete after {rounds} rounds")
