"""Filling containers of fixed capacity: best fit over a histogram of lengths, then rows take their planned slots.

The plan works on counts. Lengths are taken from the longest down; ``bins`` holds groups of equal containers (free room, how many,
first number). All items of a length go to the groups with the least sufficient room, each container of a group taking as many as fit;
what is left opens new containers. A step costs per group, not per item, so a plan over 10^11 items takes as long as over 10^5. This is
best-fit decreasing. The histogram has at most ``capacity`` lengths, so it is small wherever it is collected.

How many slot runs there are: a step takes up a whole group and leaves at most one, or it is the last of its length and leaves at most three;
opening containers leaves two. So a length adds at most four groups, the k-th length takes at most 4k + 1 steps of two runs at most, and
the plan has at most 4 x capacity^2 + 6 x capacity runs, whatever the number of items (thousands in practice). They are looked up by length, one
row per length, in a join that is salted for lengths with many items; whether that side is broadcast is left to Spark's measure of its size.

An item longer than the capacity is divided into full containers and one rest, which is an item like others. Items get their rank within
their length by exact numbering (``chunks.number_rows``, safe if one length has a third of all items), and a slot run of the plan gives
the container of each rank.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import number_rows
from ..operators.skew import hot_keys, salted_join
from ..session import staged

CAPACITY = 2048


@dataclass(frozen=True)
class SlotRun:
    """Items of ``size`` with ranks ``start``.. take ``each`` slots in each of ``bins`` containers from number ``first`` on."""

    size: int
    start: int
    each: int
    bins: int
    first: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY, first: int = 0) -> tuple[list[SlotRun], int]:
    """Slot runs for ``histogram`` (size -> number of items, 1 <= size <= capacity) and the number after the last container.

    A container takes items of one size in one or more runs; runs cover each rank of each size exactly once.
    """
    runs: list[SlotRun] = []
    rooms: list[int] = []  # sorted free rooms that occur
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first container, how many)
    number = first

    def put(room: int, start: int, many: int) -> None:
        if room > 0 and many > 0:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((start, many))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 1

        def take(start: int, many: int, room: int) -> None:
            """Fill ``many`` containers from ``start``, or as many as there are items for."""
            nonlocal left, rank
            fit = room // size
            whole = min(many, left // fit)
            if whole:
                runs.append(SlotRun(size, rank, fit, whole, start))
                left -= whole * fit
                rank += whole * fit
                put(room - fit * size, start, whole)
            rest = many - whole
            if rest and left:  # fewer items than one container takes
                runs.append(SlotRun(size, rank, left, 1, start + whole))
                put(room - left * size, start + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            if many - whole:
                put(room, start + whole, many - whole)

        while left:
            i = bisect.bisect_left(rooms, size)
            if i == len(rooms):
                break
            room = rooms[i]
            start, many = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            take(start, many, room)
        if left:
            many = -(-left // (capacity // size))
            start, number = number, number + many
            take(start, many, capacity)
    return runs, number


def pack(sizes: DataFrame, row_id: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """container, ``row_id``, piece, from_unit, to_unit, n_units: every unit of every item exactly once, no container above ``capacity``.

    ``sizes`` has one row per item. Piece 1.. of a divided item are its full containers and its rest. Items of size 0 (null counts as 0)
    need no room: they come out with container null and piece 1. Containers are numbered from 0.
    """
    spark = sizes.sparkSession
    rows = staged(sizes.select(F.col(row_id).alias("_row"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n")))
    full, rest = F.expr(f"_n div {capacity}"), F.col("_n") % capacity
    pieces = rows.withColumn("_full", full).withColumn("_rest", rest)
    histogram = {r["_rest"]: r["n"] for r in pieces.filter("_rest > 0").groupBy("_rest").agg(F.count(F.lit(1)).alias("n")).collect()}  # < capacity rows
    runs, number = plan(histogram, capacity)
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for r in runs:
        by_length.setdefault(r.size, []).append((r.start, r.start + r.each * r.bins - 1, r.each, r.first))
    slots = spark.createDataFrame(list(by_length.items()) or [(-1, [])], "_rest long, _runs array<struct<a: long, z: long, each: long, first: long>>")
    hot = hot_keys(spark.createDataFrame(list(histogram.items()) or [(-1, 0)], "_rest long, _k long"), ["_rest"], weight="_k")
    ranked = number_rows(pieces.filter("_rest > 0").select("_row", "_n", "_full", "_rest"), ["_rest"], [F.col("_row")], "_rank")
    placed = salted_join(ranked, slots, ["_rest"], "_row", hot).withColumn("_r", F.element_at(F.filter("_runs", lambda r: (F.col("_rank") >= r["a"]) & (F.col("_rank") <= r["z"])), 1))
    rests = placed.select(
        F.expr("_r.first + (_rank - _r.a) div _r.each").alias("container"), F.col("_row").alias(row_id), (F.col("_full") + 1).alias("piece"), (F.col("_full") * capacity).alias("from_unit"), F.col("_n").alias("to_unit"), F.col("_rest").alias("n_units")
    )
    # containers that one piece fills: numbered after the planned ones, by exact prefix sums over the divided items
    long = number_rows(pieces.filter("_full > 0").select("_row", "_full", F.explode(F.expr("sequence(1L, _full)")).alias("piece")).withColumn("_all", F.lit(0)), ["_all"], [F.col("_row"), F.col("piece")], "_k")
    fulls = long.select((F.col("_k") - 1 + number).alias("container"), F.col("_row").alias(row_id), "piece", ((F.col("piece") - 1) * capacity).alias("from_unit"), (F.col("piece") * capacity).alias("to_unit"), F.lit(capacity).cast("long").alias("n_units"))
    none = rows.filter("_n <= 0").select(F.lit(None).cast("long").alias("container"), F.col("_row").alias(row_id), F.lit(1).cast("long").alias("piece"), F.lit(0).cast("long").alias("from_unit"), F.lit(0).cast("long").alias("to_unit"), F.lit(0).cast("long").alias("n_units"))
    return rests.unionByName(fulls).unionByName(none)
