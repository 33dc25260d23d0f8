"""Copies hidden by formatting: dictionary-encoded records, grouped as integer tuples.

1. Each distinct raw value of a field is canonicalised once (not once per row) and kept, with its row count, in a dictionary table.
2. Each distinct canonical value gets an integer: the dictionary is sorted by canonical value, cut into ranges, and its runs are numbered.
   The field's number is mixed in, so integers of different fields never meet and a record is a set of integers without field names.
3. Records become sorted tuples of these integers; the encoded table is staged (row id and integers only).
4. Equal tuples are copies. ``collapse`` combines counts and smallest row ids before the shuffle; ``found`` sorts the tuples with their row ids
   into ranges, where a record's copies follow it at once: one shuffle, and a group of a third of all rows is many ranges.

A value with many rows is salted in the join that brings its integer (see ``skew``); integers are broadcast only if their files are below
Spark's threshold. Nulls: a null field has no integer, so records agree on it if it is null in both. Empty text is a value.
Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import run_starts
from ..operators.skew import hot_keys, salted_join
from ..session import release, small, staged


@dataclass(frozen=True)
class Field:
    """A column, and how its values are made canonical."""

    column: str
    canon: Callable[[str], Column]


def _dictionary(df: DataFrame, f: Field) -> DataFrame:
    """raw, canon, n of each distinct non-null value, staged."""
    return staged(df.filter(F.col(f.column).isNotNull()).groupBy(F.col(f.column).alias("raw")).agg(F.count(F.lit(1)).alias("n")).select("raw", f.canon("raw").alias("canon"), "n"))


def _ids(dictionary: DataFrame, number: int, fields: int) -> DataFrame:
    """raw -> integer of its canonical value."""
    found = run_starts(dictionary.select("raw", "canon"), ["canon"], [F.col("raw")], None, ["raw"], "id")
    ids = found.withColumn("id", F.col("id") * fields + number)
    ids._staged_at = found._staged_at
    return ids


def places(fields: list[Field]) -> list[str]:
    return [f"t{i}" for i in range(len(fields))]


def encode(df: DataFrame, row_id: str, fields: list[Field]) -> DataFrame:
    """``row_id`` and the sorted integers t0, t1, ... of every record, staged; the last ones are null if fields are."""
    out = df.select(F.col(row_id).alias("_row"), *[F.col(f.column).alias(f"_f{i}") for i, f in enumerate(fields)])
    sized = [(d.count(), i, d) for i, d in enumerate(_dictionary(df, f) for f in fields)]
    coded = [(i, _ids(d, i, len(fields)), hot_keys(d, ["raw"], weight="n")) for _, i, d in sized]
    release(*[d for _, _, d in sized])
    most = {i: n for n, i, _ in sized}
    # broadcast ones first, then the field with most values: later shuffles carry its integer, not its text
    for large, _, i, ids, hot in sorted(((not small(x), -most[i], i, x, hot) for i, x, hot in coded), key=lambda x: x[:3]):
        c = f"_f{i}"
        right = ids.select(F.col("raw").alias(c), F.col("id").alias(f"_id{i}"))
        out = (salted_join(out, right, [c], "_row", hot, "left") if large else out.join(F.broadcast(right), c, "left")).drop(c)
    codes = F.array_sort(F.array_compact(F.array(*[F.col(f"_id{i}") for i in range(len(fields))])))
    done = staged(out.select(F.col("_row").alias(row_id), codes.alias("_codes")).select(row_id, *[F.get("_codes", F.lit(i)).alias(t) for i, t in enumerate(places(fields))]))
    release(*[x for _, x, _ in coded])
    return done


def groups(encoded: DataFrame, row_id: str, fields: list[Field]) -> DataFrame:
    """The tuple, its smallest row id, and the number of copies."""
    return encoded.groupBy(*places(fields)).agg(F.min(row_id).alias("first_id"), F.count(F.lit(1)).alias("copies"))


def collapse(df: DataFrame, row_id: str, fields: list[Field]) -> DataFrame:
    """One record per set of copies: the columns of the row with the smallest id, and ``copies``."""
    g = groups(encode(df, row_id, fields), row_id, fields).select(F.col("first_id").alias(row_id), "copies")
    return df.join(g, row_id)


def found(df: DataFrame, row_id: str, fields: list[Field]) -> DataFrame:
    """line_a (smallest id), line_b (member) for every member but the first of each set of copies. ``row_id`` is a unique long."""
    encoded = encode(df, row_id, fields)
    later = run_starts(encoded, places(fields), [F.col(row_id)], row_id, [row_id], "first_id", later=True)
    release(encoded)
    return later.select(F.col("first_id").alias("line_a"), F.col(row_id).alias("line_b"))
