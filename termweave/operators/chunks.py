"""Exact numbering of rows within keys and per-key work in equal chunks, whatever the sizes of the keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import release, staged
from .skew import unused

#: Rows of a key that one chunk holds.
CHUNK = 100_000


def _changes(col: pa.Array) -> np.ndarray:
    """True at i if value i+1 differs from value i; null equals null."""
    codes = pc.dictionary_encode(col, null_encoding="encode")
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy(zero_copy_only=False)
    return codes[1:] != codes[:-1]


def run_places(keys: list[str], names: list[str], schema: pa.Schema):
    """Over batches sorted by ``keys``: the rows with partition, place in it, place in their run, and whether their run is the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, pos, last, at, first = TaskContext.get().partitionId(), 0, None, 0, True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            here = [b.column(names.index(k)) for k in keys]
            new = np.zeros(n, dtype=bool)
            for c in here:
                new[1:] |= _changes(c)
            new[0] = last is not None and last != [c[0].as_py() for c in here]
            starts = np.flatnonzero(new)
            # a row's place in its run: distance from the run's start; the run that began in an earlier batch goes on
            base = np.full(n, -1, dtype=np.int64)
            base[starts] = starts
            base = np.maximum.accumulate(base)
            place = np.where(base >= 0, np.arange(n) - base, np.arange(n) + at)
            flag = (base < 0) & first
            last, at, first = [c[n - 1].as_py() for c in here], int(place[-1]) + 1, bool(flag[-1])
            extra = [pa.array(np.full(n, pid, dtype=np.int32)), pa.array(np.arange(pos, pos + n)), pa.array(place), pa.array(flag)]
            pos += n
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], schema=pa.schema([*b.schema, *schema]))

    return run


def number_rows(df: DataFrame, keys: list[str], order: list[Column], name: str = "row_no", partitions: int | None = None) -> DataFrame:
    """Add ``name``: 1, 2, ... within each key, in ``order`` (give a total order).

    Rows are cut into ranges of (key, order), so a key with a third of all rows spreads over a third of the partitions. Each
    partition counts the rows of its keys; only its first key can have begun earlier, so the prefix sums are over one row per
    partition (that is all that reaches the driver and is broadcast). A row's number is its place in its partition plus that offset.
    The sorted rows are staged, so a lost executor can't change the cut. Null keys count as one key; an empty table gives no rows.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in df.columns if c.lower() != name.lower() or c in keys]  # a column of that name is replaced
    by = [F.col(k) for k in keys]
    ordered = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order).select(*kept)
    pid, pos, place, first = (unused(x, df) for x in ("_pid", "_pos", "_place", "_first"))
    extra = pa.schema([(pid, pa.int32()), (pos, pa.int64()), (place, pa.int64()), (first, pa.bool_())])
    out = T.StructType([*ordered.schema.fields, T.StructField(pid, T.IntegerType()), T.StructField(pos, T.LongType()), T.StructField(place, T.LongType()), T.StructField(first, T.BooleanType())])
    rows = staged(ordered.mapInArrow(run_places(keys, kept, extra), out))
    key = F.struct(*by)
    ends = (
        rows.groupBy(F.col(pid).alias("p"))
        .agg(F.min_by(key, pos).alias("head"), F.max_by(key, pos).alias("tail"), F.max_by(F.col(place) + 1, pos).alias("tail_n"), F.max_by(first, pos).alias("whole"))
        .orderBy("p")
        .collect()
    )
    offsets, tail, carried = [], None, 0
    for e in ends:
        start = carried if tail is not None and e["head"] == tail else 0
        offsets.append((e["p"], start))
        carried = e["tail_n"] + (start if e["whole"] else 0)
        tail = e["tail"]
    offset = unused("_offset", rows)
    offsets = spark.createDataFrame(offsets or [(-1, 0)], f"`{pid}` int, `{offset}` long")
    numbered = rows.join(F.broadcast(offsets), pid)
    return numbered.select(*kept, (F.col(place) + 1 + F.when(F.col(first), F.col(offset)).otherwise(F.lit(0))).alias(name))


def _starts(keys: list[str], names: list[str], value: str | None, keep: list[str], name: str, later: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, pos, runs, head, last, start = TaskContext.get().partitionId(), 0, 0, None, None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            here = [b.column(names.index(k)) for k in keys]
            new = np.zeros(n, dtype=bool)
            for c in here:
                new[1:] |= _changes(c)
            key = [c[0].as_py() for c in here]
            new[0] = head is None or last != key
            head = key if head is None else head
            own = np.arange(pos, pos + n) + (pid << 33) if value is None else b.column(names.index(value)).to_numpy(zero_copy_only=False)
            at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            starts = np.where(at >= 0, own[np.maximum(at, 0)], start)
            number = np.cumsum(new) + runs
            first = number == 1
            pos, runs, last, start = pos + n, int(number[-1]), [c[n - 1].as_py() for c in here], int(starts[-1])
            cols = [*[b.column(names.index(c)) for c in keep], pa.array(starts), pa.array(np.full(n, pid, dtype=np.int32)), pa.array(first), *[pa.nulls(n, f.type) for f in list(schema)[len(keep) + 3 :]]]
            out = pa.RecordBatch.from_arrays(cols, schema=schema)
            yield out.filter(pa.array(~new | first)) if later else out
        if head is not None:  # one more row: what the next partition has to know of this one
            edge = [*[None] * len(keep), start, pid, runs == 1, *head, *last]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(edge + [True], schema)], schema=schema)

    return run


def run_starts(df: DataFrame, keys: list[str], order: list[Column], value: str | None, keep: list[str], name: str, later: bool = False) -> DataFrame:
    """``keep`` and ``name``: the ``value`` (a long, not null) of the first row of the row's key, in ``order`` (give a total order).

    Without ``value`` a number that no other key has. ``later`` leaves out the first row of each key; its ``value`` must then be unique in the key.
    One shuffle into ranges of (key, order), so a key with a third of all rows spreads over a third of the partitions. Only the first
    key of a range can have begun earlier: one row per partition reaches the driver. Null keys count as one key.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k) for k in keys]
    ordered = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    names = ordered.columns
    fields = [*[ordered.schema[c] for c in keep], T.StructField(name, T.LongType()), T.StructField("_pid", T.IntegerType()), T.StructField("_first", T.BooleanType())]
    fields += [T.StructField(f"_{side}{i}", ordered.schema[k].dataType) for side in "ht" for i, k in enumerate(keys)] + [T.StructField("_edge", T.BooleanType())]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    rows = staged(ordered.mapInArrow(_starts(keys, names, value, keep, name, later, to_arrow_schema(out)), out))
    carried, tail, offsets = None, None, []
    for e in rows.filter("_edge").orderBy("_pid").collect():
        head, end = [e[f"_h{i}"] for i in range(len(keys))], [e[f"_t{i}"] for i in range(len(keys))]
        begun = carried if tail is not None and head == tail else None
        offsets.append((e["_pid"], begun))
        carried = begun if e["_first"] and begun is not None else e[name]
        tail = end
    border = spark.createDataFrame(offsets or [(-1, None)], "_pid int, _begun long")
    start = F.when(F.col("_first"), F.coalesce("_begun", name)).otherwise(F.col(name))
    done = rows.filter("_edge is null").join(F.broadcast(border), "_pid").withColumn(name, start)
    if later:
        done = done.filter(F.col(value) != F.col(name))
    done = done.select(*keep, name)
    done._staged_at = rows._staged_at
    return done


def chunked(df: DataFrame, keys: list[str], order: list[Column], chunk_rows: int = CHUNK) -> DataFrame:
    """``number_rows`` plus ``chunk_no``: chunks of exactly ``chunk_rows`` rows of a key (the last may be shorter)."""
    return number_rows(df, keys, order).withColumn("chunk_no", F.expr(f"(row_no - 1) div {int(chunk_rows)}"))


def merge_chunks(chunks: DataFrame, keys: list[str], sums: list[str], carry: list[str]) -> DataFrame:
    """Per key the results of ``chunked`` rows: ``n_rows``, the sums of ``sums``, and ``carry`` of the first and the last row.

    Each chunk of a key becomes one state (count, sums, first row, last row); states are made before the shuffle, and those of a key
    are merged in chunk order. A key brings rows/chunk + partitions states together, never its rows.
    """
    row = F.struct(*[F.col(c) for c in carry])
    states = chunks.groupBy(*keys, "chunk_no").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums], F.min_by(row, "row_no").alias("_head"), F.max_by(row, "row_no").alias("_tail")
    )
    merged = states.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), *[F.sum(f"_s_{c}").alias(c) for c in sums], F.min_by("_head", "chunk_no").alias("_head"), F.max_by("_tail", "chunk_no").alias("_tail")
    )
    return merged.select(*keys, "n_rows", *sums, *[F.col("_head")[c].alias(f"first_{c}") for c in carry], *[F.col("_tail")[c].alias(f"last_{c}") for c in carry])


def ranked_items(df: DataFrame, key: str, item: str, scores: dict[str, Column], chunk_rows: int = CHUNK) -> DataFrame:
    """Per key its distinct items in order of merit, in chunks: key, ``row_no`` (1 is the best), item, ``copies``, the scores, ``chunk_no``.

    ``scores`` are aggregates (name to Column), best first when larger; null is worst; ties go to the smaller item. Equal (key, item)
    rows are combined before the shuffle; then the items of a key are numbered by ``chunked``. Rows with a null key or item count as such.
    """
    # staged, as cutting it into ranges reads it twice
    pairs = staged(df.groupBy(key, item).agg(F.count(F.lit(1)).alias("copies"), *[c.alias(n) for n, c in scores.items()]))
    out = chunked(pairs, [key], [*[F.col(n).desc_nulls_last() for n in scores], F.col(item).asc_nulls_last()], chunk_rows)
    release(pairs)
    return out
