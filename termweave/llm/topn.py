"""Top N per group by partition lower bounds.

The N-th best row that any one input partition holds of a group is a bound: the group's N-th best row overall is at least as good.

1. Every input partition is sorted by group and merit where it is read. Of each group it keeps its N best rows; the N-th is its bound.
   What is kept is staged, so that bounds and rows are of the same cut.
2. The best bound of each group is joined to the rows that are left, and worse rows are dropped. All groups go this way; a group of which no
   partition holds N rows has no bound.
3. The survivors are ranked. Rows, bounds and ranking have the same key, so the rows are shuffled once.

After step 1 a group has at most N rows per partition, so no group is too large for one task, and whether the bounds are broadcast is left to
Spark's measure of their size.

The order is total: score descending, null last, then the tie columns ascending (null first), so equal scores can't fill a task.
Rows equal in all these are told apart by the last tie column, which must be unique. A null group is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chunks import run_places
from ..session import staged


def local_best(rows: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The ``n`` best rows of each group in each partition, and ``_nth``: whether a row is the n-th of them. No shuffle."""
    names = rows.columns
    extra = pa.schema([("_pid", pa.int32()), ("_pos", pa.int64()), ("_place", pa.int64()), ("_head", pa.bool_())])
    places = run_places([group], names, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in places(batches):
            b = b.filter(pc.less(b.column("_place"), n))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pc.equal(b.column("_place"), n - 1)], names=[*names, "_nth"])

    out = T.StructType([*rows.schema.fields, T.StructField("_nth", T.BooleanType())])
    return rows.sortWithinPartitions(F.col(group), *order).mapInArrow(run, out)


def top_n(df: DataFrame, group: str, score: str, ties: list[str], n: int = 3) -> DataFrame:
    """``group``, ``rnk`` 1..n and the tie columns of the n best rows of every group."""
    t = [f"_t{i}" for i in range(len(ties))]
    rows = df.select(F.col(group).alias("_g"), F.col(score).alias("_s"), *[F.col(c).alias(x) for c, x in zip(ties, t)])
    order = [F.col("_s").desc_nulls_last(), *[F.col(x).asc() for x in t]]
    # in a struct a null group equals itself, so that one key serves join and ranking
    best = staged(local_best(rows, "_g", order, n)).withColumn("_k", F.struct("_g"))
    tie = F.struct(*t)
    highest = best.filter("_nth").withColumn("_i", F.row_number().over(Window.partitionBy("_k").orderBy(*order))).filter("_i = 1")
    bounds = highest.select("_k", F.col("_s").alias("_bs"), tie.alias("_bt"))
    level = F.col("_s").eqNullSafe(F.col("_bs")) & (tie <= F.col("_bt"))
    better = F.col("_s").isNotNull() & (F.col("_bs").isNull() | (F.col("_s") > F.col("_bs")))
    kept = best.join(bounds, "_k", "left").filter(F.col("_bt").isNull() | better | level)
    ranked = kept.withColumn("rnk", F.row_number().over(Window.partitionBy("_k").orderBy(*order))).filter(F.col("rnk") <= n)
    return ranked.select(F.col("_g").alias(group), "rnk", *[F.col(x).alias(c) for c, x in zip(ties, t)])
