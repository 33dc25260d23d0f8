"""Text cut off by field limits.

Two kinds of evidence:

* ``length_spikes``: per source and column, histograms of the lengths in characters and in bytes. A length that holds far more values than the
  lengths around it is the maximum of a field that the values went through; values of that length without terminal punctuation are
  suspects. It need not be the largest length of the source: a source may bring values that went through several fields, or none.
  This needs nothing but the column, but says nothing about values cut during a transfer at any length.
* ``continued``: a value that is no known label of its concept but the beginning of one. Exact, and finds cuts at any length.

``continued`` is a merge: known labels and values are sorted by (concept, text) in byte order; what begins with a value follows it at
once, so a value has a continuation iff the next known label begins with it. Rows are cut into ranges of (concept, text), so a concept
with a third of all rows is many tasks; the first label of each range is all that one range needs from the next (one row per partition
reaches the driver).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_key, core
from ..operators.skew import hot_keys, salted_join
from ..session import small, staged

# What ends a sentence or an item, and what stands for a cut.
TERMINAL = ".!?。！？)]}\"'”»"
ELLIPSES = r"(\.\.|…)\s*$"
#: A spike holds at least so many values, and so many times the mean of the WINDOW lengths below it.
LEAST, TIMES, WINDOW = 20, 5.0, 10
#: A limit in bytes cuts before a character that doesn't fit, so lengths up to 3 below the largest belong to it.
SLACK = 3


def open_end(v: Column) -> Column:
    """No terminal punctuation, or an ellipsis."""
    return ~F.substring(F.rtrim(v), -1, 1).isin(*TERMINAL) | v.rlike(ELLIPSES)


def length_histogram(df: DataFrame, source: str, column: str) -> DataFrame:
    """source, unit (chars, bytes), len, n, n_open (without terminal punctuation). Null values are left out, a null source is a source."""
    v = F.col(column)
    base = df.filter(v.isNotNull()).select(F.col(source).alias("source"), F.length(v).alias("chars"), F.octet_length(v).alias("bytes"), open_end(v).cast("int").alias("o"))
    both = base.groupBy("source", "chars", "bytes").agg(F.count(F.lit(1)).alias("n"), F.sum("o").alias("n_open"))
    long = both.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("len")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("len")))).alias("u"), "n", "n_open")
    return long.groupBy("source", "u.unit", "u.len").agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))


def length_spikes(hist: DataFrame) -> DataFrame:
    """The lengths of a histogram that are field limits. Works on (source, unit, len) rows, of which there are as many as lengths.

    A spike holds the lengths from_len to len, more than one only where the limit is in bytes; n and n_open count all of them.
    """
    w = Window.partitionBy("source", "unit").orderBy("len")
    # counts of the WINDOW lengths below, missing lengths counting as zero
    below = F.sum("n").over(w.rangeBetween(-WINDOW - SLACK, -SLACK - 1)) / F.lit(WINDOW)
    near = F.sum("n").over(w.rangeBetween(-SLACK, 0))
    near_open = F.sum("n_open").over(w.rangeBetween(-SLACK, 0))
    above = F.sum("n").over(w.rangeBetween(1, WINDOW)) / F.lit(WINDOW)
    usual = F.greatest("below", "above", F.lit(1.0))
    # a limit of C characters leaves spikes of C and a few more bytes, but fewer values there than of C characters
    chars = F.max(F.when(F.col("unit") == "chars", F.col("n"))).over(Window.partitionBy("source").orderBy("len").rangeBetween(-SLACK, 0))
    in_bytes = (F.col("unit") == "bytes") & (F.coalesce("chars", F.lit(0)) <= F.col("n"))
    alone = (F.col("n") >= LEAST) & (F.col("n") > TIMES * usual)
    # the lengths of the slack hold the usual number each besides what is cut; the last one must stand out itself, or it isn't the limit
    together = in_bytes & (F.col("near") >= LEAST) & (F.col("near") > (TIMES + SLACK) * usual) & (F.col("n") > TIMES * F.greatest("above", F.lit(1.0)))
    counted = hist.withColumn("below", F.coalesce(below, F.lit(0.0))).withColumn("near", near).withColumn("near_open", near_open).withColumn("above", F.coalesce(above, F.lit(0.0))).withColumn("chars", chars)
    # what lies at most SLACK below another spike is within it
    higher = F.max("covers").over(w.rangeBetween(1, SLACK))
    spikes = counted.withColumn("alone", alone).filter(alone | together).withColumn("covers", in_bytes).withColumn("within", F.coalesce(higher, F.lit(False)))
    covers = F.col("covers") & ~F.col("within")
    return (
        spikes.filter(F.col("alone") | ~F.col("within"))
        .select("source", "unit", F.when(covers, F.greatest(F.col("len") - SLACK, F.lit(0))).otherwise(F.col("len")).alias("from_len"), "len", F.when(covers, F.col("near")).otherwise(F.col("n")).alias("n"), F.when(covers, F.col("near_open")).otherwise(F.col("n_open")).alias("n_open"), "below", "above")
    )


def suspects(df: DataFrame, source: str, column: str, keep: list[str]) -> DataFrame:
    """``keep`` of the values at a length of a spike (in characters or bytes) without terminal punctuation.

    The spikes' lengths are staged and broadcast if they are small; else the values are joined by shuffle, with salt for lengths of many.
    """
    lengths = length_spikes(length_histogram(df, source, column)).select(F.col("source").alias("s"), F.col("unit").alias("u"), F.explode(F.sequence("from_len", "len")).alias("l"))
    spikes = staged(lengths.select(F.struct("s", "u", "l").alias("_k")).distinct())
    v = F.col(column)
    at = lambda unit, n: F.struct(F.col(source).alias("s"), F.lit(unit).alias("u"), n.alias("l"))
    rows = df.filter(v.isNotNull() & open_end(v)).select(*keep, F.explode(F.array(at("chars", F.length(v)), at("bytes", F.octet_length(v)))).alias("_k")).withColumn("_u", F.xxhash64(*keep))
    j = rows.join(F.broadcast(spikes), "_k", "left_semi") if small(spikes) else salted_join(rows, spikes, ["_k"], "_u", hot_keys(rows, ["_k"]), "left_semi")
    return j.select(*keep).distinct()


def known_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(clean_key(key).alias("k"), core(label).alias("v"))


OUT = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("case", T.BooleanType()), T.StructField("pid", T.IntegerType()), T.StructField("head", T.BooleanType()), T.StructField("open", T.BooleanType())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, v, known) in descending order. Emits the values that no known label of this range decides (open), the values decided to
    be cut (case), and the smallest known label of the range (head)."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    lk = lv = None  # the known label last passed: the next larger one
    schema = pa.schema([("k", pa.string()), ("v", pa.string()), ("case", pa.bool_()), ("pid", pa.int32()), ("head", pa.bool_()), ("open", pa.bool_())])
    for b in batches:
        ks, vs, known = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
        out = []
        for k, v, is_known in zip(ks, vs, known):
            if is_known:
                lk, lv = k, v
            elif lk is None:
                out.append((k, v, False, True))
            elif k == lk and lv != v and lv.startswith(v):
                out.append((k, v, True, False))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out]), pa.array(np.full(len(out), pid, np.int32)), pa.array([False] * len(out)), pa.array([o[3] for o in out])], schema=schema)
    if lk is not None:
        yield pa.RecordBatch.from_arrays([pa.array([lk]), pa.array([lv]), pa.array([False]), pa.array([pid], pa.int32()), pa.array([True]), pa.array([False])], schema=schema)


def continued(values: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct (k, v) of ``values`` that equal no known (k, v) but begin one of the same k."""
    spark = values.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # known beats value at the same (k, v), so a value that is known never comes out
    both = known.select("k", "v", F.lit(True).alias("known")).unionByName(values.select("k", "v", F.lit(False).alias("known"))).groupBy("k", "v").agg(F.max("known").alias("known"))
    desc = [F.desc("k"), F.desc("v")]
    scanned = staged(both.repartitionByRange(n, *desc).sortWithinPartitions(*desc).mapInArrow(_scan, OUT))
    heads = scanned.filter("head").orderBy("pid").select("pid", "k", "v").collect()  # at most one row per partition
    # ranges descend, so the next larger known label of range p is the head of the nearest range before it
    nxt, last = [], None
    by_pid = {h["pid"]: (h["k"], h["v"]) for h in heads}
    for pid in range(n):
        if last is not None:
            nxt.append((pid, *last))
        last = by_pid.get(pid, last)
    border = spark.createDataFrame(nxt or [(-1, "", "")], "pid int, nk string, nv string")
    opened = scanned.filter("open").join(F.broadcast(border), "pid").filter((F.col("k") == F.col("nk")) & (F.col("v") != F.col("nv")) & F.col("nv").startswith(F.col("v")))
    return scanned.filter("case").select("k", "v").unionByName(opened.select("k", "v"))


def _reject_constant(name: str) -> None:
    raise ValueError(name)


@F.pandas_udf(T.BooleanType())
def whole_json_array(texts: pd.Series) -> pd.Series:
    """Whether the text is exactly one complete JSON array, white space around it allowed. Null is not."""

    def ok(x: str | None) -> bool:
        if x is None or not (s := x.strip()).startswith("[") or not s.endswith("]"):
            return False
        try:
            return isinstance(json.loads(s, parse_constant=_reject_constant), list)
        except ValueError:
            return False
        except RecursionError:  # nested too deep to build; brackets are then counted outside strings
            return _balanced(s)

    return texts.map(ok).astype(bool)


def _balanced(s: str) -> bool:
    depth, inside, skip = 0, False, False
    for i, ch in enumerate(s):
        if skip:
            skip = False
        elif inside:
            skip, inside = ch == "\\", ch != '"'
        elif ch == '"':
            inside = True
        elif ch in "[{":
            depth += 1
        elif ch in "]}":
            depth -= 1
            if depth == 0 and i < len(s) - 1:
                return False
    return depth == 0 and not inside
