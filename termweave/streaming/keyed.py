"""Row operators and keyed merges on streams. Row operators are the batch ones; merges keep state per key."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import filter_literals
from ..operators.classes import class_info
from ..operators.freq import mention_counts


def cleaned_literals(stream: DataFrame, column: str) -> DataFrame:
    return filter_literals(stream, column)


def running_mention_counts(stream: DataFrame, mention: str = "mention", anchor: str = "anchor") -> DataFrame:
    """Mention counts so far; write in complete or update mode."""
    return mention_counts(stream, mention, anchor)


def _merge(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """A group comes in several frames, so it is reduced to the first line of each distinct value before anything is folded."""
    first: list[dict] = [{}, {}, {}]
    for f in frames:
        line = f["line_no"].fillna(float("inf"))
        for i, lines in enumerate(first):
            for v, n in line.groupby(f[f"v{i}"].fillna("")).min().items():
                lines[v] = min(n, lines.get(v, n))
    texts = list(state.get) if state.exists else [None] * 3
    for i, lines in enumerate(first):
        for v in sorted(lines, key=lambda v: (lines[v], v)):
            t = texts[i]
            texts[i] = v if t is None else t if v in t else f"{t}|{v}"
    state.update(tuple(texts))
    yield pd.DataFrame([[*key, *texts]], columns=["label", "uri", "v0", "v1", "v2"])


def running_merge(stream: DataFrame, label: str, uri: str, values: list[str], order: str) -> DataFrame:
    """Per (label, uri) three values folded in arrival order: appended unless the text so far contains them. Emits each changed key."""
    s = stream.select(F.col(label).alias("label"), F.col(uri).alias("uri"), *[F.col(v).cast("string").alias(f"v{i}") for i, v in enumerate(values)], F.col(order).alias("line_no"))
    return s.groupBy("label", "uri").applyInPandasWithState(_merge, "label string, uri string, v0 string, v1 string, v2 string", "v0 string, v1 string, v2 string", "update", "NoTimeout")


def _fold_classes(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """As ``_merge``: the first line of each class of the batch, then the fold of ``classes.specific_classes`` from where the state left it."""
    first: dict[str, tuple] = {}
    for f in frames:
        at = f.loc[f.groupby("c")["line_no"].idxmin()]
        for c, line, i, up in zip(at["c"], at["line_no"], at["i"], at["up"]):
            if c not in first or line < first[c][0]:
                first[c] = (line, i, frozenset(up))
    cells, found = json.loads(state.get[0]) if state.exists else ([], [])
    for c, (_, i, up) in sorted(first.items(), key=lambda x: (x[1][0], x[0])):
        at = next((k for k, (e, above) in enumerate(cells) if e == c or c in above or e in up), None)
        if at is not None and (cells[at][0] == c or c in cells[at][1]):
            continue
        if at is None:
            cells.append([c, sorted(up)])
        else:
            cells[at] = [c, sorted(up)]
        if i and i not in found:
            found.append(i)
    state.update((json.dumps([cells, found]),))
    yield pd.DataFrame([[*key, "|".join(c for c, _ in cells), "|".join(found)]], columns=["uri", "specific", "interesting"])


def running_classes(stream: DataFrame, canonical: DataFrame, interesting: DataFrame, supers: DataFrame, uri: str, cls: str, order: str) -> DataFrame:
    """Specific and interesting classes of each uri so far (see ``classes.specific_classes``), in arrival order. Emits each changed uri.

    What is known of a class comes from a static table. State is per uri: its classes, and what lies above them.
    """
    s = stream.select(F.col(uri).alias("uri"), F.col(cls).alias("_c"), F.col(order).alias("line_no"))
    s = s.join(class_info(canonical, interesting, supers), "_c").select("uri", "c", "line_no", "i", "up")
    return s.groupBy("uri").applyInPandasWithState(_fold_classes, "uri string, specific string, interesting string", "cells string", "update", "NoTimeout")


def drained(result: DataFrame, path: str, checkpoint: str, keys: list[str], mode: str = "update") -> DataFrame:
    """Run a stream over what is there and return the last row of each key. Every batch is one folder, so a batch that runs again replaces itself."""

    def write(df: DataFrame, epoch: int) -> None:
        df.withColumn("_epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    rows = result.sparkSession.read.parquet(path)
    cols = [c for c in result.columns]
    return rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*cols), "_epoch").alias("r")).select("r.*")
