"""Sinks. Everything is written by the executors; only descriptors of a line or two are written by the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv_lines(df: DataFrame, null: str = "") -> DataFrame:
    """Rows as tab-separated lines, without escapes."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null)) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, gz: bool = False) -> None:
    tsv_lines(df).write.mode("overwrite").option("compression", "gzip" if gz else "none").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Create or replace a table."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_per_language(df: DataFrame, path: str, languages: list[str]) -> None:
    """The same table once for each language, as folders ``lang=xx``. The rows are read once."""
    write_table(df.withColumn("lang", F.explode(F.array(*[F.lit(x) for x in languages]))), path, ["lang"])


def _keep(df: DataFrame, keys: list[str], pick) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    # the keys stay grouping columns, so a join on them needs no further shuffle
    g = df.groupBy(*keys).agg(pick(F.struct(*others)).alias("_r"))
    return g.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key, which is what inserting row by row under a primary key leaves."""
    return _keep(df, keys, lambda row: F.min_by(row, order))


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key, which is what updating row by row leaves."""
    return _keep(df, keys, lambda row: F.max_by(row, order))


def import_rows(fields: DataFrame, columns: dict[str, int], keys: list[str], order: str, last_wins: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, duplicates) of ``fields`` (array column ``f``): the named 0-based fields as columns; per key the first row (or last, as a merge does).

    ``duplicates`` counts the further rows per key.
    """
    rows = fields.select(order, *[F.get("f", F.lit(i)).alias(c) for c, i in columns.items()])
    kept = keep_last(rows, keys, order) if last_wins else keep_first(rows, keys, order)
    again = rows.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("duplicates")).filter("duplicates > 0")
    return kept, again


def graph_lines(edges: DataFrame, src: str, dst: str, weight: str) -> DataFrame:
    """``u:SRC v:DST w:W`` lines; rows with a null field are dropped."""
    ok = edges.dropna(subset=[src, dst, weight])
    return ok.select(F.concat(F.lit("u:"), F.col(src).cast("string"), F.lit(" v:"), F.col(dst).cast("string"), F.lit(" w:"), F.col(weight).cast("string")).alias("value"))


def write_graph(ids: DataFrame, outgoing: DataFrame, incoming: DataFrame, path: str) -> None:
    """A graph as three tables: nodes (node, id), out and in (id, chunk_no, edges as arrays of count and id), the latter sorted by node."""
    write_table(ids, f"{path}/nodes")
    write_table(outgoing, f"{path}/out")
    write_table(incoming, f"{path}/in")


def dictionary_lines(df: DataFrame, head: str, items: str) -> DataFrame:
    """``head_word item item``: blanks of the head become ``_``, commas between items become blanks."""
    return df.dropna(subset=[head, items]).select(F.concat_ws(" ", F.replace(head, F.lit(" "), F.lit("_")), F.replace(items, F.lit(","), F.lit(" "))).alias("value"))


def shard_path(doc_id: Column, digits: int, ext: str = ".finf") -> Column:
    """``dir/file``: the last 2 x digits of the zero-padded id, cut in half. digits 0: no folder, the id itself."""
    s = doc_id.cast("string")
    if digits == 0:
        return F.concat(s, F.lit(ext))
    tail = F.right(F.concat(F.lit("0" * (2 * digits)), s), F.lit(2 * digits))
    return F.concat(F.substring(tail, 1, digits), F.lit("/"), F.right(tail, F.lit(digits)), F.lit(ext))


def write_documents(df: DataFrame, doc_id: str, path: str, digits: int = 2) -> None:
    """Documents in folders by the last digits of their ids (see ``shard_path``): ``dir=xx``, each row with its ``file``."""
    at = shard_path(F.col(doc_id), digits, "")
    split = F.split(at, "/")
    write_table(df.withColumn("dir", split[0] if digits else F.lit("all")).withColumn("file", F.element_at(split, -1)), path, ["dir"])


def gazetteer_definition(files: dict[str, tuple[str, str]]) -> str:
    """Descriptor text: one ``file:majorType:minorType`` line for each list."""
    return "".join(f"{name}:{major}:{minor}\n" for name, (major, minor) in files.items())


def escape_tabs(c: Column) -> Column:
    return F.replace(c, F.lit("\t"), F.lit("&#x0009;"))


def unescape_tabs(c: Column) -> Column:
    return F.replace(c, F.lit("&#x0009;"), F.lit("\t"))
