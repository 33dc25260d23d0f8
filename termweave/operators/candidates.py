"""Candidates of each label as one JSON array: the table an entity linker looks labels up in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON names of the label info columns, in column order.
NAMES = {
    "label": "label", "cui": "inst", "stys": "STY", "tuis": "TUI", "pref": "PREF", "labelvocabs": "LABELVOCABS", "cuivocabs": "CUIVOCABS", "crislabelcuifreq": "scCRISLabelCUIFreq",
    "crislabelcuinorm": "scCRISLabelCUINorm", "criscuifreq": "scCRISCUIFreq", "criscuinorm": "scCRISCUINorm", "pagerank": "scPageRank",
}
LIMIT = 65_536

OBJECT = T.ArrayType(T.StructType([T.StructField(v, T.IntegerType() if v.endswith("Freq") else T.DoubleType() if v.startswith("sc") else T.StringType()) for v in NAMES.values()]))


def json_object(columns: dict[str, str], compat: bool = False, zero_numbers: bool = False) -> Column:
    """A row as JSON text. Nulls are JSON null; with ``compat`` the text ``"null"``, as a text pipeline leaves them; with ``zero_numbers``
    missing scores (names in sc) are 0, as a database pipeline leaves them."""
    value = lambda c, n: F.coalesce(F.col(c), F.lit(0)) if zero_numbers and n.startswith("sc") else F.col(c)
    text = F.to_json(F.struct(*[value(c, n).alias(n) for c, n in columns.items()]), {"ignoreNullFields": "false"})
    return F.regexp_replace(text, r':null(?=[,}])', ':"null"') if compat else text


def scalar(c: Column) -> Column:
    """JSON text of an untyped field: an integer, else a double, else a string. For fields that come without types."""
    integer = c.rlike(r"^[+-]?\d+$") & c.try_cast("int").isNotNull()
    number = F.regexp_extract(F.trim(c), r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)[dDfF]?$", 1)
    return F.when(integer, c.try_cast("int").cast("string")).when(number != "", number.try_cast("double").cast("string")).otherwise(F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2))


def json_per_key(df: DataFrame, key: str, obj: Column, order: list[str], limit: int | None = LIMIT) -> DataFrame:
    """``key`` and ``info``, the JSON array of its objects in ``order``; arrays of ``limit`` characters or more are left out.

    How long each array will be is added up first, with partial sums, so the lists that are gathered are known to be below the
    limit: a key with a third of all rows is dropped as the limit asks, and never gathered.
    """
    rows = df.select(F.col(key), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], obj.alias("_j"))
    if limit is not None:
        size = rows.groupBy(F.col(key).alias("_k")).agg((F.sum(F.length("_j")) + F.count(F.lit(1)) + 1).alias("_n")).filter(F.col("_n") < limit).select("_k")
        rows = rows.join(size, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    items = F.array_sort(F.collect_list(F.struct(*[f"_o{i}" for i in range(len(order))], "_j")))
    return rows.groupBy(key).agg(items.alias("_a")).select(key, F.concat(F.lit("["), F.array_join(F.transform("_a", lambda x: x["_j"]), ","), F.lit("]")).alias("info"))


def label_candidates(info: DataFrame, limit: int | None = LIMIT, compat: bool = False, zero_numbers: bool = False) -> DataFrame:
    """label, info from label info rows; candidates of a label are in order of their concept, then of their text."""
    j = info.withColumn("_text", json_object(NAMES, compat, zero_numbers))
    return json_per_key(j, "label", F.col("_text"), ["cui", "_text"], limit)


def read_candidates(table: DataFrame) -> DataFrame:
    """The candidates back as rows: label, pos, and the columns of the objects."""
    return table.select(F.col("label").alias("_l"), F.posexplode(F.from_json("info", OBJECT)).alias("pos", "o")).select(F.col("_l").alias("label"), "pos", *[F.col(f"o.{v}").alias(c) for c, v in NAMES.items() if c != "label"])
