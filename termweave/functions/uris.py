"""URIs in ``|``-separated fields: shorten, expand, recode, count prefixes.

Error policies: ``abort`` raises, ``keep`` keeps the item as it is, ``drop`` drops the row.
The exact recoding of the original helpers is not published; ``recode_uri`` is our definition of it: undo earlier percent and ``\\u``
escapes, then encode as this knowledge base of version 3.8 does (all bytes but unreserved and ``!$&'()*+,/:;=@``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import hot_keys, salted_join

# Fixed values.
BASE = "http://dbpedia.org/resource/"
NAMESPACES = {
    "dbpo": "http://dbpedia.org/ontology/", "dbpp": "http://dbpedia.org/property/", "foaf": "http://xmlns.com/foaf/0.1/", "owl": "http://www.w3.org/2002/07/owl#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "schema": "http://schema.org/", "skos": "http://www.w3.org/2004/02/skos/core#", "xsd": "http://www.w3.org/2001/XMLSchema#",
}


def shorten(item: Column, base: bool = True, namespaces: dict[str, str] = NAMESPACES) -> Column:
    """``base``: strip the base; otherwise put the prefix in place of the namespace. Others stay as they are."""
    if base:
        return F.when(item.startswith(BASE), F.substr(item, F.lit(len(BASE) + 1))).otherwise(item)
    out = item
    for prefix, ns in namespaces.items():
        out = F.when(item.startswith(ns), F.concat(F.lit(prefix + ":"), F.substr(item, F.lit(len(ns) + 1)))).otherwise(out)
    return out


def expand(item: Column, base: bool = True, namespaces: dict[str, str] = NAMESPACES) -> Column:
    if base:
        return F.concat(F.lit(BASE), item)
    out = item
    for prefix, ns in namespaces.items():
        out = F.when(item.startswith(prefix + ":"), F.concat(F.lit(ns), F.substr(item, F.lit(len(prefix) + 2)))).otherwise(out)
    return out


def map_items(df: DataFrame, column: str, change, policy: str = "abort") -> DataFrame:
    """``change`` on every non-empty item of ``column``; an item it leaves unchanged is an error."""
    items = F.split(F.col(column), r"\|", -1)
    same = F.exists(items, lambda x: (x != "") & change(x).eqNullSafe(x))
    new = F.array_join(F.transform(items, lambda x: F.when(x == "", x).otherwise(change(x))), "|")
    if policy == "drop":
        return df.filter(~F.coalesce(same, F.lit(False))).withColumn(column, new)
    if policy == "abort":
        new = F.when(same, F.raise_error(F.concat(F.lit("not changed: "), F.col(column)))).otherwise(new)
    return df.withColumn(column, new)


@F.pandas_udf(T.StringType())
def recode_uri(x: pd.Series) -> pd.Series:
    """Null where the result would still hold a ``\\u`` escape."""
    import re
    from urllib.parse import quote, unquote

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        plain = re.sub(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})", lambda m: chr(int(m[1] or m[2], 16)), unquote(s))
        out = quote(plain.encode("utf-8", "surrogatepass"), safe="!$&'()*+,/:;=@\\-._~")
        return None if "\\u" in out else out

    return x.map(one)


def recode(df: DataFrame, column: str) -> DataFrame:
    """Rows whose URI can't be recoded are dropped."""
    return df.withColumn(column, recode_uri(column)).filter(F.col(column).isNotNull())


def canonical(df: DataFrame, column: str, inter_language: DataFrame | None = None, redirects: DataFrame | None = None, same_as: DataFrame | None = None, disambiguations: DataFrame | None = None, drop_empty: bool = False, keep_empty: bool = False, unique: str | None = None) -> DataFrame:
    """Canonical URIs by lookups (each a frame from_uri, to_uri with one row per from_uri): inter-language, then redirects, then sameAs.

    A URI that is a disambiguation page has no canonical form: ''. Empty URIs are dropped unless ``keep_empty``; ``drop_empty`` drops rows
    that end up empty; results that hold a ``\\u`` escape are dropped. The order of lookups is our choice. Redirects must be closed
    (see ``lookup.closed_redirects``). Hot URIs are salted by the hash of ``unique``, a column that tells rows apart; without one, of the whole row.
    """
    c = F.col(column)
    out = df.withColumn(column, F.coalesce(F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), F.lit("")))
    if not keep_empty:
        out = out.filter(c != "")
    if unique is None:
        unique, out = "_row", out.withColumn("_row", F.xxhash64(*df.columns))

    def joined(rows: DataFrame, t: DataFrame) -> DataFrame:
        return salted_join(rows, t, [column], unique, hot_keys(rows, [column]), "left")

    for t in (inter_language, redirects, same_as):
        if t is not None:
            out = joined(out, t.select(F.col("from_uri").alias(column), F.col("to_uri").alias("_to"))).withColumn(column, F.coalesce("_to", column)).drop("_to")
    if disambiguations is not None:
        d = disambiguations.select(F.col("from_uri").alias(column)).distinct().withColumn("_d", F.lit(True))
        out = joined(out, d).withColumn(column, F.when(F.col("_d"), "").otherwise(c)).drop("_d")
    out = out.filter(~c.contains("\\u"))
    return (out.filter(c != "") if drop_empty else out).select(*df.columns)


def prefix_counts(df: DataFrame, column: str) -> DataFrame:
    """prefix (text before the first ``:``), n_distinct (different remainders), n. Values that are empty or have no colon are left out."""
    c = F.col(column)
    pairs = df.filter(c.contains(":")).select(F.split(c, ":", 2)[0].alias("prefix"), F.split(c, ":", 2)[1].alias("rest"))
    once = pairs.groupBy("prefix", "rest").agg(F.count(F.lit(1)).alias("k"))
    return once.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("k").alias("n"))
