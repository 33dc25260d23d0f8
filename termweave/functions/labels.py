"""Label and literal cleaning as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import java_trim

# Patterns of the cleaning rules.
PUNCTUATION = r"""[~=+%£"'`|@#,;\.\?!:()\[\]\{\}\<\>&*\$/\\„“]+"""
NOT_ALL_LETTERS = r"\b\S*[\S&&[^\p{L}-]]\S*\b"
SINGLE_HYPHEN = r"(?<!\p{L})-(?!\p{L})"
TRAILING_PARENTHESIS = r"\s*\(\s*([^)]+)\s*\)\s*$"
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue"}
ACRONYM = "[a-zA-Z][A-Z]"


@F.pandas_udf(T.StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Unicode NFKC; Spark has no built-in."""
    return x.map(lambda s: s if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(T.StringType())
def unaccented(x: pd.Series) -> pd.Series:
    """NFD without combining marks (U+0300-036F), then NFKC."""
    strip = lambda s: unicodedata.normalize("NFKC", "".join(c for c in unicodedata.normalize("NFD", s) if not "̀" <= c <= "ͯ"))
    return x.map(lambda s: s if s is None else strip(s))


def filter_literal(c: Column) -> Column:
    """Punctuation, tokens with anything but letters and hyphens, and lone hyphens become blanks; blanks are squeezed and trimmed."""
    for pattern in (PUNCTUATION, NOT_ALL_LETTERS, SINGLE_HYPHEN, r"\s\s+"):
        c = F.regexp_replace(c, pattern, " ")
    return java_trim(c)


def filter_literals(df: DataFrame, column: str) -> DataFrame:
    """``column`` cleaned by ``filter_literal``; rows with nothing left, or a null, are dropped."""
    return df.withColumn(column, filter_literal(F.col(column))).filter(F.col(column) != "")


def lower(c: Column, lang: str | None = None) -> Column:
    """Lower case as a language writes it: Turkish and Azeri tell dotted from dotless i, Lithuanian keeps the dot under accents."""
    if lang in ("tr", "az"):
        c = F.translate(F.replace(c, F.lit("I\u0307"), F.lit("i")), "Iİ", "ıi")
    elif lang == "lt":
        for a, b in (("Ì", "i\u0307\u0300"), ("Í", "i\u0307\u0301"), ("Ĩ", "i\u0307\u0303")):
            c = F.replace(c, F.lit(a), F.lit(b))
        c = F.regexp_replace(c, "([IJĮ])(?=[\u0300\u0301\u0303])", "$1\u0307")
    return F.lower(c)


def normalize_labels(df: DataFrame, column: str, lang: str | None = None) -> DataFrame:
    """Label variants: every row once for each of umlaut, accent-free and base form (those that differ), with labelOrig and parenthesesInfo.

    Compatibility-normalised; a trailing parenthesis moves to parenthesesInfo (``NONE`` if there is none); one trailing comma, ``&quot;``
    and quotes around parts go. Kept if it has 2 to 50 characters and a letter. Null labels are dropped. ``variant`` 0.. is the order of emission.
    ``lang`` (ISO 639-1) chooses its rules of lower case. ASCII labels, most of them, never leave the JVM: only the others pass through the Unicode functions.
    """
    ascii_ = ~F.col(column).rlike(r"[^\x00-\x7F]")
    plain = df.filter(ascii_).withColumn("_n", F.col(column))
    other = df.filter(~ascii_).withColumn("_n", nfkc(column))

    def cleaned(d: DataFrame) -> DataFrame:
        n = F.col("_n")
        has = n.rlike(TRAILING_PARENTHESIS)
        x = F.when(has, F.regexp_replace(n, TRAILING_PARENTHESIS, "")).otherwise(n)
        x = java_trim(F.regexp_replace(java_trim(x), ",$", ""))
        x = F.replace(x, F.lit("&quot;"), F.lit('"'))
        x = F.regexp_replace(F.regexp_replace(x, '"(.+)"', "$1"), "''(.+)''", "$1")
        d = d.withColumn("parenthesesInfo", F.when(has, F.regexp_extract(n, TRAILING_PARENTHESIS, 1)).otherwise("NONE")).withColumn("labelOrig", x)
        return d.filter((F.length("labelOrig") > 1) & (F.length("labelOrig") <= 50) & F.col("labelOrig").rlike(r"\p{L}")).withColumn("_base", lower(F.col("labelOrig"), lang))

    def variants(d: DataFrame, accents: Column) -> DataFrame:
        umlaut = F.col("_base")
        for a, b in UMLAUTS.items():
            umlaut = F.replace(umlaut, F.lit(a), F.lit(b))
        forms = F.array_compact(F.array(F.when(F.col("_base").rlike("[üöä]"), umlaut), F.when(accents != F.col("_base"), accents), F.col("_base")))
        kept = [c for c in df.columns if c != column]
        return d.select(*kept, "labelOrig", "parenthesesInfo", F.posexplode(forms).alias("variant", column)).select(*df.columns, "labelOrig", "parenthesesInfo", "variant")

    return variants(cleaned(plain), F.col("_base")).unionByName(variants(cleaned(other).withColumn("_plain", unaccented("_base")), F.col("_plain")))


def is_acronym(c: Column) -> Column:
    """One token with an upper-case letter after a letter."""
    return c.rlike(ACRONYM) & ~c.contains(" ")
