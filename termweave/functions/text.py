"""Column expressions on text: keys, words, trimming. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a value without meaning anything.
TRAILING = " \t .…"


def clean_key(c: Column | str) -> Column:
    """Upper-case, only letters and digits left. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.upper(c), r"[^\p{L}\p{Nd}]+", "")


def words(c: Column | str) -> Column:
    """The longest runs of letters and digits, lower-cased, in order. Null stays null, text without words gives an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0))


def word_bag(c: Column | str) -> Column:
    """The words sorted and joined by blanks: equal for texts with the same words, each as often."""
    return F.array_join(F.array_sort(words(c)), " ")


def core(c: Column | str) -> Column:
    """Lower-cased without trailing blanks, tabs, no-break spaces, dots and ellipses."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rtrim(F.lower(c), F.lit(TRAILING))


def java_trim(c: Column | str) -> Column:
    """Strip every character up to U+0020 from both ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
