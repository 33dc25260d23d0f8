"""Lists packed into one string: a parsing expression grammar, compiled to one regular expression that runs in the JVM.

In a parsing expression grammar a choice is ordered and final: the first alternative that matches is taken. That is what an atomic
group does in a regular expression, so each rule below becomes ``(?>first|second|...)`` and each repetition is possessive.

    list    <- (bracketed / open? value closed? / separator)*
    bracketed <- '[' (value / separator)* ']' &end       (quotes inside may hold brackets; if they are malformed, any text but brackets)
    open    <- '['                                               (backtracking: the bracket closes nowhere)
    closed  <- ']'                                               (a bracket that was never opened)
    value   <- quoted / known / bare / stray
    quoted  <- '"' ('""' / [^"])* '"' &end   /   the same with '
    known   <- one of the known values, longest first, &end      (these may hold separators)
    bare    <- a run without separators
    stray   <- quote+ (known / bare)?                            (backtracking: the quote closes nowhere)
    end     <- space* (separator / ']' / end of text)            (a blank alone if blanks separate)
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that separate values.
SEPARATORS = ",;|/\t"


@dataclass(frozen=True)
class ListGrammar:
    """``known``: values that are read whole even if they hold separators. ``blanks``: whether a blank separates bare values."""

    known: tuple[str, ...] = ()
    separators: str = SEPARATORS
    blanks: bool = False

    def _cls(self) -> str:
        return "".join(re.escape(c) if c not in "/\t" else {"/": "/", "\t": r"\t"}[c] for c in self.separators)

    def pattern(self) -> str:
        sep = self._cls()
        end = rf"(?=\s|[{sep}\]]|$)" if self.blanks else rf"(?=\s*(?:[{sep}\]]|$))"
        rules = [rf'"[^"]*+(?:""[^"]*+)*+"{end}', rf"'[^']*+(?:''[^']*+)*+'{end}"]
        # an apostrophe inside a word ('Healer's') may stand before the closing quote
        rules.append(rf"'[^{sep}\[\]]*?'{end}")
        known = "(?>" + "|".join(re.escape(v).replace("\\ ", " ") for v in sorted(self.known, key=lambda v: (-len(v), v))) + ")" + end if self.known else None
        bare = rf"[^\s{sep}\[\]\"']" + (rf"[^\s{sep}\[\]]*+" if self.blanks else rf"[^{sep}\[\]]*+")
        own = [known, bare] if known else [bare]
        rules += [*own, "[\"']++(?>" + "|".join(own) + ")?+"]
        return "(?>" + "|".join(rules) + ")"

    def outer(self) -> str:
        """Bracketed lists as they are, other values with a bracket that has no partner."""
        sep = self._cls()
        end = rf"(?=\s*(?:[{sep}\]]|$))" if not self.blanks else rf"(?=\s|[{sep}\]]|$)"
        whole = rf"\[(?>\"[^\"]*+\"|'[^']*+'|[^\[\]\"'])*+\]{end}|\[[^\[\]]*+\]{end}"
        return rf"(?>{whole}|(?:\[\s*+)?+{self.pattern()}(?:\s*+\])?+)"


def parse_list(c: Column, g: ListGrammar) -> Column:
    """Array of (pos, val, how, error) of the values in ``c``; empty pieces are left out and not counted.

    Null and empty text give an empty array. how: quoted, bracketed (bare in a bracketed list) or bare. error: ``stray_quote`` for a value that
    has a quote at one end only, ``open_bracket`` or ``stray_bracket`` for one behind or before a bracket without partner, ``unknown_value`` if
    known values are given and this is none, else null; of several the first of these. Stray marks are no part of the value.
    """
    c = F.coalesce(c, F.lit(""))
    tokens = F.regexp_extract_all(c, F.lit(g.outer()), F.lit(0))
    known = F.array(*[F.lit(v) for v in g.known]) if g.known else None
    inner = lambda t: F.regexp_extract_all(t.substr(F.lit(2), F.length(t) - 2), F.lit(g.pattern()), F.lit(0))

    def split(t: Column) -> Column:
        opens, closes = t.startswith("["), t.endswith("]")
        single = F.struct(F.regexp_replace(t, r"^\[\s*|\s*\]$", "").alias("t"), F.lit(False).alias("in"), F.when(opens, "open_bracket").when(closes, "stray_bracket").alias("b"))
        return F.when(opens & closes & (F.length(t) > 1), F.transform(inner(t), lambda x: F.struct(x.alias("t"), F.lit(True).alias("in"), F.lit(None).cast("string").alias("b")))).otherwise(F.array(single))

    # most fields hold no bracket, and their values are the tokens
    plain = F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(False).alias("in"), F.lit(None).cast("string").alias("b")))
    items = F.when(c.contains("[") | c.contains("]"), F.flatten(F.transform(tokens, split))).otherwise(plain)

    def one(x: Column) -> Column:
        t = x["t"]
        q = F.substring(t, 1, 1)
        opens = q.isin('"', "'")
        closed = opens & (F.length(t) >= 2) & (F.substring(t, -1, 1) == q)
        inside = F.replace(t.substr(F.lit(2), F.length(t) - 2), F.concat(q, q), q)
        text = F.when(closed, inside).when(opens, F.regexp_replace(t, "^[\"']+", "")).otherwise(t)
        stray = (opens & ~closed) | (~opens & F.substring(F.rtrim(t), -1, 1).isin('"', "'"))
        return F.struct(
            F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "").alias("val"), F.when(closed, "quoted").when(x["in"], "bracketed").otherwise("bare").alias("how"), F.when(stray, "stray_quote").otherwise(x["b"]).alias("error")
        )

    kept = F.filter(F.transform(items, one), lambda v: v["val"] != "")

    def flagged(v: Column, i: Column) -> Column:
        error = v["error"]
        if known is not None:
            error = F.coalesce(error, F.when(~F.array_contains(known, v["val"]), "unknown_value"))
        return F.struct((i + 1).alias("pos"), v["val"].alias("val"), v["how"].alias("how"), error.alias("error"))

    return F.transform(kept, flagged)


def unpack(df: DataFrame, fields: dict[str, ListGrammar], keep: list[str]) -> DataFrame:
    """One row per value: ``keep``, fld, pos, val, how, error. Each row is read once for all fields; no shuffle."""
    def labelled(name: str, g: ListGrammar) -> Column:
        return F.transform(parse_list(F.col(name), g), lambda v: F.struct(F.lit(name).alias("fld"), v["pos"].alias("pos"), v["val"].alias("val"), v["how"].alias("how"), v["error"].alias("error")))

    parts = [labelled(name, g) for name, g in fields.items()]
    return df.select(*keep, F.explode(F.concat(*parts)).alias("_v")).select(*keep, "_v.*")
