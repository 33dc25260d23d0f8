"""Declared schemas of the release files and of the tables derived from them.

Fixed values: table and column names, order and types of the published release format. ``!`` marks columns that may not be null.
"""

from __future__ import annotations

from pyspark.sql import types as T

# name -> columns; i int, l long, d decimal(5,2), otherwise string
LAYOUTS: dict[str, str] = {
    "MRCOLS": "COL DES REF MIN:i AV:d MAX:i FIL DTY",
    "MRCONSO": "CUI! LAT! TS! LUI! STT! SUI! ISPREF! AUI! SAUI SCUI SDUI SAB! TTY! CODE! STR! SRL!:i SUPPRESS! CVF:i",
    "MRCUI": "CUI1! VER! REL! RELA MAPREASON CUI2 MAPIN",
    "MRDEF": "CUI! AUI! ATUI! SATUI SAB! DEF! SUPPRESS! CVF:i",
    "MRDOC": "DOCKEY! VALUE TYPE! EXPL",
    "MRFILES": "FIL DES FMT CLS:i RWS:i BTS:l",
    "MRHIER": "CUI! AUI! CXN!:i PAUI SAB! RELA PTR HCD CVF:i",
    "MRRANK": "RANK!:i SAB! TTY! SUPPRESS!",
    "MRREL": "CUI1! AUI1 STYPE1! REL! CUI2! AUI2 STYPE2! RELA RUI! SRUI SAB! SL! RG DIR SUPPRESS! CVF:i",
    "MRSAB": "VCUI RCUI VSAB! RSAB! SON! SF! SVER VSTART VEND IMETA! RMETA SLC SCC SRL!:i TFR:i CFR:i CXTY TTYL ATNL LAT CENC! CURVER! SABIN! SSN! SCIT!",
    "MRSAT": "CUI! LUI SUI METAUI STYPE! CODE ATUI! SATUI ATN! SAB! ATV SUPPRESS! CVF:i",
    "MRSTY": "CUI! TUI! STN! STY! ATUI! CVF:i",
    "MRXNS_ENG": "LAT! NSTR! CUI! LUI! SUI!",
    "MRXNW_ENG": "LAT! NWD! CUI! LUI! SUI!",
    "MRXW_ENG": "LAT! WD! CUI! LUI! SUI!",
    "MRAUI": "AUI1! CUI1! VER! REL RELA MAPREASON! AUI2! CUI2! MAPIN!",
    "AMBIGSUI": "SUI! CUI!",
    "AMBIGLUI": "LUI! CUI!",
    "MRCOC": "DUI1 CUI1 DUI2 CUI2 FREQ:i STARFREQ:i YEAR TIMEFRAME NUMNOSH:i STARNUMNOSH:i NUMSH:i BOTHMAIN STAR1ONLYFREQ:i STAR2ONLYFREQ:i SH1ONLYFREQ:i SH2ONLYFREQ:i",
    "CUIFREQ": "CUI COUNT:i NORM:f",
    "LABELFREQ": "LABEL CUI COUNT:i NORM:f",
    "PAGERANK": "CUI PROB:f",
}
LAYOUTS["MRCONSO_ALLLANGS"] = LAYOUTS["MRCONSO"]
_TYPES = {"i": T.IntegerType(), "l": T.LongType(), "d": T.DecimalType(5, 2), "f": T.DoubleType(), "": T.StringType()}


def schema(name: str) -> T.StructType:
    """The schema of a release table; every column may be null while reading, see ``required``."""
    fields = []
    for spec in LAYOUTS[name.upper()].split():
        col, _, kind = spec.replace("!", "").partition(":")
        fields.append(T.StructField(col.lower(), _TYPES[kind]))
    return T.StructType(fields)


def required(name: str) -> list[str]:
    """The columns that may not be null."""
    return [s.partition("!")[0].lower() for s in LAYOUTS[name.upper()].split() if "!" in s]


# ISO 639-1, ISO 639-3 and release label of the languages.
LANGUAGES = [
    ("bg", "bul", "BUL"), ("cs", "ces", "CZE"), ("da", "dan", "DAN"), ("de", "deu", "GER"), ("el", "ell", "GRE"), ("en", "eng", "ENG"), ("es", "spa", "SPA"),
    ("et", "est", "EST"), ("eu", "eus", "BAQ"), ("fi", "fin", "FIN"), ("fr", "fra", "FRE"), ("it", "ita", "ITA"), ("ja", "jpn", "JPN"), ("he", "heb", "HEB"),
    ("hr", "hrv", "SCR"), ("hu", "hun", "HUN"), ("ko", "kor", "KOR"), ("lv", "lav", "LAV"), ("nl", "nld", "DUT"), ("no", "nor", "NOR"), ("pl", "pol", "POL"),
    ("pt", "por", "POR"), ("ru", "rus", "RUS"), ("sh", "hbs", "SCR"), ("sr", "srp", "SCR"), ("sv", "swe", "SWE"), ("tr", "tur", "TUR"), ("zh", "zho", "CHI"),
]
