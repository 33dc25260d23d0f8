import pytest
from pyspark.sql import functions as F

from termweave.operators.packed import ListGrammar, parse_list, unpack

PHRASES = ListGrammar(("Plant Extract, Oil, or Resin", "Plant Extract", "Healer's Practice", "Mood Finding"))
CODES = ListGrammar(("T1", "T12", "SYM.9"), blanks=True)


def values(spark, text, g):
    return [(v.pos, v.val, v.how, v.error) for v in spark.createDataFrame([(text,)], "x string").select(parse_list(F.col("x"), g).alias("v")).first().v]


def test_phrases(spark):
    v = lambda t: [x[1] for x in values(spark, t, PHRASES)]
    assert v("Plant Extract, Oil, or Resin, Mood Finding") == ["Plant Extract, Oil, or Resin", "Mood Finding"]
    assert v("'Healer''s Practice'; \"Mood Finding\"") == ["Healer's Practice", "Mood Finding"]
    assert v("'Healer's Practice',Mood Finding") == ["Healer's Practice", "Mood Finding"]
    assert v('["Plant Extract", "Mood Finding"]') == ["Plant Extract", "Mood Finding"]
    assert v(" Plant Extract |  | Mood Finding | ") == ["Plant Extract", "Mood Finding"]
    assert v("Mood Finding / Plant Extract\tMood Finding") == ["Mood Finding", "Plant Extract", "Mood Finding"]
    for nothing in (None, "", "  ", "||", "[]", " ; ", ","):
        assert v(nothing) == []


def test_flags_and_positions(spark):
    assert values(spark, '"Mood Finding"|Other', PHRASES) == [(1, "Mood Finding", "quoted", None), (2, "Other", "bare", "unknown_value")]
    assert values(spark, '"Mood Finding|Plant Extract', PHRASES) == [(1, "Mood Finding", "bare", "stray_quote"), (2, "Plant Extract", "bare", None)]
    assert values(spark, "[Mood Finding]", PHRASES) == [(1, "Mood Finding", "bracketed", None)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("""["T1", 'T12', T1]""", [("T1", "quoted", None), ("T12", "quoted", None), ("T1", "bracketed", None)]),
        ("T1 [T12, T1] T1", [("T1", "bare", None), ("T12", "bracketed", None), ("T1", "bracketed", None), ("T1", "bare", None)]),
        ("[T1],T12", [("T1", "bracketed", None), ("T12", "bare", None)]),
        ("T1,[T12;T1],T12", [("T1", "bare", None), ("T12", "bracketed", None), ("T1", "bracketed", None), ("T12", "bare", None)]),
        ("[T1, T12", [("T1", "bare", "open_bracket"), ("T12", "bare", None)]),
        ("T1, T12 ]", [("T1", "bare", None), ("T12", "bare", "stray_bracket")]),
        ("['T1' , T12", [("T1", "quoted", "open_bracket"), ("T12", "bare", None)]),
        ("""["T1, 'T12']""", [("T1", "bracketed", "stray_quote"), ("T12", "quoted", None)]),
        ("""["a]b", T1]""", [("a]b", "quoted", "unknown_value"), ("T1", "bracketed", None)]),
        ("[[T1]]", [("T1", "bracketed", None)]),
        ("[] [ ] [,]", []),
        ("][", []),
    ],
)
def test_brackets(spark, text, want):
    assert [x[1:] for x in values(spark, text, CODES)] == want


def test_codes(spark):
    assert [x[1] for x in values(spark, "T12 T1,'SYM.9' \"T1\"", CODES)] == ["T12", "T1", "SYM.9", "T1"]


def test_long_text(spark):
    assert len(values(spark, "[" * 20_000 + "T1," * 1_000, CODES)) == 1_000
    assert len(values(spark, "[" + "T1," * 20_000 + "]", CODES)) == 20_000
    assert len(values(spark, "T1," * 20_000, CODES)) == 20_000
    assert len(values(spark, '"' + "T1," * 5_000, CODES)) == 5_000


def test_unpack(spark, rows):
    df = spark.createDataFrame([(1, "T1;T12", None, "x"), (2, None, "T1", "y")], "line_no long, a string, b string, val string")
    assert rows(unpack(df, {"a": CODES, "b": CODES}, ["line_no"]).select("line_no", "fld", "pos", "val")) == [(1, "a", 1, "T1"), (1, "a", 2, "T12"), (2, "b", 1, "T1")]
    assert unpack(df.limit(0), {"a": CODES}, ["line_no"]).count() == 0


def test_types_and_their_codes_agree(spark):
    """In the data the n-th type name and the n-th type code of a row are one type, however either list is written."""
    import os

    from termweave.plans import problem_queries

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no data")
    v = problem_queries.packed_values(spark, d)
    names, codes = v.filter("fld = 'stys'").select("line_no", "pos", F.col("val").alias("sty")), v.filter("fld = 'tuis'").select("line_no", "pos", F.col("val").alias("tui"))
    both = names.join(codes, ["line_no", "pos"])
    known = spark.read.parquet(f"{d}/semtypes.parquet")
    assert both.count() > 3000 and both.join(known, ["sty", "tui"], "left_anti").count() == 0
    assert v.filter("error is not null").count() == 0
