"""Sources. Schemas are declared, never inferred; files that end in .gz or .bz2 are read as they are."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LANGUAGES, schema


def _csv(spark: SparkSession, path, columns: T.StructType, sep: str, quote: str = "", header: bool = False, encoding: str = "UTF-8") -> DataFrame:
    return spark.read.csv(path, schema=columns, sep=sep, quote=quote, escape="", header=header, encoding=encoding, mode="PERMISSIVE")


def read_rrf(spark: SparkSession, path, table: str, first_line_is_header: bool = False) -> DataFrame:
    """A release file: fields closed by ``|``, no quoting, no escape; an empty field is null.

    ``first_line_is_header`` drops the first line of each file, as loaders that take it for column names do.
    """
    return _csv(spark, path, schema(table), "|", header=first_line_is_header)


def read_pipe(spark: SparkSession, path, columns: T.StructType) -> DataFrame:
    """Pipe-separated with ``"`` quoting."""
    return _csv(spark, path, columns, "|", quote='"')


def read_tsv(spark: SparkSession, path, columns: T.StructType, quote: str = '"') -> DataFrame:
    """Tab-separated with declared columns and ``"`` quoting; pass ``quote=""`` for files in which quotes are text."""
    return _csv(spark, path, columns, "\t", quote=quote)


def read_quoted_csv(spark: SparkSession, path, columns: T.StructType, quote: str = "'") -> DataFrame:
    return _csv(spark, path, columns, ",", quote=quote)


def read_fields(spark: SparkSession, path) -> DataFrame:
    """Each line as an array ``f`` of its tab-separated fields, trailing empty ones kept; an empty line has one empty field."""
    return spark.read.text(path).select(F.split("value", "\t", -1).alias("f"))


def languages(spark: SparkSession) -> DataFrame:
    """The inline language table."""
    return spark.createDataFrame(LANGUAGES, "iso6391 string, iso6393 string, umlslabel string")


def semantic_groups(lines: DataFrame, line_no: str = "line_no", value: str = "value") -> DataFrame:
    """(styclass, sty) from a group list: ``AAA:`` starts a class, ``'name'`` is a member, ``#`` a comment.

    The class of a member is the last header above it. Headers are few (a list has as many as groups; more than 10,000 are refused), so
    they become literals and each member looks its header up by its line number: no sort, no join.
    """
    v = F.col(value)
    heads = lines.filter(v.rlike(r"^\w+:\s*$")).select(F.col(line_no).alias("a"), F.regexp_extract(v, r"^(\w+):", 1).alias("g")).orderBy("a").limit(10_001).collect()
    if len(heads) > 10_000:
        raise ValueError("more than 10,000 headers: this is no group list")
    at = F.array(*[F.lit(h["a"]) for h in heads]).cast("array<long>")
    names = F.array(*[F.lit(h["g"]) for h in heads]).cast("array<string>")
    members = lines.filter(v.rlike(r"^'.*'\s*$")).select(F.col(line_no).alias("n"), F.regexp_extract(v, r"^'(.*)'\s*$", 1).alias("sty"))
    above = F.size(F.filter(at, lambda a: a < F.col("n")))
    return members.filter(above > 0).select(F.element_at(names, above).alias("styclass"), "sty")


_SELECT = re.compile(r"\s*select .+ from .+", re.I)


def sql_rows(spark: SparkSession, query: str, sep: str = "\t", null: str = "null") -> DataFrame:
    """A query (or the path of a file that holds one) as one text line per row; nulls print as ``null``."""
    if not _SELECT.fullmatch(query):
        with open(query, encoding="utf-8") as f:
            query = f.read().strip().rstrip(";")
    return _rows_as_text(spark.sql(query), sep, null)


def jdbc_rows(spark: SparkSession, url: str, query: str, sep: str = "\t", null: str = "null", **options: str) -> DataFrame:
    """The same for a query on a database, by JDBC. Options are those of the source, e.g. driver, user; partitionColumn needs dbtable in place of a query."""
    return _rows_as_text(spark.read.format("jdbc").options(url=url, **({} if "dbtable" in options else {"query": query}), **options).load(), sep, null)


def _rows_as_text(df: DataFrame, sep: str, null: str) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null)) for c in df.columns]).alias("value"))


# RDF -------------------------------------------------------------------------------------------------------------------------------

_TRIPLE = r'^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:@[A-Za-z]+(?:-[A-Za-z0-9]+)*|\^\^<[^>]*>)?)\s*\.\s*(?:#.*)?$'
_OBJECT = r'^"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?$'


#: Holds the place of an escaped backslash while other escapes are undone: a noncharacter, which no text may hold.
_HELD = "\ufdd0"


def _plain(c: Column) -> Column:
    """Undo the string escapes of the format."""
    c = F.replace(c, F.lit("\\\\"), F.lit(_HELD))
    for a, b in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\f", "\f"), ("\\b", "\b"), ('\\"', '"'), ("\\'", "'")):
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.when(
        c.contains("\\u") | c.contains("\\U"),
        F.array_join(
            F.transform(
                F.regexp_extract_all(c, F.lit(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|[^\\]+|\\"), F.lit(0)),
                lambda p: F.when(p.rlike(r"^\\[uU][0-9A-Fa-f]+$"), F.decode(F.unhex(F.lpad(F.substring(p, 3, 8), 8, "0")), "UTF-32")).otherwise(p),
            ),
            "",
        ),
    ).otherwise(c)
    return F.replace(c, F.lit(_HELD), F.lit("\\"))


def triples(lines: DataFrame, value: str = "value", keep_original: bool = False) -> DataFrame:
    """N-Triples lines as subj, pred, obj, lang, datatype, and ``_corrupt`` (the line) where a line can't be read.

    Comments and blank lines give nothing. Unless ``keep_original``, tabs, line ends and form feeds in literals become blanks. lang and
    datatype are '' where there is none. Each line stands alone, so a bad one costs only itself. All in the JVM.
    """
    v = F.col(value)
    obj = F.regexp_extract(v, _TRIPLE, 3)
    bad = ~v.rlike(_TRIPLE)
    term = lambda c: F.regexp_replace(c, r"^<|>$", "")
    literal = obj.startswith('"')
    text = _plain(F.regexp_extract(obj, _OBJECT, 1))
    text = text if keep_original else F.regexp_replace(text, r"[\t\n\r\f]", " ")
    ok = lambda c: F.when(~bad, c)
    return lines.filter(v.isNotNull() & ~v.rlike(r"^\s*(#.*)?$")).select(
        ok(term(F.regexp_extract(v, _TRIPLE, 1))).alias("subj"),
        ok(term(F.regexp_extract(v, _TRIPLE, 2))).alias("pred"),
        ok(F.when(literal, text).otherwise(term(obj))).alias("obj"),
        ok(F.when(literal, F.regexp_extract(obj, _OBJECT, 2)).otherwise("")).alias("lang"),
        ok(F.when(literal, F.regexp_extract(obj, _OBJECT, 3)).otherwise("")).alias("datatype"),
        F.when(bad, v).alias("_corrupt"),
    )


_TURTLE = re.compile(
    r'\s+|\#[^\n]*|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<str>"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\')|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<dt>\^\^)'
    r"|(?P<num>[+-]?(?:\d+\.\d+(?:[eE][+-]?\d+)?|\.\d+|\d+(?:[eE][+-]?\d+)?))|(?P<blank>_:[\w.-]*\w)|(?P<name>[A-Za-z][\w.-]*:(?:[\w%~\\-]|\.(?=\w))*|:(?:[\w%~\\-]|\.(?=\w))*)|(?P<word>[A-Za-z]+)|(?P<mark>[.;,\[\]()])",
    re.S,
)
_XSD, _RDF = "http://www.w3.org/2001/XMLSchema#", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


def parse_turtle(text: str, keep_original: bool = False) -> Iterator[tuple[str, str, str, str, str]]:
    """(subj, pred, obj, lang, datatype) of a Turtle document: prefixes, base, ``a``, ``;`` and ``,`` lists, literals, numbers, booleans,
    blank node lists and collections."""
    toks: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _TURTLE.match(text, at)
        if not m:
            raise ValueError(f"can't read at {text[at : at + 40]!r}")
        if m.lastgroup:
            toks.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    prefixes: dict[str, str] = {}
    base, i, fresh = "", 0, 0
    out: list[tuple[str, str, str, str, str]] = []

    def string(raw: str) -> str:
        body = raw[3:-3] if raw.startswith('"""') else raw[1:-1]
        simple = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "b": "\b"}
        s = re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else simple.get(m[1], m[1]), body, flags=re.S)
        return s if keep_original else re.sub(r"[\t\n\r\f]", " ", s)

    def iri(kind: str, raw: str) -> str:
        if kind == "iri":
            return raw[1:-1] if re.match(r"<[A-Za-z][\w+.-]*:", raw) else base + raw[1:-1]
        p, _, local = raw.partition(":")
        return prefixes[p] + local.replace("\\", "")

    def node() -> tuple[str, str, str]:
        nonlocal i, fresh
        kind, raw = toks[i]
        i += 1
        if kind in ("iri", "name"):
            return iri(kind, raw), "", ""
        if kind == "blank":
            return raw, "", ""
        if kind in ("str", "long"):
            s, lang, dt = string(raw), "", ""
            if i < len(toks) and toks[i][0] == "lang":
                lang = toks[i][1][1:]
                i += 1
            elif i < len(toks) and toks[i][0] == "dt":
                dt = iri(*toks[i + 1])
                i += 2
            return s, lang, dt
        if kind == "num":
            return raw, "", _XSD + ("double" if "e" in raw.lower() else "decimal" if "." in raw else "integer")
        if kind == "word" and raw in ("true", "false"):
            return raw, "", _XSD + "boolean"
        if raw == "[":
            fresh += 1
            own = f"_:b{fresh}"
            if toks[i] != ("mark", "]"):
                pairs(own)
            i += 1
            return own, "", ""
        if raw == "(":
            items = []
            while toks[i] != ("mark", ")"):
                items.append(node())
            i += 1
            head = _RDF + "nil"
            for item in reversed(items):
                fresh += 1
                own = f"_:b{fresh}"
                out.append((own, _RDF + "first", *item))
                out.append((own, _RDF + "rest", head, "", ""))
                head = own
            return head, "", ""
        raise ValueError(f"unexpected {raw!r}")

    def pairs(subj: str) -> None:
        nonlocal i
        while True:
            kind, raw = toks[i]
            pred = _RDF + "type" if (kind, raw) == ("word", "a") else iri(kind, raw)
            i += 1
            while True:
                out.append((subj, pred, *node()))
                if toks[i] == ("mark", ","):
                    i += 1
                    continue
                break
            while toks[i] == ("mark", ";"):
                i += 1
            if toks[i][0] == "mark" and toks[i][1] in ".]":
                return

    while i < len(toks):
        kind, raw = toks[i]
        if (kind, raw) in (("lang", "@prefix"), ("lang", "@base")) or (kind == "word" and raw.upper() in ("PREFIX", "BASE")):
            if raw.strip("@").upper() == "PREFIX":
                prefixes[toks[i + 1][1].rstrip(":")] = iri(*toks[i + 2])
                i += 3
            else:
                base = toks[i + 1][1][1:-1]
                i += 2
            if raw.startswith("@") or i < len(toks) and toks[i] == ("mark", "."):
                i += 1
            continue
        subj = node()[0]
        if toks[i] != ("mark", "."):
            pairs(subj)
        if toks[i] != ("mark", "."):
            raise ValueError(f"expected . at {toks[i][1]!r}")
        i += 1
        yield from out
        out.clear()


TRIPLE = "subj string, pred string, obj string, lang string, datatype string, _corrupt string"


def read_turtle(spark: SparkSession, path, keep_original: bool = False) -> DataFrame:
    """Whole Turtle files, one task per file: prefixes hold for a file, so it can't be cut. A file that can't be read gives one row with
    ``_corrupt`` (after the triples before the error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in TRIPLE.split(", ")]
        for b in batches:
            for text in b.column(0).to_pylist():
                rows: list = []
                block = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.string()) for j in range(6)], names=names)
                try:
                    for t in parse_turtle(text, keep_original):
                        rows.append((*t, None))
                        if len(rows) == 10_000:
                            yield block(rows)
                            rows = []
                except (ValueError, KeyError, IndexError) as e:
                    rows.append((None, None, None, None, None, f"{type(e).__name__}: {e}"))
                if rows:
                    yield block(rows)

    return spark.read.text(path, wholetext=True).mapInArrow(run, TRIPLE)


# XML -------------------------------------------------------------------------------------------------------------------------------

_PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("ns", T.IntegerType()), T.StructField("id", T.StringType()), T.StructField("revision", T.StructType([T.StructField("id", T.StringType()), T.StructField("timestamp", T.StringType()), T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))]))])


def read_wiki(spark: SparkSession, path, max_docs: int | None = None) -> DataFrame:
    """Articles of a wiki dump: id, title, rev_id, timestamp, text. Main namespace only; pages without id or text, empty texts and redirects are left out."""
    pages = spark.read.schema(_PAGE).option("rowTag", "page").option("valueTag", "_VALUE").xml(path)
    text = F.regexp_replace(F.col("revision.text._VALUE"), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    out = pages.filter((F.coalesce("ns", F.lit(0)) == 0) & F.col("id").isNotNull() & text.isNotNull() & (text != "") & ~F.lower(F.substring(text, 1, 9)).eqNullSafe("#redirect"))
    out = out.select("id", "title", F.col("revision.id").alias("rev_id"), F.col("revision.timestamp").alias("timestamp"), text.alias("text"))
    return out.orderBy(F.col("id").cast("long"), "id").limit(max_docs) if max_docs else out  # those with the smallest ids, the same every time


@F.pandas_udf(T.StringType())
def html_unescape(x: pd.Series) -> pd.Series:
    """Numeric and named character references as characters; Spark has no built-in."""
    return x.map(lambda s: s if s is None else html.unescape(s))


def wiki_plain(text: Column) -> Column:
    """An approximation of rendered text: character references are undone, then templates, references, tags, tables and files go, links keep their label, markup quotes go."""
    text = F.replace(html_unescape(text), F.lit("\u00a0"), F.lit(" "))
    for p, r in ((r"(?s)<!--.*?-->", ""), (r"(?is)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", ""), (r"(?s)\{\{[^{}]*\}\}", ""), (r"(?s)\{\{[^{}]*\}\}", ""), (r"(?s)\{\|.*?\|\}", ""), (r"\[\[(?:File|Image|Category):[^\]]*\]\]", ""), (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"), (r"\[https?://\S+ ([^\]]*)\]", "$1"), (r"'{2,}", ""), (r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1"), (r"<[^>]+>", "")):
        text = F.regexp_replace(text, p, r)
    return text


_FEATURES = T.ArrayType(T.StructType([T.StructField("Name", T.StringType()), T.StructField("Value", T.StringType())]))
_ANNOTATIONS = T.StructType([T.StructField("_Name", T.StringType()), T.StructField("Annotation", T.ArrayType(T.StructType([T.StructField("_Id", T.StringType()), T.StructField("_Type", T.StringType()), T.StructField("_StartNode", T.LongType()), T.StructField("_EndNode", T.LongType()), T.StructField("Feature", _FEATURES)])))])


def read_annotations(spark: SparkSession, path, set_name: str = "Key", kind: str = "Mention") -> DataFrame:
    """Annotations of one set and type in stand-off XML files under a folder: doc, start, stop, features (map)."""
    sets = spark.read.schema(_ANNOTATIONS).option("rowTag", "AnnotationSet").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").xml(path)
    a = sets.filter(F.col("_Name") == set_name).select(F.input_file_name().alias("doc"), F.explode("Annotation").alias("a")).filter(F.col("a._Type") == kind)
    pairs = F.transform(F.coalesce("a.Feature", F.array().cast(_FEATURES)), lambda f: F.struct(F.trim(f["Name"]).alias("k"), F.trim(f["Value"]).alias("v")))
    return a.select("doc", F.col("a._StartNode").alias("start"), F.col("a._EndNode").alias("stop"), F.map_from_entries(pairs).alias("features"))


def read_mentions(spark: SparkSession, path, set_name: str = "Key", kind: str = "Mention") -> DataFrame:
    """Mentions of an annotated corpus: doc, mention (the text, white space squeezed), cui, readable; a cui written ``null`` is null.

    Stand-off XML documents (``.xml`` and ``.finf``) under a folder, one document at a time: text with nodes, and annotations between nodes.
    A document that can't be read gives one row whose other fields are null.
    """
    import xml.etree.ElementTree as ET

    def one(text: str) -> Iterator[tuple[str | None, str | None, str | None]]:
        root = ET.fromstring(text)
        body, at, parts, size = root.find("TextWithNodes"), {}, [], 0
        for piece in [] if body is None else [body.text, *[x for node in body for x in (node, node.tail)]]:
            if isinstance(piece, str):
                parts.append(piece)
                size += len(piece)
            elif piece is not None:
                at[piece.get("id")] = size
        whole = "".join(parts)
        for group in root.iter("AnnotationSet"):
            if (group.get("Name") or "") == set_name:
                for a in group.iter("Annotation"):
                    if a.get("Type") == kind and a.get("StartNode") in at and a.get("EndNode") in at:
                        f = {(x.findtext("Name") or "").strip(): (x.findtext("Value") or "").strip() for x in a.iter("Feature")}
                        cui = f.get("CUI")
                        yield " ".join(whole[at[a.get("StartNode")] : at[a.get("EndNode")]].split()), None if cui == "null" else cui, f.get("readable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows = [(doc, *r) for r in one(text)]
                except ET.ParseError:
                    rows = [(doc, None, None, None)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], names=["doc", "mention", "cui", "readable"])

    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{xml,finf}").text(path, wholetext=True)
    return files.select(F.input_file_name().alias("doc"), "value").mapInArrow(run, "doc string, mention string, cui string, readable string")


def read_ontology(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(subclass edges, equivalence edges), each (a, b), of the classes in an RDF/XML ontology file."""
    ref = T.ArrayType(T.StructType([T.StructField("_rdf:resource", T.StringType())]))
    s = T.StructType([T.StructField("_rdf:about", T.StringType()), T.StructField("rdfs:subClassOf", ref), T.StructField("owl:equivalentClass", ref)])
    classes = spark.read.schema(s).option("rowTag", "owl:Class").xml(path)
    edge = lambda c: classes.select(F.col("`_rdf:about`").alias("a"), F.explode(f"`{c}`").alias("r")).select("a", F.col("r.`_rdf:resource`").alias("b")).filter("a is not null and b is not null")
    return edge("rdfs:subClassOf"), edge("owl:equivalentClass")
