"""From a release folder and an annotated corpus to all resources, and the sources that feed it."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from termweave.functions import labels
from termweave.operators import candidates, classes
from termweave.plans import pipelines
from termweave.sources import readers, sinks
from termweave.streaming import keyed

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DOC = """<?xml version='1.0' encoding='UTF-8'?><GateDocument><TextWithNodes><Node id="0"/>The &lt;Heart
 attack<Node id="17"/> was <Node id="22"/>bad<Node id="25"/>.</TextWithNodes>
<AnnotationSet><Annotation Id="0" Type="Mention" StartNode="0" EndNode="17"/></AnnotationSet>
<AnnotationSet Name="Key"><Annotation Id="1" Type="Mention" StartNode="0" EndNode="17"><Feature><Name>CUI</Name><Value>C1</Value></Feature></Annotation>
<Annotation Id="2" Type="Mention" StartNode="22" EndNode="25"><Feature><Name>CUI</Name><Value>null</Value></Feature><Feature><Name>readable</Name><Value>badness</Value></Feature></Annotation></AnnotationSet></GateDocument>"""


def test_release_to_resources(spark, rows, tmp_path):
    r = tmp_path / "release"
    (r / "corpus" / "deep").mkdir(parents=True)
    atom = lambda cui, lat, pref, aui, sab, text: f"{cui}|{lat}|P|L1|PF|S1|{pref}|{aui}||||{sab}|PT|1|{text}|0|N||\n"
    (r / "MRCONSO.RRF").write_text(atom("C1", "ENG", "Y", "A1", "X", "DNA") + atom("C1", "GER", "N", "A2", "Y", 'dna "a') + atom("C2", "ENG", "Y", "A3", "X", "Heart attack") + atom("C3", "ENG", "Y", "A4", "X", "Tree"))
    (r / "MRSTY.RRF").write_text("C1|T1|1|Type, one|AT1||\nC2|T2|1|Two|AT2||\nC3|T3|1|Three|AT3||\n")
    (r / "MRDEF.RRF").write_text("C1|A1|AT1||X|a\tdefinition|N||\n")
    (r / "MRCOC.RRF").write_text("D1|C1|D2|C2|5|||||||||||\nD1|C1|D3|C3|1|||||||||||\nD2|C2|D3|C3|9|||||||||||\n")
    (r / "groups.lst").write_text("# groups\nKCX:\n'Type, one'\n'Two'\n\nBMH:\n'Three'\n")
    (r / "corpus" / "a.xml").write_text(DOC)
    (r / "corpus" / "deep" / "b.finf").write_text(DOC)
    (r / "corpus" / "deep" / "c.txt").write_text("no document")
    out = str(tmp_path / "out")
    took = pipelines.run_release(spark, str(r), str(r / "groups.lst"), out, pipelines.Config(languages=("en", "de")), str(r / "corpus"))
    assert [s for s, _ in took] == ["load", "frequencies", "graph", "resources"] and spark.read.text(f"{out}/timings").count() == 4
    assert rows(spark.read.parquet(f"{out}/tables/freq")) == [("C1", 2, 0.5), ("badness", 2, 0.5)]
    assert rows(spark.read.parquet(f"{out}/tables/label_freq")) == [("bad", "badness", 2, 1.0), ("the <heart attack", "C1", 2, 1.0)]
    assert rows(spark.read.text(f"{out}/graph")) == [("u:C1 v:C2 w:5",), ("u:C2 v:C3 w:9",)]
    rank = dict(rows(spark.read.parquet(f"{out}/tables/rank")))
    assert set(rank) == {"C1", "C2", "C3"} and abs(sum(rank.values()) - 1) < 1e-9 and rank["C2"] > rank["C3"] > rank["C1"]
    info = {x.label: x for x in spark.read.parquet(f"{out}/labelinfo").collect()}
    assert set(info) == {"DNA", 'dna "a', "heart attack"} and info["DNA"].pagerank == rank["C1"] and info["DNA"].criscuifreq == 2
    assert rows(spark.read.parquet(f"{out}/candidates").groupBy("lang").count()) == [("de", 3), ("en", 3)]
    text = lambda p: [x.value for x in spark.read.text(f"{out}/{p}").collect()]
    assert text("gazetteer/en/cased-labels.lst") == ["DNA"] and text("gazetteer/en/uncased-labels.lst") == ["Heart attack"] and text("gazetteer/de/uncased-labels.lst") == ['dna "a']
    assert text("gazetteer/de/cased-labels.def") == ["cased-labels.lst:umls:cased"]
    assert rows(spark.read.parquet(f"{out}/abstracts").select("cui", "def", "lang")) == [("C1", "a&#x0009;definition", "de"), ("C1", "a&#x0009;definition", "en")]


def test_mentions(spark, rows, tmp_path):
    (tmp_path / "a.xml").write_text(DOC)
    (tmp_path / "b.xml").write_text("<GateDocument>")
    (tmp_path / "c.xml").write_text("<GateDocument/>")
    assert rows(readers.read_mentions(spark, str(tmp_path)).select("mention", "cui", "readable")) == [("The <Heart attack", "C1", None), ("bad", None, "badness"), (None, None, None)]


def test_wiki_text_and_documents(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "''A'' &#233;&eacute;&nbsp;b &lt;ref&gt;x&lt;/ref&gt;[[b|c]]"), (12345, None)], "id long, t string")
    assert rows(df.select(readers.wiki_plain(F.col("t")))) == [("A éé b c",), (None,)]
    page = lambda i: f"<page><title>t{i}</title><ns>0</ns><id>{i}</id><revision><id>9</id><text>x</text></revision></page>"
    (tmp_path / "w.xml").write_text("<mediawiki>" + "".join(map(page, (30, 4, 200))) + "</mediawiki>")
    assert [r.id for r in readers.read_wiki(spark, str(tmp_path / "w.xml"), max_docs=2).collect()] == ["4", "30"]
    sinks.write_documents(df, "id", str(tmp_path / "docs"))
    assert rows(spark.read.parquet(str(tmp_path / "docs")).selectExpr("id", "cast(dir AS string)", "file")) == [(1, "0", "01"), (12345, "23", "45")]


def test_lower_case_by_language(spark):
    df = spark.createDataFrame([("TITAN İI Í",)], "s string")
    low = lambda lang: df.select(labels.lower(F.col("s"), lang).alias("x")).first().x
    assert low("tr") == "tıtan iı í" and low("lt").endswith("i̇́") and low(None) == "TITAN İI Í".lower()
    assert [r.s for r in labels.normalize_labels(spark.createDataFrame([("IRIS",)], "s string"), "s", "tr").collect()] == ["ırıs"]


def test_jdbc_rows(spark, rows):
    url = "jdbc:derby:memory:rows;create=true"
    try:
        con = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    except Exception:
        pytest.skip("no embedded database among the jars")
    st = con.createStatement()
    st.execute("CREATE TABLE t (a INT, b VARCHAR(9))")
    st.execute("INSERT INTO t VALUES (1, 'x'), (2, NULL)")
    assert rows(readers.jdbc_rows(spark, url, "SELECT a, b FROM t", driver="org.apache.derby.jdbc.EmbeddedDriver")) == [("1\tx",), ("2\tnull",)]


def test_missing_scores_as_zero(spark):
    df = spark.createDataFrame([("l", "C1", "s", "t", None, "v", "v", None, None, 1, 0.5, None)], "label string, cui string, stys string, tuis string, pref string, labelvocabs string, cuivocabs string, crislabelcuifreq int, crislabelcuinorm double, criscuifreq int, criscuinorm double, pagerank double")
    info = candidates.label_candidates(df, zero_numbers=True).first().info
    assert '"PREF":null' in info and '"scPageRank":0.0' in info and '"scCRISLabelCUIFreq":0,' in info


def test_ship():
    """In a session of its own, started elsewhere: workers find the package."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\nfrom pyspark.sql import SparkSession\nfrom pyspark.sql import functions as F\nfrom termweave import session\nfrom termweave.functions import labels\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\nsession.ship(s); session.ship(s)\n"
        "print('got', s.range(9).select(labels.nfkc(F.col('id').cast('string'))).count(), s.range(1).select(labels.nfkc(F.lit('x'))).first()[0])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=200)
    assert "got 9 x" in done.stdout, done.stderr[-2000:]


def test_classes_on_a_stream(spark, rows, tmp_path):
    own = spark.createDataFrame([(c, c) for c in "abcdx"], "cls string, to string")
    inter = spark.createDataFrame([("a", "A"), ("b", "A"), ("c", classes.THING)], "cls string, to string")
    up = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("d", "x")], "cls string, to string")
    data = [(f"u{i % 5}", "abcdx?"[i * 7 % 6], i) for i in range(60)] + [("v", "a", 1), ("v", "c", 2), ("v", "d", 3), ("v", "x", 4), ("v", "b", 5)]
    df = spark.createDataFrame(data, "uri string, cls string, line_no int")
    want = rows(classes.specific_classes(df, own, inter, up))
    assert ("v", "c|d", "A") in want
    for size in ("10000", "2"):
        at = tmp_path / size
        df.repartition(1).write.parquet(str(at / "in"))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            s = spark.readStream.schema(df.schema).parquet(str(at / "in"))
            assert rows(keyed.drained(keyed.running_classes(s, own, inter, up, "uri", "cls", "line_no"), str(at / "o"), str(at / "c"), ["uri"])) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
