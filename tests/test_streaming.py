import uuid

from termweave.operators import classes, freq
from termweave.streaming import keyed


def stream(spark, tmp_path, df, parts=3):
    at = str(tmp_path / uuid.uuid4().hex)
    df.repartition(parts).write.parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)


def test_mention_counts_over_batches(spark, tmp_path, rows):
    df = spark.createDataFrame([(f"m{i % 7}", "x" if i % 3 else None) for i in range(100)], "mention string, anchor string")
    got = keyed.drained(keyed.running_mention_counts(stream(spark, tmp_path, df)), str(tmp_path / "o"), str(tmp_path / "c"), ["mention"])
    assert rows(got) == rows(freq.mention_counts(df))


def test_row_operator_on_a_stream(spark, tmp_path, rows):
    df = spark.createDataFrame([("a-b 1",), ("?",), (None,)], "s string")
    q = keyed.cleaned_literals(stream(spark, tmp_path, df), "s").writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == [("a-b",)]


def test_merge_in_one_batch_equals_the_fold(spark, tmp_path, rows):
    df = spark.createDataFrame([("l", f"u{i % 3}", f"s{i * 7 % 12}", "a", None, i) for i in range(60)], "label string, uri string, v0 string, v1 string, v2 string, line_no int")
    got = keyed.drained(keyed.running_merge(stream(spark, tmp_path, df, 1), "label", "uri", ["v0", "v1", "v2"], "line_no"), str(tmp_path / "o"), str(tmp_path / "c"), ["label", "uri"])
    want = classes.merge_label_info(df, ["label", "uri"], ["v0", "v1", "v2"], "line_no")
    assert rows(got.select("label", "uri", "v0", "v1", "v2")) == rows(want)


def test_merge_keeps_state_between_batches(spark, tmp_path):
    df = spark.createDataFrame([("l", "u", f"s{i}", "a", "b", i) for i in range(6)], "label string, uri string, v0 string, v1 string, v2 string, line_no int")
    got = keyed.drained(keyed.running_merge(stream(spark, tmp_path, df, 3), "label", "uri", ["v0", "v1", "v2"], "line_no"), str(tmp_path / "o"), str(tmp_path / "c"), ["label", "uri"]).collect()
    assert len(got) == 1 and sorted(got[0].v0.split("|")) == [f"s{i}" for i in range(6)] and got[0].v1 == "a"


def test_merge_of_a_group_in_many_frames(spark, tmp_path, rows):
    df = spark.createDataFrame([("l", "u", f"s{i * 7 % 40}", "a" if i % 2 else None, f"{i % 5}", i) for i in reversed(range(200))], "label string, uri string, v0 string, v1 string, v2 string, line_no int")
    want = rows(classes.merge_label_info(df, ["label", "uri"], ["v0", "v1", "v2"], "line_no"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = rows(keyed.drained(keyed.running_merge(stream(spark, tmp_path, df, 1), "label", "uri", ["v0", "v1", "v2"], "line_no"), str(tmp_path / "o"), str(tmp_path / "c"), ["label", "uri"]).select("label", "uri", "v0", "v1", "v2"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == want
