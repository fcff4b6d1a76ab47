import datetime as dt

from siftwell.operators.references import ledger_orphans
from siftwell.streaming import incremental

UTC = dt.timezone.utc


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute, tzinfo=UTC)


def parts(spark, tmp_path, schema, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))


def collected(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name).collect()


def test_ledger_over_batches(spark, tmp_path):
    schema = "kind string, key string, refs int, exists int"
    stream = parts(spark, tmp_path, schema, [("p", "a", 1, 0), ("p", "b", 1, 1)], [("p", "a", 0, 1), ("p", "b", 0, -1)])
    incremental.maintain_ledger(stream, str(tmp_path / "state"), str(tmp_path / "checkpoint")).awaitTermination()
    assert [r["key"] for r in ledger_orphans(spark.read.parquet(str(tmp_path / "state" / "v=1"))).collect()] == ["b"]


def test_first_arrivals(spark, tmp_path):
    schema = "n bigint, content binary, t timestamp"
    stream = parts(spark, tmp_path, schema, [(1, b"x", at(1)), (2, b"y", at(2))], [(3, b"x", at(3)), (4, b"z", at(4))])
    assert sorted(r["n"] for r in collected(incremental.first_arrivals(stream, "content", "t"), "arrivals")) == [1, 2, 4]


def test_counts_per_window(spark, tmp_path):
    schema = "key string, t timestamp"
    stream = parts(spark, tmp_path, schema, [("a", at(1)), ("a", at(5)), ("b", at(6))], [("a", at(59))])
    got = collected(incremental.counts_per_window(stream, "t", "key", "10 minutes", "1 minute"), "windows")
    assert {(r["key"], r["n"]) for r in got} == {("a", 2), ("b", 1)}
