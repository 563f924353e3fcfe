import json
import threading
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vejrkraft.functions import documents
from vejrkraft.sinks import commit, files, messages


def observed(spark, *data):
    df = spark.createDataFrame(data, "stationId string, t string, v double")
    return df.select("stationId", F.col("t").cast("timestamp").alias("timeObserved"), "v")


def test_by_year_with_guard_and_overwrite(spark, folder):
    out = f"{folder}/years"
    assert not files.write_by_year(observed(spark).limit(0), out)
    assert not Path(out).exists()
    assert files.write_by_year(observed(spark, ("b", "2020-05-01", 1.0), ("a", "2021-05-01", 2.0)), out)
    again = observed(spark, ("c", "2021-06-01", 3.0))
    with pytest.raises(FileExistsError):
        files.write_by_year(again, out)
    files.write_by_year(again, out, overwrite=True)
    files.write_by_year(observed(spark, ("d", "2022-06-01", 4.0)), out)
    got = spark.read.parquet(out).select("stationId", "year")
    assert rows(got) == [("b", 2020), ("c", 2021), ("d", 2022)]


def _all_files(folder):
    return sorted(str(p.relative_to(folder)) for p in Path(folder).rglob("*") if not p.name.startswith("."))


def test_two_writers_of_one_year(spark, folder):
    """Both write at once; one is refused, and the year is one writer's as a whole."""
    out = f"{folder}/years"
    tables = [observed(spark, *[(f"{w}{i}", f"{2020 + i % 3}-05-01", 1.0) for i in range(300)]) for w in "ab"]
    results = []

    def write(df):
        try:
            results.append(files.write_by_year(df, out))
        except FileExistsError as e:
            results.append(str(e))

    threads = [threading.Thread(target=write, args=(t,)) for t in tables]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(r is True for r in results) == 1 and sum(isinstance(r, str) for r in results) == 1
    got = spark.read.parquet(out)
    assert got.count() == 300 and got.select(F.left("stationId", F.lit(1))).distinct().count() == 1
    assert not [f for f in _all_files(out) if f.startswith("_")]


def test_a_failing_writer_leaves_nothing(spark, folder):
    out = f"{folder}/years"
    files.write_by_year(observed(spark, ("a", "2020-05-01", 1.0)), out)
    before = _all_files(out)
    bad = observed(spark, ("b", "2020-06-01", 2.0), ("c", "2021-06-01", 3.0))
    broken = bad.withColumn("v", F.when(F.col("stationId") == "c", F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("double"))
    with pytest.raises(Exception, match="no"):
        files.write_by_year(broken, out, overwrite=True)
    with pytest.raises(FileExistsError, match="2020"):
        files.write_by_year(bad, out)
    assert _all_files(out) == before


def test_a_writer_that_died_is_finished_or_undone(spark, folder, monkeypatch):
    out = f"{folder}/years"
    files.write_by_year(observed(spark, ("a", "2020-05-01", 1.0), ("a", "2021-05-01", 1.0)), out)
    new = observed(spark, ("b", "2020-05-01", 2.0), ("b", "2021-05-01", 2.0), ("b", "2022-05-01", 2.0))
    move = commit.Folder.move
    left = [3]

    def dies(self, source, target):
        if left[0] == 0:
            raise KeyboardInterrupt
        left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(commit.Folder, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        files.write_by_year(new, out, overwrite=True)
    monkeypatch.setattr(commit.Folder, "move", move)
    with pytest.raises(FileExistsError, match="another writer"):
        files.write_by_year(new, out, overwrite=True)
    assert commit.recover(spark, out, 1) == ["year=2021", "year=2022"]
    assert rows(spark.read.parquet(out).select("stationId", "year")) == [("b", 2020), ("b", 2021), ("b", 2022)]
    assert not [f for f in _all_files(out) if f.startswith("_")]
    # One that died while its tasks wrote is undone.
    Path(f"{out}/_staging-x/data/year=2030").mkdir(parents=True)
    assert commit.recover(spark, out, 1) == [] and not Path(f"{out}/_staging-x").exists()


def test_stream_messages_at_least_once(spark, folder):
    """The task that brings m3 fails with its first attempts; the batch is repeated, refused messages are listed once."""
    data = [("t", f"m{i}") for i in range(8)] + [("t", "never"), (None, "lost"), ("t", None)]
    spark.createDataFrame(data, "topic string, value string").repartition(3).write.json(f"{folder}/in")
    options = dict(sender="local_service:Receiver", box=f"{folder}/box", fail_on="m3,m5", refuse="never", retries="0")

    def send():
        stream = spark.readStream.schema("topic string, value string").json(f"{folder}/in")
        messages.send_stream(stream, dead_letters=f"{folder}/dead", checkpoint=f"{folder}/state", **options).awaitTermination()

    failures = 0
    for _ in range(4):
        try:
            send()
            break
        except StreamingQueryException:
            failures += 1
    assert failures in (1, 2)
    sent = [line for p in Path(f"{folder}/box").glob("*.txt") for line in p.read_text().split()]
    assert set(sent) == {f"t:m{i}" for i in range(8)}
    assert rows(messages.dead_letters(spark, f"{folder}/dead")) == sorted(
        [(None, "lost", "no topic"), ("t", "never", "not wanted"), ("t", None, "no value")], key=repr
    )
    told = messages.deliveries(spark, f"{folder}/dead").where("batch = 0").agg(F.sum("sent"), F.sum("refused")).first()
    assert tuple(told) == (8, 3)


def test_batch_messages_are_tried_again(spark, folder):
    df = spark.createDataFrame([("t", "m1"), ("t", "m2"), ("t", "x" * 50)], "topic string, value string")
    messages.send_batch(df, "local_service:Receiver", f"{folder}/dead", box=f"{folder}/box", fail_on="m1", retries="1")
    sent = [line for p in Path(f"{folder}/box").glob("*.txt") for line in p.read_text().split()]
    assert sorted(sent) == ["t:m1", "t:m2", "t:" + "x" * 50]
    assert messages.dead_letters(spark, f"{folder}/dead").count() == 0
    messages.send_batch(df, "vejrkraft.sinks.messages:FileSpool", f"{folder}/dead", spool=f"{folder}/spool", max_bytes="10")
    assert rows(spark.read.json(f"{folder}/spool").select("value")) == [("m1",), ("m2",)]
    assert rows(messages.dead_letters(spark, f"{folder}/dead")) == [("t", "x" * 50, "message too large")]


def test_by_month_sorts_columns(spark, folder):
    df = spark.createDataFrame([("2024-01-31T23:00:00", 2, "x"), ("2024-02-01T00:00:00", 1, "y")], "TimeUTC string, b int, a string")
    files.write_by_month(df, f"{folder}/m")
    got = spark.read.parquet(f"{folder}/m")
    assert got.columns == ["TimeUTC", "a", "b", "year", "month"]
    assert rows(got.select("b", "month")) == [(1, 2), (2, 1)]


def test_csv_keeps_order_and_leading_zeros(spark, folder):
    df = spark.createDataFrame([("06002", None), ("06001", 1.5)], "station_id string, v double")
    assert files.write_csv(df.orderBy("station_id").coalesce(1), f"{folder}/c")
    text = next(Path(f"{folder}/c").glob("*.csv")).read_text()
    assert text == "station_id,v\n06001,1.5\n06002,\n"
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_csv(df, f"{folder}/c")


def test_json_array_documents(spark, folder):
    data = [("a", i, None if i % 3 else f"line {i}\n\"x\"") for i in range(50)] + [("b", 1, "only")]
    df = spark.createDataFrame(data, "k string, n int, text string").repartition(5)
    files.write_json_arrays(df, f"{folder}/j", ["n"], ["k"])
    for key in "ab":
        parts = sorted(Path(f"{folder}/j/k={key}").glob("*.txt"))
        whole = json.loads("".join(p.read_text() for p in parts))
        assert whole == [{"n": n, "text": t} for k, n, t in data if k == key]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_one_document_by_its_manifest(spark, folder, n):
    data = [(i if i != 3 else None, f'é "{i}"\n') for i in range(n)]
    df = spark.createDataFrame(data, "n int, text string").repartition(7)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, False)
    try:
        parts = files.write_json_document(df, f"{folder}/d", ["n"]).orderBy("part").collect()
    finally:
        spark.conf.unset(coalesce)
    assert [r["offset"] for r in parts] == [sum(p["bytes"] for p in parts[:i]) for i in range(len(parts))]
    whole = bytearray(sum(p["bytes"] for p in parts))
    for r in reversed(parts):
        whole[r["offset"] : r["offset"] + r["bytes"]] = Path(r["path"].removeprefix("file:")).read_bytes()
    want = sorted(data, key=lambda r: (r[0] is None, r[0]))
    assert json.loads(whole.decode()) == [{"n": i, "text": t} for i, t in want]
    assert n < 500 or len(parts) > 1


def test_json_array_without_keys(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, t string")
    got = documents.json_array_pieces(df, ["n"]).orderBy("n").collect()
    assert json.loads("".join(r["piece"] for r in got)) == [{"n": 1, "t": "a"}, {"n": 2, "t": "b"}]


def test_message_payload(spark):
    df = spark.createDataFrame([(1, None, "ø")], "id int, name string, t string")
    value = documents.encode_json(df).first()["value"]
    assert json.loads(value) == {"id": 1, "name": None, "t": "ø"}


def test_analytics_area(spark, folder):
    path = files.write_analytics(spark.range(3), folder, "corr")
    path = files.write_analytics(spark.range(2), folder, "corr")
    assert path == f"{folder}/analytics/corr" and spark.read.parquet(path).count() == 2


def test_json_array_with_a_null_place(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, n int")
    got = documents.json_array_pieces(df, ["n"], ["k"]).orderBy("k", F.col("n").asc_nulls_last()).collect()
    assert "".join(r["piece"] for r in got if r["k"] == "a") == '[{"k":"a","n":1}, {"k":"a","n":null}]'
    assert [r["piece"] for r in got if r["k"] == "b"] == ['[{"k":"b","n":null}]']
