import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vejrkraft.functions.areas import price_area
from vejrkraft.operators.cleaning import split_rejects
from vejrkraft.operators.nearest import nearest_point
from vejrkraft.sources import requests
from vejrkraft.streaming import ingest, labels

MESSAGE = "id long, datetime timestamp, municipality_code int, ConsumptionkWh double, latitude double, longitude double"


def drop_files(folder, *batches):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for i, batch in enumerate(batches):
        Path(f"{folder}/{i}.json").write_text("\n".join(json.dumps(r) for r in batch))


def message(i, hour, code=101, kwh=1.5):
    return {
        "id": i,
        "datetime": f"2024-01-01T{hour:02d}:10:00Z",
        "municipality_code": code,
        "ConsumptionkWh": kwh,
        "latitude": 55.0 + i,
        "longitude": 9.0 + i,
    }


def cleaned(df, points):
    good, _ = split_rejects(df, {"no code": F.col("municipality_code").isNotNull()})
    good = good.withColumn("area", price_area("longitude", "longitude"))
    return nearest_point(good, points, out="nearest")


def test_settings():
    got = ingest.settings({"TOPIC": "price", "BOOTSTRAP_SERVERS": "a:1,b:2"})
    assert got == {"source": None, "topic": "price", "servers": ["a:1", "b:2"], "poll_seconds": 45}
    assert ingest.settings({"TOPIC": "x"})["poll_seconds"] == 10


def test_landing_equals_batch(spark, folder):
    drop_files(f"{folder}/in", [message(i, 1) for i in range(4)], [message(9, 2, None), message(5, 3)])
    points = spark.createDataFrame([(1, 55.0, 9.0, 0), (2, 60.0, 14.0, 1)], "code int, latitude double, longitude double, ord int")
    # A stream cannot be joined to its own distinct coordinates, so those come from a lookup table.
    lookup = spark.read.schema(MESSAGE).json(f"{folder}/in").select("latitude", "longitude").distinct()
    lookup = nearest_point(lookup, points, out="nearest")
    stream = ingest.stream_files(spark, f"{folder}/in", MESSAGE)
    good, _ = split_rejects(stream, {"no code": F.col("municipality_code").isNotNull()})
    good = good.withColumn("area", price_area("longitude", "longitude")).join(lookup, ["latitude", "longitude"], "left")
    ingest.land(good, f"{folder}/out", f"{folder}/state").awaitTermination()
    batch = cleaned(spark.read.schema(MESSAGE).json(f"{folder}/in"), points)
    out = spark.read.parquet(f"{folder}/out").select(batch.columns)
    assert rows(out) == rows(batch) and out.count() == 5
    # Files already taken are not taken again.
    drop_files(f"{folder}/in2", [message(7, 4)])
    Path(f"{folder}/in2/0.json").rename(f"{folder}/in/new.json")
    ingest.land(good, f"{folder}/out", f"{folder}/state").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 6


def test_batch_clean_up_runs_on_a_stream(spark, folder):
    drop_files(f"{folder}/in", [message(i, 1) for i in range(4)], [message(9, 2, None), message(5, 3)], [message(6, 3)])
    points = spark.createDataFrame([(1, 55.0, 9.0, 0), (2, 60.0, 14.0, 1)], "code int, latitude double, longitude double, ord int")
    stream = ingest.stream_files(spark, f"{folder}/in", MESSAGE, maxFilesPerTrigger="1")
    ingest.clean_batches(stream, lambda b: cleaned(b, points), f"{folder}/out", f"{folder}/state").awaitTermination()
    batch = cleaned(spark.read.schema(MESSAGE).json(f"{folder}/in"), points)
    out = spark.read.parquet(f"{folder}/out")
    assert rows(out.select(batch.columns)) == rows(batch) and out.select("batch").distinct().count() == 3


def test_open_and_changed_hours_are_closed_by_a_batch(spark, folder):
    drop_files(f"{folder}/in", [message(i, h, 101 + i % 2) for h in range(6) for i in range(5)])
    stream = ingest.stream_files(spark, f"{folder}/in", MESSAGE)
    ingest.land(ingest.hourly_consumption(stream, "1 hour"), f"{folder}/out", f"{folder}/state").awaitTermination()
    landed = spark.read.schema(MESSAGE).json(f"{folder}/in")
    emitted = spark.read.parquet(f"{folder}/out")
    rest = ingest.open_hours(landed, emitted)
    whole = ingest.hourly_consumption(landed, "1 hour")
    assert rest.count() > 0 and rows(emitted.unionByName(rest)) == rows(whole)
    late = landed.limit(1).unionByName(landed)
    assert ingest.open_hours(late, whole).count() == 1


def test_hourly_sum_equals_batch_up_to_the_watermark(spark, folder):
    drop_files(f"{folder}/in", [message(i, h, 101 + i % 2) for h in range(6) for i in range(5)])
    stream = ingest.stream_files(spark, f"{folder}/in", MESSAGE)
    hourly = ingest.hourly_consumption(stream, "1 hour")
    ingest.land(hourly, f"{folder}/out", f"{folder}/state").awaitTermination()
    drop_files(f"{folder}/late", [message(1, 9)])
    Path(f"{folder}/late/0.json").rename(f"{folder}/in/late.json")
    ingest.land(hourly, f"{folder}/out", f"{folder}/state").awaitTermination()
    batch = ingest.hourly_consumption(spark.read.schema(MESSAGE).json(f"{folder}/in"), "1 hour")
    closed = batch.where(F.col("datetime") < F.lit("2024-01-01 07:00:00").cast("timestamp"))
    got = spark.read.parquet(f"{folder}/out")
    assert rows(got) == rows(closed) and got.count() == 12


def _labelled(spark, folder, *batches, keep="1 day"):
    """Emitted rows after each batch of (ord, time, code, kwh, place, count)."""
    schema = "ord long, datetime timestamp, code int, kwh double, place string, region long, other string"
    emitted = []
    for i, batch in enumerate(batches):
        Path(f"{folder}/in").mkdir(exist_ok=True)
        names = ("ord", "datetime", "code", "kwh", "place", "region")
        lines = [json.dumps(dict(zip(names, (r[0], f"2024-01-{r[1]}Z", *r[2:])))) for r in batch]
        Path(f"{folder}/in/{i}.json").write_text("\n".join(lines))
        stream = ingest.stream_files(spark, f"{folder}/in", schema)
        hourly = labels.hourly_with_labels(stream, "1 hour", keep, key="code", value="kwh", labels=["place", "region"])
        with labels.rocksdb_state(spark):
            query = ingest.land(hourly, f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
        emitted.append(rows(spark.read.parquet(f"{folder}/out").select(F.date_format("datetime", "dd HH"), "code", "kwh", "place", "region", "revision")))
    return emitted


def test_late_rows_correct_the_hour(spark, folder):
    big = 2**53 + 1
    first = [(5, "01T10:10:00", 1, 1.5, None, big), (6, "01T10:50:00", 1, None, "b", None), (7, "01T11:59:59", 1, 4.0, "c", 1)]
    first += [(8, "01T10:00:00", None, 9.0, "x", 1), (9, "01T10:20:00", 2, None, None, None)]
    on = [(10, "01T12:30:00", 1, 1.0, "d", 2)]  # hour 10 has settled
    late = [(1, "01T10:59:00", 1, 0.25, "a", None), (11, "01T10:01:00", 1, 1.0, "z", 3)]
    far = [(12, "03T00:00:00", 1, 1.0, "e", 4)]  # hours of the first day are dropped from now on
    gone = [(13, "01T10:30:00", 1, 99.0, "y", 5), (14, "03T05:00:00", 2, 2.0, None, None)]
    got = _labelled(spark, folder, first, on, late, far, gone)
    hour10 = [("01 10", 1, 1.5, "b", big, 1), ("01 10", 2, 0.0, None, None, 1)]
    assert got[0] == [] and got[1] == sorted(hour10, key=repr)
    assert got[2] == sorted([*hour10, ("01 10", 1, 2.75, "a", big, 2)], key=repr)
    day1 = [*got[2], ("01 11", 1, 4.0, "c", 1, 1), ("01 12", 1, 1.0, "d", 2, 1)]
    assert got[3] == sorted(day1, key=repr)
    assert got[4] == sorted([*day1, ("03 00", 1, 1.0, "e", 4, 1)], key=repr)
    last = labels.last_revisions(spark.read.parquet(f"{folder}/out"), key="code")
    assert last.count() == 5 and "revision" not in last.columns
    assert last.where("kwh = 2.75").count() == 1


def test_repeated_polls_are_dropped(spark, folder):
    drop_files(f"{folder}/in", [message(1, 1), message(1, 1)], [message(1, 1), message(2, 1)])
    stream = ingest.stream_files(spark, f"{folder}/in", MESSAGE)
    once = ingest.once_per_document(stream, ["id"], "datetime", "1 hour")
    ingest.land(once, f"{folder}/out", f"{folder}/state").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2]


def test_decode_and_route(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "id int, kind string")
    routed = ingest.route_topics(df, "kind", {"a": "weather", "b": "price"})
    got = ingest.decode(routed, "id int, kind string")
    assert rows(got) == [("price", 2, "b"), ("weather", 1, "a")]
    bad = spark.createDataFrame([("weather", "{oops")], "topic string, value string")
    assert rows(ingest.decode(bad, "id int")) == []
    assert rows(ingest.undecoded(bad, "id int")) == [("weather", "{oops")]
    assert rows(ingest.undecoded(routed, "id int, kind string")) == []
    assert rows(ingest.unrouted(df, "kind", {"a": "weather", "b": "price"})) == [(3, "z")]
    with pytest.raises(ValueError):
        ingest.decode(bad, "id int", fmt="xml")


def test_polling_source(spark, folder):
    requests.register(spark)
    stream = spark.readStream.format("polled_document").option("fetch", "local_service:document,local_service:failing").load()
    query = ingest.land(stream, f"{folder}/out", f"{folder}/state", every="0 seconds")
    try:
        for _ in range(200):
            if query.lastProgress and query.lastProgress["batchId"] >= 3:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    got = spark.read.parquet(f"{folder}/out")
    told = {(r["source"], r["document"], r["error"]) for r in got.select("source", "document", "error").distinct().collect()}
    assert {s: (d, e) for s, d, e in told} == {
        "local_service:document": ('{"id": 208, "name": "x"}', None),
        "local_service:failing": (None, "OSError: no answer"),
    }
    assert got.groupBy("poll").count().where("count <> 2").count() == 0
