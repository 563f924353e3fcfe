import json
import os
import zipfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft import schemas
from vejrkraft.operators.profiles import latest_details
from vejrkraft.plans.collection import collect_observations, profile_stations, stations_for
from vejrkraft.sources import files, pages, requests, stations


def write(path, text, encoding="utf-8"):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding=encoding)
    return str(path)


def test_csv_with_bom_and_nan(spark, folder):
    path = write(f"{folder}/p.csv", "code,name,latitude,longitude\n400,Å,55.1,14.9\n101,B,NaN,\n", "utf-8-sig")
    df = stations.read_points(spark, path)
    assert df.columns == ["code", "name", "latitude", "longitude", "ord"]
    got = df.orderBy("ord").drop("ord").collect()
    assert [tuple(r) for r in got] == [(400, "Å", 55.1, 14.9), (101, "B", None, None)]


def test_semicolon_csv_and_several_files_by_name(spark, folder):
    a = write(f"{folder}/a.csv", "station_id;value\n06001;1.5\n")
    b = write(f"{folder}/b.csv", "value;station_id\nbad;06002\n")
    df = files.read_csv(spark, [a, b], schemas.WIND_TYPES, sep=";")
    assert rows(df) == [("06001", 1.5), ("06002", None)]


def test_zip_reads_the_first_entry_only(spark, folder):
    with zipfile.ZipFile(f"{folder}/c.zip", "w") as z:
        z.writestr("2024.csv", "TimeUTC,MunicipalityCode,ConsumptionkWh\n2024-01-01T00:00:00,101,2.5\n,,\n")
        z.writestr("other.csv", "TimeUTC\nnever\n")
    df = files.read_zipped_csv(spark, f"{folder}/c.zip", schemas.CONSUMPTION_COLUMNS, schemas.CONSUMPTION_TYPES)
    got = [tuple(r) for r in df.drop("archive", "entry").orderBy("ord").collect()]
    assert got == [
        ("2024-01-01T00:00:00", None, 101, None, None, 2.5, 0),
        (None, None, None, None, None, None, 1),
    ]


def test_every_entry_of_a_folder_of_archives(spark, folder, monkeypatch):
    for name in "ab":
        with zipfile.ZipFile(f"{folder}/{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("data/", "")
            for i in range(2):
                lines = "".join(f"{name}{i};{k}\n" for k in range(3))
                z.writestr(f"data/{i}.csv", f"id;{'n' if i else 'm'}\n{lines}")
    df = files.read_zipped_csv(spark, folder, ["n", "id"], {"n": "int"}, sep=";", entries="all")
    assert df.rdd.getNumPartitions() == 4
    got = rows(df.select("id", "n", F.regexp_extract("archive", r"(\w)\.zip", 1), "entry", "ord"))
    assert got == [(f"{a}{i}", k if i else None, a, f"data/{i}.csv", k) for a in "ab" for i in range(2) for k in range(3)]


def test_ndjson(spark, folder):
    path = write(f"{folder}/d.txt", '{"id": 1, "name": "a"}\n\n{"id": 2}\n')
    assert rows(files.read_ndjson(spark, path, "id long, name string")) == [(1, "a"), (2, None)]
    docs = files.read_ndjson(spark, path).select(F.variant_get("document", "$.id", "int").alias("id"))
    assert rows(docs) == [(1,), (2,)]
    bad = write(f"{folder}/bad.txt", '{"id": 1}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        files.read_ndjson(spark, bad, "id long").collect()


def feature(station, when, value, coords=(9.0, 55.0), **more):
    props = {"stationId": station, "from": when, "value": value, **more}
    return {"geometry": {"coordinates": list(coords)} if coords else None, "properties": props}


def land(folder, parameter, offset, features):
    path = f"{folder}/parameter={parameter}/offset={offset}/page.json"
    return write(path, json.dumps({"type": "FeatureCollection", "features": features}, indent=1))


def test_observation_pages_and_quarantine(spark, folder):
    land(folder, "acc_precip", 0, [
        feature("06001", "2024-01-01T00:00:00+01:00", 1.25),
        feature("06001", "2024-01-02T00:00:00+01:00", None, coords=None),
        {"geometry": None, "properties": None},
        feature(None, "2024-01-01T00:00:00+01:00", 1),
        feature("06002", "2024-01-01T00:00:00+01:00", "wet"),
        feature("06003", "2024-01-01T00:00:00+01:00", 3, coords=(9.5,)),
    ])
    good, bad = pages.observations(pages.read_observation_pages(spark, folder))
    assert [tuple(r) for r in good.orderBy("arrival").collect()] == [
        ("acc_precip", 0, "06001", "2024-01-01T00:00:00+01:00", 1.25, 55.0, 9.0, 0),
        ("acc_precip", 0, "06001", "2024-01-02T00:00:00+01:00", None, None, None, 1),
        ("acc_precip", 0, "06003", "2024-01-01T00:00:00+01:00", 3.0, None, 9.5, 5),
    ]
    assert rows(bad.select("arrival", "reason")) == [
        (2, "no station"),
        (3, "no station"),
        (4, "unreadable value"),
    ]


def test_every_landed_page_is_read(spark, folder):
    layout = {
        "a": {0: 2, 2: 2, 4: 1, 6: 2},  # a short page in the middle
        "b": {0: 2, 4: 2},  # a page is missing
        "c": {0: 0, 2: 2},  # empty at first
        "d": {0: 2, 1_000_000: 2, 1_000_002: 2},  # far beyond a gap
    }
    for parameter, counts in layout.items():
        for offset, n in counts.items():
            land(folder, parameter, offset, [feature(f"{parameter}{offset}", "t", 1)] * n)
    # One page was landed before with less in it.
    old = Path(f"{folder}/parameter=a/offset=2/old.json")
    old.write_text(json.dumps({"features": [feature("gone", "t", 1)]}))
    os.utime(old, (1, 1))
    landed = pages.read_observation_pages(spark, folder)
    good, _ = pages.observations(pages.last_landings(landed))
    want = [(p, f"{p}{o}", o + i) for p, counts in layout.items() for o, n in counts.items() for i in range(n)]
    assert rows(good.select("parameter", "station_id", "arrival")) == sorted(want, key=repr)
    ledger = pages.page_ledger(landed, limit=2)
    assert rows(ledger) == sorted(
        [
            ("a", 0, 1, 2, True, False, False), ("a", 2, 2, 2, True, False, False), ("a", 4, 1, 1, False, False, False),
            ("a", 6, 1, 2, True, False, True), ("b", 0, 1, 2, True, False, True), ("b", 4, 1, 2, True, True, True),
            ("c", 0, 1, 0, False, False, False), ("c", 2, 1, 2, True, False, True), ("d", 0, 1, 2, True, False, True),
            ("d", 1_000_000, 1, 2, True, True, False), ("d", 1_000_002, 1, 2, True, False, True),
        ],
        key=repr,
    )


def test_record_pages(spark, folder):
    for offset, codes in {0: [101, 147], 2: [201], 40_000: [301]}.items():
        records = [{"TimeUTC": "2024-01-01T00:00:00", "MunicipalityCode": c, "ConsumptionkWh": 1.5} for c in codes]
        write(f"{folder}/offset={offset}/page.json", json.dumps({"total": 3, "records": records}))
    got = pages.read_record_pages(spark, folder).select("MunicipalityCode", "ConsumptionkWh", "ord")
    assert rows(got) == [(101, 1.5, 0), (147, 1.5, 1), (201, 1.5, 2), (301, 1.5, 40_000)]


def test_details_over_several_pages(spark, folder):
    one = lambda s, n: {"properties": {"stationId": s, "name": n}}
    write(f"{folder}/offset=10/p.json", json.dumps({"features": [one("a", "new"), one(None, "lost")]}))
    write(f"{folder}/offset=0/p.json", json.dumps({"features": [one("b", "B"), one("c", "C"), one("a", "old")]}))
    good, bad = pages.station_details(pages.last_landings(pages.read_detail_pages(spark, folder), by=()))
    assert rows(latest_details(good).select("station_id", "name")) == [("a", "new"), ("b", "B"), ("c", "C")]
    assert rows(bad.select("name", "reason")) == [("lost", "no station")]


def test_profile_and_collection_from_pages(spark, folder):
    t = "2024-01-01T00:00:00+00:00"
    land(f"{folder}/obs", "mean_wind_speed", 0, [
        feature("06154", t, 4.5), feature("06154", t, 4.5), feature("06154", "2024-01-01T01:00:00+00:00", None),
        feature("99999", t, 7.0, coords=None),
    ])
    land(f"{folder}/obs", "mean_wind_dir", 0, [feature("06154", t, 270.0)])
    details = [
        {"properties": {"stationId": "06154", "name": "Old", "status": "Active"}},
        {"properties": {"stationId": "06154", "name": "Brandelev", "country": "DNK"}},
        {"properties": {"stationId": "00000", "name": "Elsewhere"}},
    ]
    write(f"{folder}/details/page.json", json.dumps({"features": details}))
    got = profile_stations(spark, "wind", f"{folder}/obs", f"{folder}/details", f"{folder}/rejects")
    keep = ["station_id", "name", "country", "status", "wind_parameters_measured", "parameter_count",
            "total_wind_observations", "max_wind_speed_recorded_ms", "latitude"]
    assert [tuple(r) for r in got.select(keep).collect()] == [
        ("06154", "Brandelev", "DNK", "Unknown", "mean_wind_dir, mean_wind_speed", 2, 4, 4.5, 55.0),
        ("99999", None, None, None, "mean_wind_speed", 1, 1, 7.0, None),
    ]
    assert spark.read.parquet(f"{folder}/rejects/observations").count() == 0
    obs, _ = pages.observations(pages.read_observation_pages(spark, f"{folder}/obs"))
    out = collect_observations(obs, stations_for(spark, fv.MEAN_WIND_SPEED), fv.MEAN_WIND_SPEED)
    out = out.withColumn("timeObserved", F.col("timeObserved").cast("string"))
    assert rows(out) == [("2024-01-01 00:00:00", "06154", "Brandelev", 4.5)]


def test_station_lists(spark):
    assert stations_for(spark, fv.MEAN_WIND_SPEED).count() == 57
    assert stations_for(spark, fv.SUNSHINE).count() == 28


def test_load_stations_is_tolerant(spark, folder):
    wind = write(f"{folder}/w.csv", "station_id,name,Lat,LON,status\n06001,A,55.5,9.5,Active\n06002,B,x,9,Active\n")
    sun = write(f"{folder}/s.csv", "station_id,latitude,longitude\n06003,56,10\n")
    flat = write(f"{folder}/n.csv", "station_id,name\n06004,C\n")
    paths = {"wind": wind, "precipitation": f"{folder}/none.csv", "sunlight": sun, "other": flat}
    got = stations.load_stations(spark, paths)
    assert [tuple(r) for r in got.orderBy("ord").select("station_id", "name", "station_type", "status").collect()] == [
        ("06001", "A", "wind", "Active"),
        ("06003", "Sunlight Station 06003", "sunlight", None),
    ]
    with pytest.raises(FileNotFoundError):
        stations.load_stations(spark, {"wind": f"{folder}/none.csv"})


def test_collection_keeps_the_first_of_one_instant(spark):
    t = ["2024-01-01T01:00:00+01:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+01:00", "no time"]
    given = [(2, t[0], 2.0), (1, t[1], 1.0), (3, t[2], 3.0), (5, t[3], 5.0), (4, t[3], 4.0), (6, t[1], None)]
    data = [(fv.MEAN_WIND_SPEED, "06154", time, value, at) for at, time, value in given]
    obs = spark.createDataFrame(data, "parameter string, station_id string, observed_from string, value double, arrival long")
    out = collect_observations(obs, stations_for(spark, fv.MEAN_WIND_SPEED), fv.MEAN_WIND_SPEED)
    assert sorted(r[fv.MEAN_WIND_SPEED] for r in out.collect()) == [1.0, 3.0, 4.0]


def test_paged_requests(spark):
    requests.register(spark)
    read = spark.read.format("paged_requests").option("fetch", "local_service:page")
    read = read.options(parameters="bright_sunshine, mean_radiation, broken", limit="2", offset_end="8")
    requested = read.load()
    page = F.from_json("document", "features array<struct<properties: struct<stationId: string>>>")
    got = requested.groupBy("parameter").agg(
        F.sum(F.coalesce(F.size(page["features"]), F.lit(0))), F.count("error")
    )
    assert {r[0]: r[2] > 0 for r in got.collect()} == {"bright_sunshine": False, "mean_radiation": False, "broken": True}
    assert requests.answered(requested.where("parameter <> 'broken'")).count() > 0
    with pytest.raises(Exception, match="request failed: broken"):
        requests.answered(requested).collect()
    with pytest.raises(Exception, match="offset_end"):
        spark.read.format("paged_requests").option("fetch", "local_service:page").options(parameters="a").load().count()


def test_lines_of_the_wrong_width_are_kept(spark, folder):
    """Short, long and quoted lines of two files with columns in different order; an empty last field is no gap."""
    first = 'a,b,c.d\n1,x,\n2,y\n3,"z,z",4\n5,"q""q",6\n7,8,9,10\n'
    Path(f"{folder}/1.csv").write_text(first)
    Path(f"{folder}/2.csv").write_text("c.d,a,b\n9,8,7\nalone\n")
    df = files.read_csv(spark, [f"{folder}/1.csv", f"{folder}/2.csv"], {"a": "int"}, record="line")
    good, bad = files.split_records(df, "line")
    assert rows(good) == sorted([(1, "x", None), (3, "z,z", "4"), (5, 'q"q', "6"), (8, "7", "9")], key=repr)
    assert rows(bad) == sorted([("2,y",), ("7,8,9,10",), ("alone",)], key=repr)
    assert bad.count() == 3 and good.select("b").count() == 4
    with pytest.raises(ValueError, match="have a column"):
        files.read_csv(spark, f"{folder}/1.csv", record="a")


def test_pages_as_lines(spark, folder):
    """Many pages in a file: later files replace earlier ones page by page, later lines earlier ones of their file."""
    page = lambda o, *stations: json.dumps({"offset": o, "features": [feature(s, "t", 1) for s in stations]})
    write(f"{folder}/parameter=a/old", "\n".join([page(0, "gone"), page(4, "kept")]))
    os.utime(f"{folder}/parameter=a/old", (1, 1))
    write(f"{folder}/parameter=a/new", "\n".join([page(0, "gone", "too"), page(0, "a0", "a1"), page(2, "a2")]))
    write(f"{folder}/parameter=b/one", "\n".join([page(0, "b0"), page(None, "b1"), page(None, "b2")]))
    landed = pages.read_observation_pages(spark, folder, lines=True)
    good, _ = pages.observations(pages.last_landings(landed))
    assert rows(good.select("parameter", "page", "station_id")) == sorted(
        [("a", 0, "a0"), ("a", 0, "a1"), ("a", 2, "a2"), ("a", 4, "kept"), ("b", 0, "b0"), ("b", None, "b1"), ("b", None, "b2")], key=repr
    )
    ledger = pages.page_ledger(landed, limit=2).where("parameter = 'a'").select("offset", "landings", "rows")
    assert rows(ledger) == [(0, 3, 2), (2, 1, 1), (4, 1, 1)]


def test_files_of_pages_do_not_grow_with_the_pages(spark, folder):
    from vejrkraft.registry import io_checks

    found = spark.range(5000).select(F.col("id").alias("event_id"), F.lit("a").alias("parameter"), F.col("id").cast("string").alias("s"))
    item = F.struct(F.struct(F.col("s").alias("stationId")).alias("properties"))
    out = io_checks._land_twice(spark, found, "event_id", ["parameter"], item, "features", 100)
    landed = pages.read_observation_pages(spark, out, lines=True)
    assert landed.count() == 21 and landed.select("file").distinct().count() <= 16
    good, _ = pages.observations(pages.last_landings(landed))
    assert good.count() == good.select("station_id").distinct().count() == 5000


def test_archive_without_entries_gives_no_rows(spark, folder):
    with zipfile.ZipFile(f"{folder}/empty.zip", "w"):
        pass
    with zipfile.ZipFile(f"{folder}/full.zip", "w") as z:
        z.writestr("a.csv", "n\n1\n2\n")
    assert rows(files.read_zipped_csv(spark, folder, ["n"], {"n": "int"}, entries="all").select("n")) == [(1,), (2,)]
