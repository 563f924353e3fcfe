"""The whole study from small files, and the collections from landed pages."""

import json
import zipfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.plans import collection, study
from vejrkraft.sources import pages


@pytest.fixture
def inputs(folder):
    def write(name, text):
        Path(f"{folder}/{name}").write_text(text, encoding="utf-8")
        return f"{folder}/{name}"

    head = "MTU (UTC),Area,Day-ahead Price (EUR/MWh),price_eur_mwh,Intraday Period (UTC),Intraday Price (EUR/MWh)\n"
    price = lambda area, p0, p1: write(
        f"{area}.csv",
        head
        + f"01/01/2024 00:00:00 - 01/01/2024 01:00:00,BZN|{area},x,{p0},,\n"
        + f"01/01/2024 01:00:00 - 01/01/2024 02:00:00,BZN|{area},x,{p1},,\n",
    )
    with zipfile.ZipFile(f"{folder}/use.zip", "w") as z:
        z.writestr(
            "use.csv",
            "TimeUTC,TimeDK,MunicipalityCode,Municipality,RegionName,ConsumptionkWh\n"
            "2024-01-01T01:00:00,2024-01-01T02:00:00,101,Kbh,H,5.5\n"
            "2024-01-01T01:00:00,2024-01-01T02:00:00,101,Kbh,H,4.5\n"
            "2024-01-01T02:00:00,2024-01-01T03:00:00,751,Aarhus,M,7\n",
        )
    sun = "date;to_time;station_id;latitude;longitude;sunshine_minutes\n2024-01-01;01:00;06180;55.6;12.6;30\n"
    wind = (
        "date;to_time;station_id;latitude;longitude;parameter;value\n"
        "2024-01-01;01:00;06180;55.6;12.6;mean_wind_speed;3.5\n"
        "2024-01-01;01:00;06180;55.6;12.6;mean_wind_dir;270\n"
        "2024-01-01;02:00;06074;56.2;10.1;mean_wind_speed;6\n"
    )
    points = "﻿code,name,latitude,longitude\n101,Kbh,55.68,12.57\n751,Aarhus,56.15,10.2\n"
    return {
        "prices": [price("DK1", 10, 11), price("DK2", 20, 21)],
        "consumption_zip": f"{folder}/use.zip",
        "sunlight": write("sun.csv", sun),
        "wind": write("wind.csv", wind),
        "points": write("points.csv", points),
    }


def test_study_from_files(spark, inputs):
    series = study.load_series(spark, **inputs)
    out = study.price_study(series, fill="keyed")
    keep = ["area", "municipality_code", "price_eur_mwh", "ConsumptionkWh", "sunshine_minutes", "wind_station_id", "value"]
    assert rows(out["panel"].select(F.date_format("datetime", "HH:mm"), *keep)) == [
        ("01:00", "2", 101, 20.0, 10.0, 30.0, "06180", 3.5),
        ("02:00", "1", 751, 11.0, 7.0, 0.0, "06074", 6.0),
    ]
    r = {(x["col_a"], x["col_b"]): x["r"] for x in out["correlation"].collect()}
    assert r["price_eur_mwh", "value"] == pytest.approx(-1.0)
    assert {x["column"] for x in out["boxes"].collect()} >= {"price_eur_mwh", "value", "ConsumptionkWh"}
    both = study.price_study(series)["panel"]
    assert both.count() == 5 and "date_other" in both.columns


def test_collect_a_year(spark, folder):
    features = [
        {"properties": {"stationId": s, "from": t, "value": v}}
        for s, t, v in [
            ("06154", "2020-01-01T00:00:00Z", 4.0),
            ("06154", "2020-02-01T00:00:00Z", None),
            ("06068", "2020-01-01T00:00:00Z", 2.0),
            ("00000", "2020-01-01T00:00:00Z", 9.0),
        ]
    ]
    path = Path(f"{folder}/p/parameter={fv.MEAN_WIND_SPEED}/offset=0")
    path.mkdir(parents=True)
    (path / "page.json").write_text(json.dumps({"features": features}))
    obs, _ = pages.observations(pages.read_observation_pages(spark, f"{folder}/p"))
    summary = collection.collect_year(obs, fv.MEAN_WIND_SPEED, f"{folder}/out").first()
    assert (summary["rows"], summary["stations"], summary["mean_value"], summary["max_value"]) == (2, 2, 3.0, 4.0)
    assert Path(f"{folder}/out/year=2020").exists()
    with pytest.raises(FileExistsError):
        collection.collect_year(obs, fv.MEAN_WIND_SPEED, f"{folder}/out")
    assert collection.collect_year(obs.limit(0), fv.MEAN_WIND_SPEED, f"{folder}/none") is None


def test_collect_consumption(spark, folder):
    path = Path(f"{folder}/p/offset=0")
    path.mkdir(parents=True)
    record = {"TimeUTC": "2024-03-01T00:00:00", "MunicipalityCode": 101, "ConsumptionkWh": 2.0}
    (path / "page.json").write_text(json.dumps({"records": [record, {**record, "TimeUTC": "2024-04-01T00:00:00"}]}))
    got = collection.collect_consumption(spark, f"{folder}/p", f"{folder}/out").first()
    assert (got["months_processed"], got["months_with_data"], got["total_records"]) == (40, 2, 2)
    assert Path(f"{folder}/out/year=2024/month=4").exists()
