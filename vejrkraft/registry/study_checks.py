"""The price study and the collections, from files written in the form their sources have."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.times import iso_text
from vejrkraft.plans import collection, panel, study
from vejrkraft.registry.io_checks import _land_twice
from vejrkraft.registry.tables import reference_points, table
from vejrkraft.session import checkpoint_dir
from vejrkraft.sources.files import read_parquet

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_MEASURES = ["price_eur_mwh", "ConsumptionkWh", "sunshine_minutes", "value"]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def _csv(df: DataFrame, name: str, sep: str = ",") -> str:
    out = _folder(df.sparkSession, name)
    df.write.option("header", True).option("sep", sep).csv(out)
    return out


def _hours(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    e = table(spark, folder, "events").where(F.col("event_type") == kind)
    return e.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp"))


def _market(time: Column) -> Column:
    return F.date_format(time, fv.MARKET_TIME)


def write_prices(spark: SparkSession, folder: str) -> list[str]:
    """Hourly means of the errors as prices of two areas, a file each, stamped with the interval that ends at the hour."""
    e = _hours(spark, folder, "error").withColumn("digit", F.col("user_id") % 2 + 1)
    mean = e.groupBy("hour", "digit").agg(F.round(F.avg("value"), 6).alias("price_eur_mwh"))
    interval = F.concat(_market(F.col("hour") - F.expr("interval 1 hour")), F.lit(" - "), _market(F.col("hour")))
    rows = mean.select(
        interval.alias("MTU (UTC)"),
        F.concat(F.lit("BZN|DK"), "digit").alias("Area"),
        "price_eur_mwh",
        F.lit(None).cast("string").alias("Intraday Period (UTC)"),
        F.lit(None).cast("string").alias("Intraday Price (EUR/MWh)"),
        "digit",
    )
    return [_csv(rows.where(F.col("digit") == d).drop("digit"), "prices") for d in (1, 2)]


PRICES_SQL = """prices as (
      select date_trunc('hour', ts) as hour, cast(user_id % 2 + 1 as varchar) as area, round(avg(value), 6) as price
      from events where event_type = 'error' group by 1, 2)"""


def write_points(spark: SparkSession, folder: str) -> str:
    p = reference_points(spark, folder)
    named = p.select("code", F.concat(F.lit("M"), "code").alias("name"), (F.col("latitude") + 55).alias("latitude"), (F.col("longitude") + 11).alias("longitude"))
    return _csv(named, "points")


POINTS_SQL = """points as (
      select cast(case when s_suppkey % 2 = 0 then 401 + s_suppkey else 400 - s_suppkey end as integer) as code,
             (s_suppkey * 37 % 200 - 100) / 300 + 55 as la, (s_suppkey * 53 % 199 - 99) / 300 + 11 as lo from supplier),
    places as (
      select vec_id, 55 + cast(embedding[1] as double) as la, 11 + cast(embedding[2] as double) as lo from embeddings),
    near as (
      select vec_id, s.la, s.lo, p.code, case when s.lo < 11 then '1' else '2' end as area from places s, points p
      qualify row_number() over (partition by vec_id order by (s.la - p.la) * (s.la - p.la) + (s.lo - p.lo) * (s.lo - p.lo), p.code) = 1)"""


def write_weather(spark: SparkSession, folder: str, kind: str, value: str) -> str:
    """Sums of a kind of event per station and hour; every embedding is a station. Clicks of every fourth station are directions."""
    e = table(spark, folder, "embeddings")
    place = lambda i, base: (F.get("embedding", F.lit(i)).cast("double") + base)
    stations = e.select(F.col("vec_id").alias("user_id"), place(0, 55).alias("latitude"), place(1, 11).alias("longitude"))
    sums = _hours(spark, folder, kind).groupBy("hour", "user_id").agg(F.round(F.sum("value"), 2).alias(value))
    rows = sums.join(stations, "user_id").select(
        F.date_format("hour", "yyyy-MM-dd").alias("date"),
        F.date_format("hour", "HH:mm").alias("to_time"),
        F.lpad(F.col("user_id").cast("string"), 5, "0").alias("station_id"),
        "latitude",
        "longitude",
        *([] if kind == "view" else [F.when(F.col("user_id") % 4 == 0, "mean_wind_dir").otherwise(fv.MEAN_WIND_SPEED).alias("parameter")]),
        value,
    )
    return _csv(rows, kind, ";")


WEATHER_SQL = f"""{POINTS_SQL},
    sums as (
      select date_trunc('hour', ts) as hour, user_id, event_type, round(sum(value), 2) as v from events group by all),
    sun as (
      select hour, area, code, lpad(cast(user_id as varchar), 5, '0') as sun_station, v as sunshine
      from sums join near on vec_id = user_id where event_type = 'view'),
    wind as (
      select hour, area, code, lpad(cast(user_id as varchar), 5, '0') as wind_station, v as wind
      from sums join near on vec_id = user_id where event_type = 'click' and user_id % 4 <> 0)"""


def write_consumption(spark: SparkSession, folder: str) -> str:
    """Purchases as consumption records; the code is one of the points'."""
    e = _hours(spark, folder, "purchase")
    s = table(spark, folder, "supplier").select("s_suppkey")
    codes = reference_points(spark, folder).select(F.col("ord").alias("s_suppkey"), "code")
    keyed = e.withColumn("s_suppkey", F.col("user_id") % 10).join(s, "s_suppkey").join(codes, "s_suppkey")
    rows = keyed.select(
        F.date_format("hour", fv.ISO_TIME).alias("TimeUTC"),
        F.date_format(F.col("hour") + F.expr("interval 1 hour"), fv.ISO_TIME).alias("TimeDK"),
        F.col("code").alias("MunicipalityCode"),
        F.concat(F.lit("M"), "code").alias("Municipality"),
        F.when(F.col("code") > 400, "north").otherwise("south").alias("RegionName"),
        F.col("value").alias("ConsumptionkWh"),
    )
    return _csv(rows, "consumption")


CONSUMPTION_FILES_SQL = """uses as (
      select date_trunc('hour', ts) as hour, cast(case when k % 2 = 0 then 401 + k else 400 - k end as integer) as code, value
      from (select *, user_id % 10 as k from events where event_type = 'purchase') join supplier on s_suppkey = k),
    usage as (
      select hour, case when code > 400 then '1' else '2' end as area, code, sum(value) as kwh, 'M' || code as place,
        case when code > 400 then 'north' else 'south' end as region from uses group by hour, code)"""


def _series(spark: SparkSession, folder: str) -> list[DataFrame]:
    return study.load_series(
        spark,
        prices=write_prices(spark, folder),
        consumption=write_consumption(spark, folder),
        sunlight=write_weather(spark, folder, "view", "sunshine_minutes"),
        wind=write_weather(spark, folder, "click", "value"),
        points=write_points(spark, folder),
    )


def clean_prices(spark: SparkSession, folder: str) -> DataFrame:
    return _series(spark, folder)[0].select(iso_text("datetime").alias("hour"), "area", F.col("price_eur_mwh").alias("price"))


def clean_consumption(spark: SparkSession, folder: str) -> DataFrame:
    used = _series(spark, folder)[1]
    return used.select(
        iso_text("datetime").alias("hour"), "area", F.col("municipality_code").alias("code"), F.round("ConsumptionkWh", 6).alias("kwh"),
        F.col("Municipality").alias("place"), F.col("RegionName").alias("region"),
    )


def clean_sunlight(spark: SparkSession, folder: str) -> DataFrame:
    sun = _series(spark, folder)[2]
    return sun.select(
        iso_text("datetime").alias("hour"), "area", F.col("municipality_code").alias("code"), F.col("sun_station_id").alias("sun_station"),
        F.col("sunshine_minutes").alias("sunshine"),
    )


def clean_wind(spark: SparkSession, folder: str) -> DataFrame:
    wind = _series(spark, folder)[3]
    return wind.select(
        iso_text("datetime").alias("hour"), "area", F.col("municipality_code").alias("code"), F.col("wind_station_id").alias("wind_station"),
        F.col("value").alias("wind"),
    )


def _panel(fill: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        out = panel.sorted_panel(study.price_study(_series(spark, folder), fill=fill)["panel"])
        return out.select(
            iso_text("datetime").alias("hour"),
            "area",
            F.col("municipality_code").alias("code"),
            F.col("price_eur_mwh").alias("price"),
            F.round("ConsumptionkWh", 6).alias("kwh"),
            F.col("sun_station_id").alias("sun_station"),
            F.col("sunshine_minutes").alias("sunshine"),
            F.col("wind_station_id").alias("wind_station"),
            F.col("value").alias("wind"),
        )

    return query


_ON = """on l.hour is not distinct from r.hour and l.area is not distinct from r.area and l.code is not distinct from r.code"""
_KEYS = "coalesce(l.hour, r.hour) as hour, coalesce(l.area, r.area) as area, coalesce(l.code, r.code) as code"
_ORDER = "hour nulls last, area nulls last, code nulls last, sun_station nulls last, wind_station nulls last"
_COLUMNS = ["hour", "area", "code", "price", "kwh", "sun_station", "sunshine", "wind_station", "wind"]
_INPUTS = f"with {PRICES_SQL}, {WEATHER_SQL}, {CONSUMPTION_FILES_SQL}"

STUDY_GLOBAL_SQL = f"""{_INPUTS},
    p as (select hour, area, cast(null as integer) as code, price from prices),
    j1 as (select {_KEYS}, l.price, r.kwh from p l full join usage r {_ON}),
    j2 as (select {_KEYS}, l.price, l.kwh, r.sun_station, r.sunshine from j1 l full join sun r {_ON}),
    j3 as (select {_KEYS}, l.price, l.kwh, l.sun_station, l.sunshine, r.wind_station, r.wind from j2 l full join wind r {_ON}),
    filled as (
      select {", ".join(f"last_value({c} ignore nulls) over w as {c}" for c in _COLUMNS)}
      from j3 window w as (order by {_ORDER} rows between unbounded preceding and current row))
    select * replace (strftime(hour, {_ISO}) as hour, round(kwh, 6) as kwh, coalesce(sunshine, 0.0) as sunshine)
    from filled where wind is not null"""

_KEYED = f"""{_INPUTS},
    j2 as (select {_KEYS}, l.kwh, r.sun_station, r.sunshine from usage l full join sun r {_ON}),
    j3 as (select {_KEYS}, l.kwh, l.sun_station, l.sunshine, r.wind_station, r.wind from j2 l full join wind r {_ON}),
    joined as (select j3.*, p.price from j3 left join prices p on p.hour = j3.hour and p.area = j3.area),
    filled as (
      select hour, area, code, {", ".join(f"last_value({c} ignore nulls) over w as {c}" for c in ("price", "kwh", "wind"))},
        sun_station, wind_station, coalesce(sunshine, 0.0) as sunshine
      from joined window w as (partition by area order by {_ORDER} rows between unbounded preceding and current row)),
    study as (
      select * replace (strftime(hour, {_ISO}) as hour, round(kwh, 6) as kwh) from filled where wind is not null)"""

STUDY_KEYED_SQL = f"{_KEYED} select {', '.join(_COLUMNS)} from study"


def study_correlation(spark: SparkSession, folder: str) -> DataFrame:
    found = study.price_study(_series(spark, folder), fill="keyed")["correlation"]
    kept = found.where(F.col("col_a").isin(_MEASURES) & F.col("col_b").isin(_MEASURES))
    return kept.withColumn("r", F.round("r", 6) + F.lit(0.0))


def study_boxes(spark: SparkSession, folder: str) -> DataFrame:
    found = study.price_study(_series(spark, folder), fill="keyed")["boxes"].where(F.col("column").isin(_MEASURES))
    return found.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


_NAMED = dict(zip(_MEASURES, ("price", "kwh", "sunshine", "wind")))
STUDY_CORRELATION_SQL = f"{_KEYED} " + " union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, round(corr({x}, {y}), 6) + 0.0 as r from study"
    for a, x in _NAMED.items()
    for b, y in _NAMED.items()
)
STUDY_BOXES_SQL = f"{_KEYED} " + " union all ".join(
    f"""select '{name}' as "column", n, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
      round(min({c}) filter (inside), 4) as whisker_low, round(max({c}) filter (inside), 4) as whisker_high,
      count(*) filter (not inside) as outliers
    from (select {c}, n, q1, median, q3, {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from study,
      (select count({c}) as n, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as median, quantile_cont({c}, 0.75) as q3 from study)
      where {c} is not null) group by n, q1, median, q3"""
    for name, c in _NAMED.items()
)


def collected_year(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks as observations of the listed wind stations, some met twice, collected by year and read back."""
    e = table(spark, folder, "events").where("event_type = 'click'")
    # The fixed list of stations, in one order.
    stations = collection.stations_for(spark, fv.MEAN_WIND_SPEED).withColumn("at", F.row_number().over(Window.orderBy("station_id")) - 1)
    count = stations.count()
    obs = e.withColumn("at", F.col("user_id") % count).join(stations, "at").select(
        F.lit(fv.MEAN_WIND_SPEED).alias("parameter"),
        "station_id",
        F.date_format(F.date_trunc("hour", "ts"), fv.ISO_TIME_UTC).alias("observed_from"),
        F.when(F.col("value") >= 15, F.col("value")).alias("value"),
        F.col("event_id").alias("arrival"),
    )
    out = _folder(spark, "collected")
    collection.collect_year(obs, fv.MEAN_WIND_SPEED, out)
    back = read_parquet(spark, out)
    return back.select("stationId", "stationName", iso_text("timeObserved").alias("time"), F.col(fv.MEAN_WIND_SPEED).alias("value"), "year")


def collected_year_sql() -> str:
    listed = sorted(line.split(" ", 1) for line in fv.WIND_STATIONS.strip().splitlines())
    values = ", ".join(f"({i}, '{k}', '{n}')" for i, (k, n) in enumerate(listed))
    return f"""with s(nth, id, name) as (values {values})
      select id as "stationId", name as "stationName", strftime(hour, {_ISO}) as time, value, year(hour)::integer as year
      from (select id, name, date_trunc('hour', ts) as hour, value, event_id from events join s on user_id % {len(listed)} = nth
            where event_type = 'click' and value >= 15)
      qualify row_number() over (partition by id, hour order by event_id) = 1"""


def collected_consumption(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, moved to the years collected, as consumption pages; the coverage of the calendar after they were written by month."""
    o = table(spark, folder, "orders")
    time = F.col("o_orderdate") + F.expr("interval 28 years")
    record = F.struct(
        F.date_format(time, fv.ISO_TIME).alias("TimeUTC"),
        F.col("o_custkey").cast("int").alias("MunicipalityCode"),
        F.col("o_totalprice").alias("ConsumptionkWh"),
    )
    landed = _land_twice(spark, o, "o_orderkey", [], record, "records", 100_000)
    return collection.collect_consumption(spark, landed, _folder(spark, "months"), lines=True)


COLLECTED_CONSUMPTION_SQL = f"""with m as (select unnest(generate_series(date '{fv.CONSUMPTION_FIRST_MONTH}', date '{fv.CONSUMPTION_LAST_MONTH}', interval 1 month)) as month),
    n as (select date_trunc('month', o_orderdate + interval 28 years) as month, count(*) as n from orders group by 1)
    select count(*) as months_processed, count(n) as months_with_data, coalesce(sum(n), 0)::bigint as total_records,
      coalesce(sum(n), 0) * {fv.ASSUMED_RECORD_BYTES} / 1048576.0::double as estimated_mb
    from m left join n on m.month = n.month"""

CHECKS = {
    "clean_prices": (clean_prices, f"with {PRICES_SQL} select strftime(hour, {_ISO}) as hour, area, price from prices"),
    "clean_consumption": (
        clean_consumption,
        f"with {CONSUMPTION_FILES_SQL} select strftime(hour, {_ISO}) as hour, area, code, round(kwh, 6) as kwh, place, region from usage",
    ),
    "clean_sunlight": (
        clean_sunlight,
        f"with {WEATHER_SQL} select strftime(hour, {_ISO}) as hour, area, code, sun_station, sunshine from sun",
    ),
    "clean_wind": (clean_wind, f"with {WEATHER_SQL} select strftime(hour, {_ISO}) as hour, area, code, wind_station, wind from wind"),
    "study_global": (_panel("global"), STUDY_GLOBAL_SQL),
    "study_keyed": (_panel("keyed"), STUDY_KEYED_SQL),
    "study_correlation": (study_correlation, STUDY_CORRELATION_SQL),
    "study_boxes": (study_boxes, STUDY_BOXES_SQL),
    "collected_year": (collected_year, collected_year_sql()),
    "collected_consumption": (collected_consumption, COLLECTED_CONSUMPTION_SQL),
}
