"""The driver's tables read as observations, station details, stations and series.

Each adapter has a SQL twin, so that the Spark query and its check start from the same rows. Gaps
and dirty text are made here from the tables' own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.areas import price_area
from vejrkraft.operators.nearest import nearest_point
from vejrkraft.session import prepare

ISO = "%Y-%m-%dT%H:%M:%SZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def case(col: str, table: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col(col) == k, F.lit(v)) for k, v in table.items()])


def case_sql(col: str, table: dict[str, str]) -> str:
    return f"case {col} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


# Event types as the parameters of the three station profiles.
WIND = dict(zip(("click", "purchase", "view", "signup", "error"), fv.WIND_PARAMETERS))
WEATHER = {
    "view": fv.SUNSHINE,
    "click": fv.RADIATION,
    "purchase": fv.PRECIPITATION,
    "signup": fv.WIND_PARAMETERS[0],
    "error": fv.WIND_PARAMETERS[3],
}


def offset_text(time: Column, odd: Column) -> Column:
    """A UTC time as ISO text, where ``odd`` with the offset of Danish winter time."""
    shifted = F.date_format(time + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss'+01:00'")
    return F.when(odd, shifted).otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def observations(spark: SparkSession, folder: str, parameters: dict[str, str]) -> DataFrame:
    """Events as observations: small values are missing, and so are the places of large ones."""
    e = table(spark, folder, "events")
    placed = F.col("value") < 60
    return e.select(
        F.col("user_id").cast("string").alias("station_id"),
        case("event_type", parameters).alias("parameter"),
        F.col("ts").alias("observed_from"),
        F.when(F.col("value") >= 15, F.col("value")).alias("value"),
        F.when(placed, 55 + F.col("value") / 100).alias("latitude"),
        F.when(placed, 9 + F.col("value") / 50).alias("longitude"),
        F.col("event_id").alias("arrival"),
        F.floor(F.col("event_id") / 1000).alias("page"),
    )


def observations_sql(parameters: dict[str, str]) -> str:
    return f"""obs as (
      select cast(user_id as varchar) as station_id,
             {case_sql("event_type", parameters)} as parameter,
             ts as observed_from,
             case when value >= 15 then value end as value,
             case when value < 60 then 55 + value / 100 end as latitude,
             case when value < 60 then 9 + value / 50 end as longitude,
             event_id as arrival,
             event_id // 1000 as page
      from events)"""


def details(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as station details: several rows per station, the last one counts."""
    o = table(spark, folder, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("station_id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("name"),
        case("o_orderstatus", {"P": "DNK", "F": "GRL"}).alias("country"),
        F.when(F.col("o_totalprice") > 100_000, "Active")
        .when(F.col("o_totalprice") > 50_000, "Inactive")
        .alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("valid_from"),
        F.when(F.col("o_totalprice") < 200_000, F.date_format("o_orderdate", "yyyy")).alias("valid_to"),
        F.col("o_orderkey").alias("arrival"),
    )


DETAILS_SQL = """details as (
      select cast(o_custkey as varchar) as station_id,
             nullif(o_orderpriority, '5-LOW') as name,
             case o_orderstatus when 'P' then 'DNK' when 'F' then 'GRL' end as country,
             case when o_totalprice > 100000 then 'Active'
                  when o_totalprice > 50000 then 'Inactive' end as status,
             strftime(o_orderdate, '%Y-%m-%d') as valid_from,
             case when o_totalprice < 200000 then strftime(o_orderdate, '%Y') end as valid_to,
             o_orderkey as arrival
      from orders),
    latest as (
      select * from details
      qualify row_number() over (partition by station_id order by arrival desc) = 1)"""


def reference_points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per supplier, on a lattice; codes lie on both sides of the area rule's limit."""
    s = table(spark, folder, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.when(k % 2 == 0, 401 + k).otherwise(400 - k).cast("int").alias("code"),
        ((k * 37 % 200 - 100) / 300).alias("latitude"),
        ((k * 53 % 199 - 99) / 300).alias("longitude"),
        k.alias("ord"),
    )


def located_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a station with its nearest reference point and price area."""
    e = table(spark, folder, "embeddings")
    stations = e.select(
        "vec_id",
        F.get("embedding", F.lit(0)).cast("double").alias("latitude"),
        F.get("embedding", F.lit(1)).cast("double").alias("longitude"),
    )
    near = nearest_point(stations, reference_points(spark, folder))
    return near.withColumn("area", price_area("municipality_code", "municipality"))


STATIONS_SQL = """points as (
      select cast(case when s_suppkey % 2 = 0 then 401 + s_suppkey else 400 - s_suppkey end as integer) as code, s_suppkey as ord,
             (s_suppkey * 37 % 200 - 100) / 300 as latitude, (s_suppkey * 53 % 199 - 99) / 300 as longitude
      from supplier),
    stations as (
      select vec_id, cast(embedding[1] as double) as latitude,
             cast(embedding[2] as double) as longitude
      from embeddings),
    located as (
      select s.vec_id, s.latitude, s.longitude, p.code as municipality_code,
             case when p.code > 400 then '1' else '2' end as area
      from stations s, points p
      qualify row_number() over (
        partition by s.vec_id
        order by (s.latitude - p.latitude) * (s.latitude - p.latitude)
               + (s.longitude - p.longitude) * (s.longitude - p.longitude), p.ord) = 1)"""
