"""Station profiles, enrichment and the reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.times import iso_text, month_window
from vejrkraft.operators import cleaning, profiles, summaries
from vejrkraft.operators.grids import month_calendar, month_coverage, month_grid
from vejrkraft.operators.locations import centroid, location_counts, location_rollup, place_names
from vejrkraft.operators.ordering import row_index
from vejrkraft.plans.reports import profile_summary, station_check
from vejrkraft.registry.tables import (
    DETAILS_SQL,
    WEATHER,
    WIND,
    details,
    observations,
    observations_sql,
    offset_text,
    table,
)
from vejrkraft.session import staged

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_DETAIL_COLUMNS = ", ".join(profiles.DETAIL_COLUMNS)


def _text_times(df: DataFrame) -> DataFrame:
    times = [c for c, t in df.dtypes if t.startswith("timestamp")]
    return df.withColumns({c: iso_text(c) for c in times})


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _mixed_offsets(obs: DataFrame) -> DataFrame:
    """Times as the service sends them: text, with one of two offsets."""
    return obs.withColumn("observed_from", offset_text(F.col("observed_from"), F.col("arrival") % 2 == 1))


# Profiles --------------------------------------------------------------------------------------


def wind_profile(spark: SparkSession, folder: str) -> DataFrame:
    out = profiles.wind_profile(_mixed_offsets(observations(spark, folder, WIND)), details(spark, folder))
    return _round(_text_times(out), "latitude", "longitude")


def _flag_counts_sql() -> str:
    return ",\n".join(
        f"count(*) filter (parameter = '{p}') as {p}_observations,"
        f" count(*) filter (parameter = '{p}') > 0 as measures_{p}"
        for p in fv.WIND_PARAMETERS
    )


_RANK = " ".join(f"when '{p}' then {i}" for i, p in enumerate(fv.WIND_PARAMETERS))
_ENRICHED = """case when d.station_id is not null then coalesce(d.name, 'Unknown') end as name,
      case when d.station_id is not null then coalesce(d.country, 'Unknown') end as country,
      case when d.station_id is not null then coalesce(d.status, 'Unknown') end as status,
      d.valid_from, d.valid_to"""

WIND_PROFILE_SQL = f"""with {observations_sql(WIND)},
    {DETAILS_SQL},
    o as (select *, case parameter {_RANK} end as rank from obs),
    p as (
      select station_id,
        round(first(latitude order by rank, arrival) filter (latitude is not null), 6) as latitude,
        round(first(longitude order by rank, arrival) filter (latitude is not null), 6) as longitude,
        count(*) as total_wind_observations,
        string_agg(distinct parameter, ', ' order by parameter) as wind_parameters_measured,
        cast(count(distinct parameter) as integer) as parameter_count,
        {_flag_counts_sql()},
        strftime(min(observed_from), {_ISO}) as first_wind_date,
        strftime(max(observed_from), {_ISO}) as last_wind_date,
        max(value) filter (contains(parameter, 'speed')) as max_wind_speed_recorded_ms,
        min(value) filter (contains(parameter, 'speed')) as min_wind_speed_recorded_ms
      from o group by station_id)
    select p.*, {_ENRICHED} from p left join latest d using (station_id)"""


def sunlight_profile(spark: SparkSession, folder: str) -> DataFrame:
    out = profiles.sunlight_profile(_mixed_offsets(observations(spark, folder, WEATHER)), details(spark, folder))
    return _round(_text_times(out), "latitude", "longitude")


SUNLIGHT_PROFILE_SQL = f"""with {observations_sql(WEATHER)},
    {DETAILS_SQL},
    o as (select *, parameter = 'bright_sunshine' as sun, parameter = 'mean_radiation' as rad
          from obs where parameter in ('bright_sunshine', 'mean_radiation')),
    last_sun as (select * from o where sun
      qualify row_number() over (partition by station_id order by arrival desc) = 1),
    first_rad as (select * from o where rad
      qualify row_number() over (partition by station_id order by arrival) = 1),
    p as (
      select station_id,
        count(*) filter (sun) as sunshine_observations,
        count(*) filter (rad) as radiation_observations,
        count(*) filter (sun) > 0 as measures_sunshine,
        count(*) filter (rad) > 0 as measures_radiation,
        strftime(min(observed_from) filter (sun), {_ISO}) as first_sunshine_date,
        strftime(max(observed_from) filter (sun), {_ISO}) as last_sunshine_date,
        strftime(min(observed_from) filter (rad), {_ISO}) as first_radiation_date,
        strftime(max(observed_from) filter (rad), {_ISO}) as last_radiation_date,
        string_agg(distinct parameter, ', ' order by parameter) as measurement_types
      from o group by station_id)
    select p.*,
      round(case when measures_sunshine then s.latitude else r.latitude end, 6) as latitude,
      round(case when measures_sunshine then s.longitude else r.longitude end, 6) as longitude,
      case when d.station_id is not null then coalesce(d.name, 'Unknown') end as name,
      coalesce(d.country, 'Unknown') as country, coalesce(d.status, 'Unknown') as status,
      d.valid_from, d.valid_to
    from p left join latest d using (station_id)
    left join last_sun s on s.station_id = p.station_id
    left join first_rad r on r.station_id = p.station_id"""


def precipitation_profile(spark: SparkSession, folder: str) -> DataFrame:
    obs = _mixed_offsets(observations(spark, folder, WEATHER))
    out = profiles.precipitation_profile(obs, details(spark, folder), digits=6)
    return _round(_text_times(out), "latitude", "longitude")


PRECIPITATION_PROFILE_SQL = f"""with {observations_sql(WEATHER)},
    {DETAILS_SQL},
    p as (
      select station_id,
        round(arg_min(latitude, arrival) filter (latitude is not null), 6) as latitude,
        round(arg_min(longitude, arrival) filter (latitude is not null), 6) as longitude,
        count(*) as precipitation_observations,
        strftime(min(observed_from), {_ISO}) as first_precipitation_date,
        strftime(max(observed_from), {_ISO}) as last_precipitation_date,
        min(value) as min_precipitation_mm, max(value) as max_precipitation_mm,
        case when sum(value) > 0 then round(sum(value) / count(*), 6) end as avg_precipitation_mm,
        case when sum(value) <> 0 then round(sum(value), 6) end as total_precipitation_sample_mm
      from obs where parameter = 'acc_precip' group by station_id)
    select p.*, {_ENRICHED} from p left join latest d using (station_id)"""


def station_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The wind profile without details, straight over the observations."""
    out = profiles.wind_profile(observations(spark, folder, WIND))
    keep = [
        "station_id", "wind_parameters_measured", "parameter_count", "total_wind_observations",
        "first_wind_date", "last_wind_date", "max_wind_speed_recorded_ms", "min_wind_speed_recorded_ms",
    ]
    return _text_times(out.select(*keep))


STATION_PROFILE_SQL = f"""with {observations_sql(WIND)}
    select station_id, string_agg(distinct parameter, ', ' order by parameter) as wind_parameters_measured,
      cast(count(distinct parameter) as integer) as parameter_count,
      count(*) as total_wind_observations,
      strftime(min(observed_from), {_ISO}) as first_wind_date,
      strftime(max(observed_from), {_ISO}) as last_wind_date,
      max(value) filter (contains(parameter, 'speed')) as max_wind_speed_recorded_ms,
      min(value) filter (contains(parameter, 'speed')) as min_wind_speed_recorded_ms
    from obs group by station_id"""


def _daily_stations(spark: SparkSession, folder: str, parameters: dict[str, str]) -> DataFrame:
    """Observations with (user, day) as the station, so that stations miss some parameters."""
    obs = observations(spark, folder, parameters)
    day = F.date_format("observed_from", "-dd")
    return obs.withColumn("station_id", F.concat("station_id", day))


def _daily_sql(parameters: dict[str, str]) -> str:
    return f"""{observations_sql(parameters)},
    daily as (select * replace (station_id || strftime(observed_from, '-%d') as station_id) from obs)"""


def flag_overlap(spark: SparkSession, folder: str) -> DataFrame:
    profile = profiles.sunlight_profile(_daily_stations(spark, folder, WEATHER))
    return summaries.flag_overlap(profile, "measures_sunshine", "measures_radiation")


FLAG_OVERLAP_SQL = f"""with {_daily_sql(WEATHER)},
    p as (select station_id, bool_or(parameter = 'bright_sunshine') as s,
                 bool_or(parameter = 'mean_radiation') as r
          from daily where parameter in ('bright_sunshine', 'mean_radiation') group by station_id)
    select count(*) filter (s and not r) as only_first, count(*) filter (r and not s) as only_second,
           count(*) filter (s and r) as both, count(*) as stations from p"""


def guarded_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts per station and type; shifted down, so that sums fall on both sides of zero."""
    obs = observations(spark, folder, WIND).withColumn("value", F.col("value") - 55)
    amounts = profiles.precipitation_amounts(F.col("value"))
    out = obs.groupBy("station_id", "parameter").agg(*[a.alias(n) for n, a in amounts.items()])
    return _round(out, *amounts)


GUARDED_MEAN_SQL = f"""with {observations_sql(WIND)},
    o as (select * replace (value - 55 as value) from obs)
    select station_id, parameter, round(min(value), 6) as min_precipitation_mm,
      round(max(value), 6) as max_precipitation_mm,
      case when sum(value) > 0 then round(sum(value) / count(*), 6) end as avg_precipitation_mm,
      case when sum(value) <> 0 then round(sum(value), 6) end as total_precipitation_sample_mm
    from o group by station_id, parameter"""


def first_last_by_order(spark: SparkSession, folder: str) -> DataFrame:
    obs = observations(spark, folder, WIND)
    at, lat = F.col("arrival"), F.col("latitude")
    return obs.groupBy("station_id", "parameter").agg(
        F.round(profiles.first_by(lat, at, lat.isNotNull()), 6).alias("first_known"),
        F.round(profiles.last_by(lat, at, lat.isNotNull()), 6).alias("last_known"),
        F.round(profiles.last_by(lat, at), 6).alias("last_any"),
    )


FIRST_LAST_SQL = f"""with {observations_sql(WIND)}
    select station_id, parameter,
      round(arg_min(latitude, arrival) filter (latitude is not null), 6) as first_known,
      round(arg_max(latitude, arrival) filter (latitude is not null), 6) as last_known,
      round(arg_max_null(latitude, arrival), 6) as last_any
    from obs group by station_id, parameter"""


def enrich_latest(spark: SparkSession, folder: str) -> DataFrame:
    stations = observations(spark, folder, WIND).groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    return profiles.enrich(stations, details(spark, folder), unmatched=("country", "status"))


ENRICH_SQL = f"""with {observations_sql(WIND)},
    {DETAILS_SQL},
    s as (select station_id, count(*) as n from obs group by station_id)
    select s.*, case when d.station_id is not null then coalesce(d.name, 'Unknown') end as name,
      coalesce(d.country, 'Unknown') as country, coalesce(d.status, 'Unknown') as status,
      d.valid_from, d.valid_to
    from s left join latest d using (station_id)"""


def semi_details(spark: SparkSession, folder: str) -> DataFrame:
    stations = observations(spark, folder, WIND).select("station_id").distinct()
    return profiles.known_details(details(spark, folder), stations)


SEMI_SQL = f"""with {observations_sql(WIND)},
    {DETAILS_SQL}
    select * from details d where exists (select 1 from obs o where o.station_id = d.station_id)"""


def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    names = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return events.join(names, F.col("user_id") == F.col("c_custkey")).select(
        "event_id", F.col("c_name").alias("station_name"), F.col("n_name").alias("country")
    )


# Reports ---------------------------------------------------------------------------------------


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    d = details(spark, folder)
    by_status = summaries.value_counts(d, "status").withColumn("column", F.lit("status"))
    by_country = summaries.value_counts(d, "country").withColumn("column", F.lit("country"))
    return row_index(by_status.unionByName(by_country), [F.col("column"), -F.col("n"), "value"], by=["column"])


VALUE_COUNTS_SQL = f"""with {DETAILS_SQL},
    c as (select status as value, count(*) as n, 'status' as "column" from details
          where status is not null group by status
          union all
          select country, count(*), 'country' from details where country is not null group by country)
    select *, row_number() over (partition by "column" order by n desc, value) as position from c"""


def country_activity(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.activity(details(spark, folder))


def country_list(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.country_list(details(spark, folder))


def param_coverage(spark: SparkSession, folder: str) -> DataFrame:
    profile = profiles.wind_profile(_daily_stations(spark, folder, WIND))
    flags = {p: f"measures_{p}" for p in fv.WIND_PARAMETERS}
    return summaries.parameter_coverage(profile, flags)


PARAM_COVERAGE_SQL = f"""with {_daily_sql(WIND)},
    a as (select count(*) as n from (
      select station_id from daily group by station_id having count(distinct parameter) = 5))
    select parameter, count(distinct station_id) as stations, (select n from a) as stations_with_all
    from daily group by parameter"""


def time_range(spark: SparkSession, folder: str) -> DataFrame:
    profile = profiles.wind_profile(observations(spark, folder, WIND))
    return summaries.time_range(profile, "first_wind_date", "last_wind_date")


def extreme_rows(spark: SparkSession, folder: str) -> DataFrame:
    profile = profiles.wind_profile(_mixed_offsets(observations(spark, folder, WIND)), details(spark, folder))
    high, low = "max_wind_speed_recorded_ms", "min_wind_speed_recorded_ms"
    return summaries.extreme_rows(profile, high, low, ["station_id", "name"], "station_id")


EXTREME_SQL = f"""with {observations_sql(WIND)},
    {DETAILS_SQL},
    p as (select station_id, max(value) as hi, min(value) as lo from obs
          where contains(parameter, 'speed') group by station_id),
    n as (select p.*, case when d.station_id is not null then coalesce(d.name, 'Unknown') end as name
          from p left join latest d using (station_id)),
    h as (select 'highest' as extreme, hi as value, station_id, name from n
          where hi is not null order by hi desc, station_id limit 1),
    l as (select 'lowest' as extreme, lo as value, station_id, name from n
          where lo is not null order by lo, station_id limit 1)
    select * from h union all select * from l"""


def topk_station(spark: SparkSession, folder: str) -> DataFrame:
    profile = profiles.wind_profile(observations(spark, folder, WIND))
    top = summaries.top_rows(profile, "total_wind_observations", ["station_id"], 5)
    return top.select("station_id", "parameter_count", "total_wind_observations")


TOPK_SQL = f"""with {observations_sql(WIND)}
    select station_id, cast(count(distinct parameter) as integer) as parameter_count,
           count(*) as total_wind_observations
    from obs group by station_id order by count(*) desc, station_id limit 5"""


def sorted_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Positions in the three report orders."""
    profile = profiles.wind_profile(_daily_stations(spark, folder, WIND))
    station = F.split("station_id", "-")[0]
    latest = profiles.latest_details(details(spark, folder))
    joined = profile.select("station_id", "parameter_count", station.alias("user")).join(
        latest.select(F.col("station_id").alias("user"), "country"), "user", "left"
    )
    out = row_index(joined, ["station_id"], out="by_station")
    out = row_index(out, ["country", "station_id"], out="by_country")
    by_coverage = ["country", -F.col("parameter_count"), "station_id"]
    out = row_index(out, by_coverage, out="by_coverage")
    return out.select("station_id", "by_station", "by_country", "by_coverage")


SORTED_SQL = f"""with {_daily_sql(WIND)},
    {DETAILS_SQL},
    p as (select d.station_id, count(distinct d.parameter) as parameter_count, any_value(l.country) as country
          from daily d left join latest l on l.station_id = split_part(d.station_id, '-', 1)
          group by d.station_id)
    select station_id, row_number() over (order by station_id) as by_station,
      row_number() over (order by country nulls last, station_id) as by_country,
      row_number() over (order by country nulls last, parameter_count desc, station_id) as by_coverage
    from p"""


def distinct_sets(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.distinct_stations(_daily_stations(spark, folder, WIND))


DISTINCT_SQL = f"""with {_daily_sql(WIND)}
    select parameter, count(distinct station_id) as stations from daily group by parameter
    union all select null, count(distinct station_id) from daily"""


def distinct_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders per priority from sketches stored by month, against the exact count: within four standard errors."""
    o = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("parameter"),
        F.date_format("o_orderdate", "yyyy-MM").alias("page"),
        F.col("o_orderkey").cast("string").alias("station_id"),
    )
    stored = staged(summaries.station_sketches(o))
    told = summaries.sketched_stations(stored).withColumnRenamed("stations", "estimate")
    exact = summaries.distinct_stations(o)
    same = F.col("parameter").eqNullSafe(F.col("p"))
    both = exact.join(told.withColumnRenamed("parameter", "p"), same)
    off = F.abs(F.col("estimate") - F.col("stations"))
    allowed = F.ceil(F.col("stations") * 4 * summaries.sketch_error())
    return both.select("parameter", "stations", (off <= allowed).alias("near"))


DISTINCT_SKETCHED_SQL = """select o_orderpriority as parameter, count(distinct o_orderkey) as stations, true as near from orders group by 1
    union all select null, count(distinct o_orderkey), true from orders"""


def station_union(spark: SparkSession, folder: str) -> DataFrame:
    obs = _daily_stations(spark, folder, WIND)
    of = lambda p: obs.where(F.col("parameter") == p)
    return summaries.station_union([of("mean_wind_speed"), of("mean_wind_dir")])


STATION_UNION_SQL = f"""with {_daily_sql(WIND)}
    select station_id from daily where parameter = 'mean_wind_speed'
    union select station_id from daily where parameter = 'mean_wind_dir'"""


def paged_accounting(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.page_accounting(observations(spark, folder, WIND))


PAGED_SQL = f"""with {observations_sql(WIND)},
    n as (select parameter, page, count(*) as rows, count(distinct station_id) as stations
          from obs group by parameter, page),
    f as (select parameter, page, count(*) as fresh from (
            select parameter, station_id, min(page) as page from obs group by parameter, station_id)
          group by parameter, page)
    select n.*, coalesce(fresh, 0) as new_stations,
      cast(sum(coalesce(fresh, 0)) over (partition by n.parameter order by n.page) as bigint) as stations_so_far
    from n left join f using (parameter, page)"""


def truncated_pages(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.truncated_pages(observations(spark, folder, WIND), limit=200)


def reconcile_count(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.reconcile(observations(spark, folder, WIND))


def recent_distinct(spark: SparkSession, folder: str) -> DataFrame:
    obs = observations(spark, folder, WIND)
    reference = F.lit("2024-01-30").cast("date")
    return summaries.recent_stations(obs, "observed_from", reference, days=7)


RECENT_SQL = f"""with {observations_sql(WIND)}
    select count(distinct station_id) as stations, count(*) as observations from obs
    where observed_from >= date '2024-01-30' - 7 and observed_from <= date '2024-01-30'"""


def recent_sample(spark: SparkSession, folder: str) -> DataFrame:
    reference = F.lit("2024-01-30").cast("date")
    return summaries.recent_sample(observations(spark, folder, WIND), "observed_from", reference, days=7)


def place_names_rows(spark: SparkSession, folder: str) -> DataFrame:
    return place_names(_placed(spark, folder)).withColumnsRenamed({"lat_rounded": "lat", "lng_rounded": "lng"})


def observation_summary(spark: SparkSession, folder: str) -> DataFrame:
    obs = cleaning.clean_observations(observations(spark, folder, WIND))
    return _round(_text_times(summaries.observation_summary(obs, "observed_from", "value")), "mean_value")


SUMMARY_SQL = f"""with {observations_sql(WIND)}
    select count(*) as rows, strftime(min(observed_from), {_ISO}) as first_time,
      strftime(max(observed_from), {_ISO}) as last_time, count(distinct station_id) as stations,
      round(avg(value), 6) as mean_value, max(value) as max_value
    from obs where value is not null"""


def station_coverage(spark: SparkSession, folder: str) -> DataFrame:
    stations = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("station_id"))
    return summaries.station_coverage(stations, observations(spark, folder, WIND))


COVERAGE_SQL = f"""with {observations_sql(WIND)}
    select count(*) filter (cast(c_custkey as varchar) in (select station_id from obs)) as stations_with_data,
           count(*) as stations from customer"""


def clean_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Observations with a value, the first of each (station, parameter, hour), with their place in the order.

    The rows of an hour differ in value, and their times are text with one of two offsets.
    """
    obs = observations(spark, folder, WIND)
    timed = obs.withColumn("hour", F.date_trunc("hour", "observed_from")).withColumn(
        "text", offset_text(F.col("hour"), F.col("arrival") % 2 == 1)
    )
    twice = cleaning.union_all([timed, timed])
    instant = F.col("text").cast("timestamp")
    kept = cleaning.clean_observations(twice, key=["station_id", "parameter", instant], order=["arrival"])
    out = row_index(kept, ["station_id", "observed_from", "parameter"])
    return out.select("arrival", "station_id", "value", "position")


CLEAN_SQL = f"""with {observations_sql(WIND)}
    select arrival, station_id, value,
      row_number() over (order by station_id, observed_from, parameter) as position
    from (select * from obs where value is not null
      qualify row_number() over (partition by station_id, parameter, date_trunc('hour', observed_from) order by arrival) = 1)"""


def null_rows_removed(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.null_rows_removed(observations(spark, folder, WIND), ["value", "latitude"], ["parameter"])


NULL_ROWS_SQL = f"""with {observations_sql(WIND)}
    select parameter, count(*) as rows_before,
      count(*) filter (value is not null and latitude is not null) as rows_kept,
      count(*) filter (value is null or latitude is null) as rows_removed
    from obs group by parameter"""


def month_coverage_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    calendar = month_calendar(spark, "1994-06-01", "2003-12-01")
    return _round(month_coverage(orders, F.col("o_orderdate"), calendar), "estimated_mb")


MONTH_COVERAGE_SQL = """with c as (
      select unnest(generate_series(timestamp '1994-06-01', timestamp '2003-12-01', interval 1 month)) as m),
    n as (select date_trunc('month', o_orderdate) as m, count(*) as n from orders group by 1)
    select count(*) as months_processed, count(n) as months_with_data,
      cast(coalesce(sum(n), 0) as bigint) as total_records,
      round(coalesce(sum(n), 0) * 200 / 1048576.0, 6)::double as estimated_mb
    from c left join n using (m)"""


def month_grid_plan(spark: SparkSession, folder: str) -> DataFrame:
    stations = table(spark, folder, "supplier").select("s_suppkey")
    return month_grid(stations, "2020-01-01", "2020-12-01")


MONTH_GRID_SQL = f"""with m as (
      select unnest(generate_series(timestamp '2020-01-01', timestamp '2020-12-01', interval 1 month)) as m)
    select s_suppkey, cast(month(m) as integer) as month, cast(year(m) as integer) as year,
      strftime(m, {_ISO}) as window_start, strftime(m + interval 1 month, {_ISO}) as window_end
    from supplier, m"""


def month_window_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of January 1997 by Danish wall-clock time."""
    orders = table(spark, folder, "orders")
    rows = month_window(orders, "o_orderdate", "1997-01-01", zone=fv.DANISH_ZONE)
    return rows.select("o_orderkey", iso_text("o_orderdate").alias("ts"))


MONTH_WINDOW_SQL = f"""select o_orderkey, strftime(o_orderdate, {_ISO}) as ts from orders
    where o_orderdate >= timestamp '1996-12-31 23:00:00' and o_orderdate < timestamp '1997-01-31 23:00:00'"""


def profile_report(spark: SparkSession, folder: str) -> DataFrame:
    profile = staged(profiles.wind_profile(_mixed_offsets(observations(spark, folder, WIND)), details(spark, folder)))
    return profile_summary(
        profile,
        "total_wind_observations",
        "first_wind_date",
        "last_wind_date",
        {p: f"measures_{p}" for p in fv.WIND_PARAMETERS},
        "max_wind_speed_recorded_ms",
        "min_wind_speed_recorded_ms",
    )


PROFILE_REPORT_SQL = f"""with {observations_sql(WIND)},
    {DETAILS_SQL},
    p as (select station_id, count(*) as n, count(distinct parameter) as k,
                 min(observed_from) as a, max(observed_from) as b,
                 max(value) filter (contains(parameter, 'speed')) as hi,
                 min(value) filter (contains(parameter, 'speed')) as lo from obs group by station_id),
    e as (select p.*, case when d.station_id is not null then coalesce(d.name, 'Unknown') end as name,
                 case when d.station_id is not null then coalesce(d.country, 'Unknown') end as country,
                 case when d.station_id is not null then coalesce(d.status, 'Unknown') end as status
          from p left join latest d using (station_id)),
    top as (select station_id, n from e order by n desc, station_id limit 5),
    hi as (select hi as v, coalesce(name, station_id) as place from e where hi is not null order by hi desc, station_id limit 1),
    lo as (select lo as v, coalesce(name, station_id) as place from e where lo is not null order by lo, station_id limit 1)
    select 'total' as section, 'stations' as item, format('{{:,}}', count(*)) as value from e
    union all select 'total', 'observations', format('{{:,}}', sum(n)::bigint) from e
    union all select 'status', status, format('{{:,}}', count(*)) from e where status is not null group by status
    union all select 'country', country, format('{{:,}}', count(*)) from e where country is not null group by country
    union all select 'coverage', parameter, format('{{:,}}', count(distinct station_id)) from obs group by parameter
    union all select 'coverage', 'all parameters', format('{{:,}}', count(*) filter (k = 5)) from e
    union all select 'range', 'dates', strftime(min(a), '%Y-%m-%d') || ' to ' || strftime(max(b), '%Y-%m-%d') from e
    union all select 'top', station_id, format('{{:,}}', n) from top
    union all select 'extreme', 'highest', printf('%.1f', floor(v * 10 + 0.5) / 10) || ' at ' || place from hi
    union all select 'extreme', 'lowest', printf('%.1f', floor(v * 10 + 0.5) / 10) || ' at ' || place from lo"""


def check_report(spark: SparkSession, folder: str) -> DataFrame:
    obs = observations(spark, folder, WEATHER)
    return station_check(obs, details(spark, folder), "observed_from", F.lit("2024-01-30").cast("date"))


CHECK_REPORT_SQL = f"""with {observations_sql(WEATHER)},
    {DETAILS_SQL},
    r as (select count(distinct station_id) as s, count(*) as n from obs
          where observed_from >= date '2024-01-30' - 30 and observed_from <= date '2024-01-30'),
    u as (select count(distinct station_id) as n from obs)
    select 'stations' as section, parameter as item, count(distinct station_id)::varchar as value
    from obs group by parameter
    union all select 'stations', 'together', n::varchar from u
    union all select distinct 'country', coalesce(country, 'Unknown'), 'present' from details
    union all select 'details', 'stations', count(*)::varchar from details
    union all select 'details', 'active', (count(*) filter (status = 'Active'))::varchar from details
    union all select 'recent', 'stations', s::varchar from r
    union all select 'recent', 'observations', n::varchar from r
    union all select 'verdict', n::varchar, case when n > 35 then 'more' when n = 35 then 'equal' else 'fewer' end from u"""


# Places ----------------------------------------------------------------------------------------


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as wind stations and customers as sunlight and precipitation ones, by nation."""

    def rows(name: str, p: str, key: str, kind):
        t = table(spark, folder, name)
        place = F.floor(F.col(f"{p}_acctbal") / 500)
        return t.select(
            (55 + F.col(f"{p}_nationkey") / 7).alias("latitude"),
            (9 + place / 3).alias("longitude"),
            F.col(f"{p}_name").alias("name"),
            kind.alias("station_type"),
            F.when(F.col(f"{p}_acctbal") > 0, "Active").alias("status"),
            F.col(key).alias("number"),
        )

    segment = F.when(F.col("c_mktsegment") < "FURNITURE", "precipitation").otherwise("sunlight")
    wind = rows("supplier", "s", "s_suppkey", F.lit("wind"))
    other = rows("customer", "c", "c_custkey", segment)
    both = wind.withColumn("src", F.lit(0)).unionByName(other.withColumn("src", F.lit(1)))
    return both.withColumn("ord", F.col("src").cast("long") * 1_000_000_000_000 + F.col("number"))


_PLACED_SQL = """placed as (
      select 55 + s_nationkey / 7 as latitude, 9 + floor(s_acctbal / 500) / 3 as longitude,
             s_name as name, 'wind' as station_type,
             case when s_acctbal > 0 then 'Active' end as status, s_suppkey as ord from supplier
      union all
      select 55 + c_nationkey / 7, 9 + floor(c_acctbal / 500) / 3, c_name,
             case when c_mktsegment < 'FURNITURE' then 'precipitation' else 'sunlight' end,
             case when c_acctbal > 0 then 'Active' end, 1000000000000 + c_custkey from customer),
    keyed as (select *, round(latitude, 6) as lat, round(longitude, 6) as lng from placed),
    firsts as (
      select * from keyed
      qualify row_number() over (partition by lat, lng, station_type order by ord) = 1),
    places as (
      select lat, lng, count(distinct name) as distinct_names, count(*) as stations,
             arg_min(name, ord) as name from keyed group by lat, lng),
    types as (
      select lat, lng, string_agg(station_type, ', ' order by ord) as types, count(*) as n,
             string_agg(coalesce(status, '-'), ', ' order by ord) as statuses
      from firsts group by lat, lng),
    rollup as (
      select lat, lng, name, distinct_names, stations, types, statuses,
             case when n = 1 then types else 'multi' end as place_class,
             case when n > 1 then 'purple' when types = 'wind' then 'red'
                  when types = 'precipitation' then 'blue' else 'orange' end as colour,
             case when n > 1 then 'star' when types = 'wind' then 'leaf'
                  when types = 'precipitation' then 'tint' else 'sun' end as icon,
             name || ' (' || types || ')' as label
      from places join types using (lat, lng))"""


def location_rollup_rows(spark: SparkSession, folder: str) -> DataFrame:
    out = location_rollup(_placed(spark, folder))
    statuses = F.transform("statuses", lambda s: F.coalesce(s, F.lit("-")))
    return out.select(
        F.col("lat_rounded").alias("lat"),
        F.col("lng_rounded").alias("lng"),
        "name",
        "distinct_names",
        "stations",
        F.array_join("types", ", ").alias("types"),
        F.array_join(statuses, ", ").alias("statuses"),
        "place_class",
        "colour",
        "icon",
        "label",
    )


def location_totals(spark: SparkSession, folder: str) -> DataFrame:
    return location_counts(location_rollup(_placed(spark, folder)))


def centroid_row(spark: SparkSession, folder: str) -> DataFrame:
    return _round(centroid(_placed(spark, folder)), "latitude", "longitude")


CHECKS = {
    "wind_profile": (wind_profile, WIND_PROFILE_SQL),
    "sunlight_profile": (sunlight_profile, SUNLIGHT_PROFILE_SQL),
    "precipitation_profile": (precipitation_profile, PRECIPITATION_PROFILE_SQL),
    "station_profile": (station_profile, STATION_PROFILE_SQL),
    "flag_overlap": (flag_overlap, FLAG_OVERLAP_SQL),
    "guarded_mean": (guarded_mean, GUARDED_MEAN_SQL),
    "first_last_by_order": (first_last_by_order, FIRST_LAST_SQL),
    "enrich_latest": (enrich_latest, ENRICH_SQL),
    "semi_details": (semi_details, SEMI_SQL),
    "dim_lookup": (
        dim_lookup,
        """select event_id, c_name as station_name, n_name as country
           from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey""",
    ),
    "value_counts": (value_counts, VALUE_COUNTS_SQL),
    "country_activity": (
        country_activity,
        f"""with {DETAILS_SQL} select count(distinct coalesce(country, 'Unknown')) as countries,
            count(*) filter (status = 'Active') as active_stations, count(*) as stations from details""",
    ),
    "country_list": (
        country_list,
        f"with {DETAILS_SQL} select distinct coalesce(country, 'Unknown') as country from details",
    ),
    "param_coverage": (param_coverage, PARAM_COVERAGE_SQL),
    "time_range": (
        time_range,
        """select left(cast(min(ts) as varchar), 10) as earliest,
           left(cast(max(ts) as varchar), 10) as latest from events""",
    ),
    "extreme_rows": (extreme_rows, EXTREME_SQL),
    "topk_station": (topk_station, TOPK_SQL),
    "sorted_profile": (sorted_profile, SORTED_SQL),
    "distinct_sets": (distinct_sets, DISTINCT_SQL),
    "distinct_sketched": (distinct_sketched, DISTINCT_SKETCHED_SQL),
    "station_union": (station_union, STATION_UNION_SQL),
    "paged_accounting": (paged_accounting, PAGED_SQL),
    "truncated_pages": (
        truncated_pages,
        f"""with {observations_sql(WIND)} select parameter, page, count(*) as rows,
            count(*) >= 200 as "full" from obs group by parameter, page""",
    ),
    "reconcile_count": (
        reconcile_count,
        """select count(distinct user_id) as found, cast(35 as bigint) as expected,
           case when count(distinct user_id) > 35 then 'more' when count(distinct user_id) = 35
                then 'equal' else 'fewer' end as verdict from events""",
    ),
    "recent_distinct": (recent_distinct, RECENT_SQL),
    "recent_sample": (
        recent_sample,
        f"""with {observations_sql(WIND)} select distinct station_id from obs
            where observed_from >= date '2024-01-30' - 7 and observed_from <= date '2024-01-30' order by 1 limit 5""",
    ),
    "place_names": (
        place_names_rows,
        f"""with {_PLACED_SQL}, f as (select lat, lng, name, min(ord) as first_ord from keyed group by lat, lng, name)
            select lat, lng, row_number() over (partition by lat, lng order by first_ord, name) as position, name from f""",
    ),
    "observation_summary": (observation_summary, SUMMARY_SQL),
    "station_coverage": (station_coverage, COVERAGE_SQL),
    "clean_observations": (clean_observations, CLEAN_SQL),
    "null_rows_removed": (null_rows_removed, NULL_ROWS_SQL),
    "profile_report": (profile_report, PROFILE_REPORT_SQL),
    "check_report": (check_report, CHECK_REPORT_SQL),
    "month_coverage": (month_coverage_report, MONTH_COVERAGE_SQL),
    "month_grid": (month_grid_plan, MONTH_GRID_SQL),
    "month_window": (month_window_rows, MONTH_WINDOW_SQL),
    "location_rollup": (location_rollup_rows, f"with {_PLACED_SQL} select * from rollup"),
    "location_counts": (
        location_totals,
        f"""with {_PLACED_SQL} select count(*) as locations,
            count(*) filter (place_class <> 'multi') as single_type,
            count(*) filter (place_class = 'multi') as multi_type from rollup""",
    ),
    "centroid": (
        centroid_row,
        f"""with {_PLACED_SQL} select round(avg(latitude), 6) as latitude,
            round(avg(longitude), 6) as longitude from placed""",
    ),
}
