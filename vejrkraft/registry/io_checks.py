"""Sources, sinks and streams, run over the driver's tables.

Each query lands a whole table in the form its source expects, in the session's shared folder, and
reads it back through the source.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vejrkraft.functions.areas import price_area
from vejrkraft.functions.times import iso_text
from vejrkraft.operators.cleaning import clean_observations
from vejrkraft.operators.nearest import nearest_point
from vejrkraft.operators.profiles import latest_details
from vejrkraft.operators.summaries import page_accounting
from vejrkraft.plans.collection import profile_stations
from vejrkraft.registry.station_checks import (
    PRECIPITATION_PROFILE_SQL,
    SUNLIGHT_PROFILE_SQL,
    WIND_PROFILE_SQL,
)
from vejrkraft.registry.tables import (
    DETAILS_SQL,
    STATIONS_SQL,
    WEATHER,
    WIND,
    case,
    case_sql,
    details,
    offset_text,
    reference_points,
    table,
)
from vejrkraft.schemas import WIND_TYPES
from vejrkraft.session import checkpoint_dir
from vejrkraft.sinks import files as sinks
from vejrkraft.sinks import messages
from vejrkraft.sources import files, pages, stations
from vejrkraft.streaming import ingest, labels

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_PAGE_ROWS = 1000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def csv_source(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as semicolon CSV, read back by header name with their types."""
    out = _folder(spark, "csv")
    e = table(spark, folder, "events")
    rows = e.select(
        F.lpad(F.col("user_id").cast("string"), 5, "0").alias("station_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm").alias("to_time"),
        case("event_type", WIND).alias("parameter"),
        "value",
        "event_id",
    )
    sinks.write_csv(rows, out, sep=";")
    back = files.read_csv(spark, out, {**WIND_TYPES, "event_id": "bigint"}, sep=";")
    return back.select("event_id", "station_id", "date", "to_time", "parameter", "value")


CSV_SQL = f"""select event_id, lpad(cast(user_id as varchar), 5, '0') as station_id,
      strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H:%M') as to_time,
      {case_sql("event_type", WIND)} as parameter, value from events"""


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Events as lines of text, some short of a field and some with one too many: good rows, and the other lines as they stand."""
    out = _folder(spark, "csv")
    e = table(spark, folder, "events")
    fields = F.concat_ws(";", "event_id", "user_id", "event_type")
    line = (
        F.when(F.col("event_id") % 11 == 0, F.concat_ws(";", "event_id", "user_id"))
        .when(F.col("event_id") % 13 == 0, F.concat(fields, F.lit(";extra")))
        .otherwise(fields)
    )
    # Each file needs the header as its first line.
    lines = e.repartition(4, "user_id").select(F.spark_partition_id().alias("part"), F.lit(1).alias("at"), line.alias("value"))
    header = lines.select("part").distinct().select("part", F.lit(0).alias("at"), F.lit("event_id;user_id;event_type").alias("value"))
    headed = header.unionByName(lines)
    headed = headed.repartition(4, "part").sortWithinPartitions("part", "at")
    headed.select("part", "value").write.partitionBy("part").text(out)
    back = files.read_csv(spark, f"{out}/*", {"event_id": "bigint", "user_id": "bigint"}, sep=";", record="line")
    good, bad = files.split_records(back, "line")
    good = good.select("event_id", "user_id", "event_type", F.lit(None).cast("string").alias("line"))
    number = F.split("line", ";")[0].cast("long")
    return good.unionByName(
        bad.select(number.alias("event_id"), F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("string").alias("event_type"), "line")
    )


CSV_REJECTS_SQL = """with r as (select *, event_id % 11 = 0 as short, event_id % 13 = 0 as long from events)
    select event_id, case when not (short or long) then user_id end as user_id,
      case when not (short or long) then event_type end as event_type,
      case when short then event_id || ';' || user_id when long then event_id || ';' || user_id || ';' || event_type || ';extra' end as line
    from r"""


def _packed(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Each task's rows as one zip archive, an entry per batch."""
    name = f"{uuid4().hex}.zip"
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place)
    n = 0
    with store.open_output_stream(f"{place}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for batch in batches:
            z.writestr(f"{n}.csv", batch.to_pandas().to_csv(index=False))
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "entries"])


def zipped_source(spark: SparkSession, folder: str) -> DataFrame:
    """Events packed into zip archives, with several entries each, and read back entry by entry."""
    out = _folder(spark, "zips")
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type").repartition(6, "user_id")
    packed = e.mapInArrow(lambda batches: _packed(batches, out), "archive string, entries long")
    entries = packed.agg(F.sum("entries")).first()[0]
    back = files.read_zipped_csv(spark, out, ["event_id", "user_id", "event_type"], {"event_id": "bigint", "user_id": "bigint"}, entries="all")
    return back.select("event_id", "user_id", "event_type", (F.lit(entries) >= 1).alias("packed"))


def message_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of several files sent to a receiver that takes messages of 52 bytes at most: what it has, and what it refused."""
    _, stream = _event_files(spark, folder)
    sent = ingest.route_topics(
        stream.select("event_id", "user_id", "event_type"), "event_type", {"view": "weather", "click": "weather", "purchase": "consumption"}
    )
    out = _folder(spark, "sent")
    messages.send_stream(
        sent, "vejrkraft.sinks.messages:FileSpool", f"{out}/dead", f"{out}/state", spool=f"{out}/spool", max_bytes="52"
    ).awaitTermination()
    kept = spark.read.schema("topic string, value string").json(f"{out}/spool").withColumn("outcome", F.lit("sent"))
    refused = messages.dead_letters(spark, f"{out}/dead").withColumnRenamed("reason", "outcome")
    number = F.get_json_object("value", "$.event_id").cast("long")
    return kept.unionByName(refused).select("topic", number.alias("event_id"), "outcome")


MESSAGE_DELIVERY_SQL = """select case event_type when 'purchase' then 'consumption' else 'weather' end as topic, event_id,
      case when 40 + length(event_id::varchar || user_id::varchar || event_type) > 52 then 'message too large' else 'sent' end as outcome
    from events where event_type in ('view', 'click', 'purchase')"""


def ndjson_source(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as one document per line, read back strictly."""
    out = _folder(spark, "ndjson")
    table(spark, folder, "conversations").write.json(out)
    return files.read_ndjson(spark, out, "conv_id long, turn long, role string, text string")


def ndjson_variant(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of unknown shape: fields picked from variants."""
    out = _folder(spark, "ndjson")
    table(spark, folder, "events").select("event_id", "event_type", "value").write.json(out)
    docs = files.read_ndjson(spark, out)
    pick = lambda name, kind: F.try_variant_get("document", f"$.{name}", kind).alias(name)
    return docs.select(pick("event_id", "bigint"), pick("event_type", "string"), pick("value", "double"))


def _land_pages(spark: SparkSession, folder: str) -> str:
    """Events as service pages: JSON documents of 1,000 features, as the service sends them, a line each.

    Every 'signup' lacks its station, and small values are unreadable text.
    """
    out = _folder(spark, "pages")
    e = table(spark, folder, "events")
    value = F.col("value").cast("string")
    properties = F.struct(
        F.when(F.col("event_type") != "signup", F.col("user_id").cast("string")).alias("stationId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("from"),
        F.when(F.col("value") < 5, F.concat(value, F.lit("?"))).otherwise(value).alias("value"),
    )
    place = F.struct(F.array(9 + F.col("value") / 50, 55 + F.col("value") / 100).alias("coordinates"))
    feature = F.struct("event_id", place.alias("geometry"), properties.alias("properties"))
    # A page has a fixed number of rows, so the lists are short.
    page = F.floor(F.col("event_id") / _PAGE_ROWS)
    documents = e.groupBy((page * _PAGE_ROWS).alias("offset")).agg(
        F.array_sort(F.collect_list(feature)).alias("features")
    )
    text = F.to_json(F.struct("offset", "features"))
    documents.select(F.lit("all").alias("parameter"), text.alias("value")).write.partitionBy("parameter").text(out)
    return out


def landed_observations(spark: SparkSession, folder: str) -> DataFrame:
    landed = pages.read_observation_pages(spark, _land_pages(spark, folder), lines=True)
    good, bad = pages.observations(pages.last_landings(landed))
    out = good.withColumn("reason", F.lit("good")).unionByName(bad.drop("value_text"))
    return out.select(
        "arrival", "page", "station_id", "observed_from", "value", "reason",
        F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
    )


LANDED_SQL = f"""with r as (
      select *, event_type <> 'signup' as known, value >= 5 as readable from events)
    select event_id as arrival, event_id // 1000 * 1000 as page,
      case when known then cast(user_id as varchar) end as station_id,
      strftime(ts, {_ISO}) as observed_from, case when readable then value end as value,
      case when not known then 'no station' when not readable then 'unreadable value'
           else 'good' end as reason,
      round(55 + value / 100, 6) as latitude, round(9 + value / 50, 6) as longitude from r"""


def landed_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """Page accounting straight from landed pages."""
    landed = pages.read_observation_pages(spark, _land_pages(spark, folder), lines=True)
    good, _ = pages.observations(pages.last_landings(landed))
    return page_accounting(good).drop("parameter")


LANDED_ACCOUNTING_SQL = """with g as (
      select event_id // 1000 * 1000 as page, user_id from events
      where event_type <> 'signup' and value >= 5),
    f as (select page, count(*) as fresh from (select user_id, min(page) as page from g group by 1) group by 1)
    select g.page, count(*) as rows, count(distinct user_id) as stations,
      coalesce(any_value(fresh), 0) as new_stations,
      cast(sum(coalesce(any_value(fresh), 0)) over (order by g.page) as bigint) as stations_so_far
    from g left join f using (page) group by g.page"""


# Pages hold the rows of this many ids, so their number grows with the table; one of them is landed twice, one offset is left out, and
# later pages lie beyond the offsets that the service's own clients ask for.
_PAGE_IDS = 250
_GAP_AT, _FAR_AT = 2, 3
_STEP = 100_000
_FAR = 200_000_000


def _offset(page: Column, step: int) -> Column:
    far = F.when(page >= _FAR_AT, _FAR).otherwise(0)
    return (page + (page >= _GAP_AT).cast("long")) * step + far


def _offset_sql(page: str, step: int) -> str:
    return f"({page} + ({page} >= {_GAP_AT})::bigint) * {step} + case when {page} >= {_FAR_AT} then {_FAR} else 0 end"


def _land_twice(
    spark: SparkSession, rows: DataFrame, id_col: str, by: list[str], feature: Column, items: str, step: int
) -> str:
    """``rows`` as pages of a service, a JSON document a line, in order of ``id_col``."""
    out = _folder(spark, "pages")
    page = F.floor(F.col(id_col) / _PAGE_IDS)
    documents = (
        rows.groupBy(*by, page.alias("page"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct(id_col, feature.alias("item")))), lambda x: x["item"]).alias(items))
    )
    placed = documents.withColumn("offset", _offset(F.col("page"), step))
    # An earlier landing of one page held half of its rows.
    half = placed.where("page = 1").withColumn(items, F.slice(items, 1, F.size(items).cast("int") / 2))
    for landing in (half, placed):
        text = landing.select(*by, F.to_json(F.struct("offset", items)).alias("value"))
        text.write.mode("append").partitionBy(*by).text(out)
    return out


# Added to amounts that are rounded to two digits, so that no mean lies half-way.
_SHIFT = 0.00137


def _land_parameters(
    spark: SparkSession, folder: str, parameters: dict[str, str], step: int = _STEP, shift: float = 0.0
) -> str:
    """Events as observation pages. Every 97th has lost its station."""
    e = table(spark, folder, "events").withColumn("parameter", case("event_type", parameters))
    value = F.col("value")
    properties = F.struct(
        F.when(F.col("event_id") % 97 != 0, F.col("user_id").cast("string")).alias("stationId"),
        offset_text(F.col("ts"), F.col("event_id") % 2 == 1).alias("from"),
        F.when(value >= 15, (value + shift).cast("string")).alias("value"),
    )
    place = F.struct(F.array(9 + value / 50, 55 + value / 100).alias("coordinates"))
    feature = F.struct(F.when(value < 60, place).alias("geometry"), properties.alias("properties"))
    return _land_twice(spark, e, "event_id", ["parameter"], feature, "features", step)


def _land_details(spark: SparkSession, folder: str) -> str:
    d = details(spark, folder)
    properties = F.struct(
        F.col("station_id").alias("stationId"), "name", "country", "status",
        F.col("valid_from").alias("validFrom"), F.col("valid_to").alias("validTo"),
    )
    feature = F.struct(F.lit(None).cast("string").alias("geometry"), properties.alias("properties"))
    return _land_twice(spark, d, "arrival", [], feature, "features", _STEP)


def _profile_from_pages(kind: str, parameters: dict[str, str], shift: float = 0.0):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        obs = _land_parameters(spark, folder, parameters, shift=shift)
        det = _land_details(spark, folder)
        out = profile_stations(spark, kind, obs, det, _folder(spark, "rejects"), lines=True)
        times = [c for c, t in out.dtypes if t.startswith("timestamp")]
        out = out.withColumns({c: iso_text(c) for c in times})
        return out.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})

    return query


def _with_stations(sql: str) -> str:
    return sql.replace("from events)", "from events where event_id % 97 <> 0)")


def page_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What the profile leaves out is written, with the reason."""
    out = _folder(spark, "rejects")
    profile_stations(spark, "wind", _land_parameters(spark, folder, WIND), _land_details(spark, folder), out, lines=True)
    bad = files.read_parquet(spark, f"{out}/observations")
    return bad.groupBy("parameter", "reason").agg(F.count(F.lit(1)).alias("n"))


PAGE_REJECTS_SQL = f"""select {case_sql("event_type", WIND)} as parameter, 'no station' as reason, count(*) as n
    from events where event_id % 97 = 0 group by 1"""


def page_ledger(spark: SparkSession, folder: str) -> DataFrame:
    landed = pages.read_observation_pages(spark, _land_parameters(spark, folder, WIND, step=100), lines=True)
    return pages.page_ledger(landed, limit=100).withColumn("rows", F.col("rows").cast("long"))


PAGE_LEDGER_SQL = f"""with p as (
      select {case_sql("event_type", WIND)} as parameter,
        event_id // {_PAGE_IDS} as page from events),
    n as (select parameter, page, {_offset_sql("page", 100)} as "offset", count(*) as rows from p group by all)
    select parameter, "offset"::bigint as "offset", case page when 1 then 2 else 1 end::bigint as landings, rows,
      rows >= 100 as "full",
      "offset" > 0 and not exists (select 1 from n b where b.parameter = n.parameter and b."offset" = n."offset" - 100) as gap_before,
      not exists (select 1 from n b where b.parameter = n.parameter and b."offset" = n."offset" + 100) as "last"
    from n"""


def details_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The last details of every station over all pages."""
    landed = pages.last_landings(pages.read_detail_pages(spark, _land_details(spark, folder), lines=True), by=())
    good, _ = pages.station_details(landed)
    return latest_details(good)


def record_pages(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    record = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("TimeUTC"),
        F.col("o_custkey").cast("int").alias("MunicipalityCode"),
        F.col("o_orderstatus").alias("RegionName"),
        F.col("o_totalprice").alias("ConsumptionkWh"),
    )
    landed = _land_twice(spark, o, "o_orderkey", [], record, "records", _STEP)
    return pages.read_record_pages(spark, landed, lines=True).drop("ord")


RECORD_PAGES_SQL = """select strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as "TimeUTC", null::varchar as "TimeDK",
      o_custkey::int as "MunicipalityCode", null::varchar as "Municipality", o_orderstatus as "RegionName",
      o_totalprice as "ConsumptionkWh" from orders"""


def station_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Three station tables of different shape as CSV, one of them missing, loaded together."""
    wind, sun = _folder(spark, "wind"), _folder(spark, "sun")
    s, c = table(spark, folder, "supplier"), table(spark, folder, "customer")
    s.select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("Name"),
        (55 + F.col("s_nationkey") / 8).alias("Lat"),
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey") / 4).alias("Lng"),
        F.lit("Active").alias("status"),
    ).write.option("header", True).csv(wind)
    c.select(
        F.col("c_custkey").alias("station_id"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_nationkey") / 8).cast("string")).otherwise("?").alias("latitude"),
        (F.col("c_nationkey") / 4).alias("longitude"),
    ).write.option("header", True).csv(sun)
    paths = {"wind": wind, "precipitation": _folder(spark, "none"), "sunlight": sun}
    out = stations.load_stations(spark, paths)
    return out.select("station_type", "station_id", "name", "latitude", "longitude", "status")


STATION_TABLES_SQL = """select 'wind' as station_type, cast(s_suppkey as varchar) as station_id,
      s_name as name, 55 + s_nationkey / 8 as latitude, s_nationkey / 4 as longitude,
      'Active' as status from supplier where s_acctbal > 0
    union all
    select 'sunlight', cast(c_custkey as varchar), 'Sunlight Station ' || c_custkey,
      c_nationkey / 8, c_nationkey / 4, null from customer where c_acctbal > 0"""


def json_document(spark: SparkSession, folder: str) -> DataFrame:
    """All events as one JSON array in parts; each line holds one element. The manifest's offsets follow from one another."""
    out = _folder(spark, "document")
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    parts = sinks.write_json_document(e, out, ["event_id"])
    after = Window.orderBy("part").rowsBetween(-1, -1)
    end = F.coalesce(F.sum(F.col("offset") + F.col("bytes")).over(after), F.lit(0))
    contiguous = parts.withColumn("follows", F.col("offset") == end).agg(F.bool_and("follows")).first()[0]
    element = F.from_json(F.regexp_extract("value", r"^\[?(.*?)(, |\])$", 1), "event_id long, user_id long, event_type string")
    lines = spark.read.text(out).select(element.alias("e"), F.left("value", F.lit(1)).alias("opens"), F.right("value", F.lit(1)).alias("closes"))
    return lines.select(
        "e.*", (F.col("opens") == "[").alias("first"), (F.col("closes") == "]").alias("last"), F.lit(contiguous).alias("contiguous")
    )


JSON_DOCUMENT_SQL = """select event_id, user_id, event_type, event_id = (select min(event_id) from events) as first,
      event_id = (select max(event_id) from events) as last, true as contiguous from events"""


def yearly_output(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written by year and read back."""
    out = _folder(spark, "years")
    o = table(spark, folder, "orders")
    early = F.year("o_orderdate") < 1996
    sinks.write_by_year(o.where(early), out, "o_orderdate", ["o_custkey", "o_orderdate"])
    # The other years come with years that are there already, which are replaced.
    late = o.where(~early | (F.year("o_orderdate") == 1995))
    sinks.write_by_year(late, out, "o_orderdate", ["o_custkey", "o_orderdate"], overwrite=True)
    back = files.read_parquet(spark, out)
    return back.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def monthly_output(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written by month, columns sorted; the folder is the combined table."""
    out = _folder(spark, "months")
    sinks.write_by_month(table(spark, folder, "orders"), out, "o_orderdate")
    back = files.read_parquet(spark, out)
    order = F.lit(",".join(back.columns))
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).withColumn("column_order", order)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of files in order of time, one file a batch. Streams need an instant, so the wall-clock
    time is taken as UTC."""
    out = _folder(spark, "stream")
    e = table(spark, folder, "events").withColumn("datetime", F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min("datetime"), F.max("datetime")).first()
    step = (last - first) / 4
    # Files are taken in the order they were written.
    for i in range(4):
        low, high = first + step * i, first + step * (i + 1)
        part = e.where((F.col("datetime") >= low) & (F.col("datetime") < high)) if i < 3 else e.where(F.col("datetime") >= low)
        part.coalesce(1).write.mode("append").parquet(out)
    return ingest.stream_files(spark, out, e.schema, "parquet", maxFilesPerTrigger="1")


def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The batch clean-up on a stream: decode, drop valueless rows, area rule, names, land."""
    stream = _event_stream(spark, folder)
    messages = stream.withColumn("value", F.when(F.col("value") >= 15, F.col("value")))
    sent = ingest.route_topics(
        messages.select("event_id", "datetime", "user_id", "event_type", "value"),
        "event_type",
        {"view": "weather", "click": "weather", "error": "price", "purchase": "consumption"},
    )
    shape = "event_id long, datetime timestamp, user_id long, event_type string, value double"
    names = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    good = clean_observations(ingest.decode(sent, shape)).join(names, "user_id")
    code = (F.col("event_id") % 800).cast("int")
    good = good.withColumn("code", code).withColumn("area", price_area("code", "municipality"))
    out = _folder(spark, "landing")
    ingest.land(good, out, f"{out}-state", partition_by=["topic"]).awaitTermination()
    back = files.read_parquet(spark, out)
    return back.select("topic", "event_id", iso_text("datetime").alias("datetime"), "name", "area", "value")


STREAM_LANDING_SQL = f"""select case event_type when 'error' then 'price' when 'purchase' then 'consumption'
        else 'weather' end as topic, event_id, strftime(ts, {_ISO}) as datetime, c_name as name,
      case when event_id % 800 > 400 then '1' else '2' end as area, value
    from events join customer on c_custkey = user_id
    where event_type <> 'signup' and value >= 15"""


def stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sums of a stream: every hour the watermark has passed."""
    stream = _event_stream(spark, folder).where(F.col("event_type") == "purchase")
    hourly = ingest.hourly_consumption(stream, "10 minutes", key="user_id", value="value")
    out = _folder(spark, "hourly")
    ingest.land(hourly, out, f"{out}-state").awaitTermination()
    back = files.read_parquet(spark, out)
    return back.select(iso_text("datetime").alias("hour"), "user_id", F.round("value", 6).alias("value"))


STREAM_HOURLY_SQL = f"""with p as (select * from events where event_type = 'purchase')
    select strftime(date_trunc('hour', ts), {_ISO}) as hour, user_id, round(sum(value), 6) as value
    from p where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) - interval 10 minutes from p)
    group by date_trunc('hour', ts), user_id"""


def _event_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The events in several files, and as a stream that takes one file at a time; the files are not in order of
    time, so that many rows come late."""
    out = _folder(spark, "files")
    e = table(spark, folder, "events").withColumn("datetime", F.col("ts").cast("timestamp"))
    e = e.withColumn("late", F.col("event_id") % 5)
    e.repartition(5, "late").write.parquet(out)
    landed = files.read_parquet(spark, out)
    return landed, ingest.stream_files(spark, out, landed.schema, "parquet", maxFilesPerTrigger="1")


def stream_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sums of a stream with late rows, closed by a batch pass over what has been landed."""
    landed, stream = _event_files(spark, folder)
    bought = F.col("event_type") == "purchase"
    out = _folder(spark, "hourly")
    hourly = ingest.hourly_consumption(stream.where(bought), "10 minutes", key="user_id", value="value")
    ingest.land(hourly, out, f"{out}-state").awaitTermination()
    emitted = files.read_parquet(spark, out)
    rest = ingest.open_hours(landed.where(bought), emitted, key="user_id", value="value")
    keys = ["datetime", "user_id"]
    whole = emitted.join(rest, keys, "left_anti").select(*keys, "value").unionByName(rest)
    return whole.select(iso_text("datetime").alias("hour"), "user_id", F.round("value", 6).alias("value"))


STREAM_CLOSED_SQL = f"""select strftime(date_trunc('hour', ts), {_ISO}) as hour, user_id, round(sum(value), 6) as value
    from events where event_type = 'purchase' group by date_trunc('hour', ts), user_id"""


def stream_labels(spark: SparkSession, folder: str) -> DataFrame:
    """First labels per hour on a stream of several files out of order: the last revision of every hour that has settled."""
    _, stream = _event_files(spark, folder)
    rows = stream.where(F.col("event_type") == "purchase").select(
        "datetime",
        (F.col("user_id") % 10).cast("int").alias("code"),
        F.when(F.col("value") >= 15, F.col("value")).alias("kwh"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("t"), F.col("event_id") % 100)).alias("place"),
        F.when(F.col("value") > 30, F.col("user_id")).alias("region"),
        F.col("event_id").alias("ord"),
    )
    hourly = labels.hourly_with_labels(
        rows, settle="2 hours", keep="400 days", key="code", value="kwh", labels=["place", "region"]
    )
    out = _folder(spark, "labels")
    with labels.rocksdb_state(spark):
        query = ingest.land(hourly, out, f"{out}-state")
    query.awaitTermination()
    last = labels.last_revisions(files.read_parquet(spark, out), key="code")
    return last.select(iso_text("datetime").alias("hour"), "code", F.round("kwh", 6).alias("kwh"), "place", "region")


STREAM_LABELS_SQL = f"""with p as (select date_trunc('hour', ts) as h, ts, (user_id % 10)::integer as code, event_id,
      case when value >= 15 then value end as kwh, case when event_id % 3 <> 0 then 't' || event_id % 100 end as place,
      case when value > 30 then user_id end as region from events where event_type = 'purchase')
    select strftime(h, {_ISO}) as hour, code, round(coalesce(sum(kwh), 0), 6) as kwh,
      arg_min(place, event_id) filter (place is not null) as place, arg_min(region, event_id) filter (region is not null) as region
    from p where h + interval 3 hour <= (select max(ts) from p) group by h, code"""


def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The batch clean-up, nearest point included, on a stream of several files."""
    _, stream = _event_files(spark, folder)
    points = reference_points(spark, folder)

    def clean(batch: DataFrame) -> DataFrame:
        placed = batch.withColumns({"latitude": F.col("value") / 100 - 0.5, "longitude": F.col("user_id") / 150 - 0.5})
        return nearest_point(clean_observations(placed), points)

    out = _folder(spark, "clean")
    ingest.clean_batches(stream, clean, out, f"{out}-state").awaitTermination()
    back = files.read_parquet(spark, out)
    return back.select("event_id", F.col("municipality_code").cast("int").alias("municipality_code"))


STREAM_CLEAN_SQL = f"""with {STATIONS_SQL},
    e as (select event_id, value / 100 - 0.5 as latitude, user_id / 150 - 0.5 as longitude from events where value is not null)
    select event_id, cast(p.code as integer) as municipality_code from e, points p
    qualify row_number() over (partition by event_id order by (e.latitude - p.latitude) * (e.latitude - p.latitude)
      + (e.longitude - p.longitude) * (e.longitude - p.longitude), p.ord) = 1"""


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that cannot be read and rows without a topic, each landed in a table of its own."""
    _, stream = _event_files(spark, folder)
    topics = {"view": "weather", "click": "weather", "error": "price"}
    broken = F.when(F.col("event_id") % 10 == 0, F.lit("{oops")).otherwise(F.col("value"))
    sent = ingest.route_topics(stream.select("event_id", "event_type"), "event_type", topics)
    sent = sent.withColumn("event_id", F.get_json_object("value", "$.event_id").cast("long"))
    bad = ingest.undecoded(sent.withColumn("value", broken), "event_id long, event_type string").select("event_id")
    lost = ingest.unrouted(stream.select("event_id", "event_type"), "event_type", topics).select("event_id")
    found = []
    for reason, rows in (("unreadable", bad), ("no topic", lost)):
        out = _folder(spark, "rejects")
        ingest.land(rows, out, f"{out}-state").awaitTermination()
        found.append(files.read_parquet(spark, out).withColumn("reason", F.lit(reason)))
    return found[0].unionByName(found[1])


STREAM_REJECTS_SQL = """select event_id, 'no topic' as reason from events where event_type in ('purchase', 'signup')
    union all select event_id, 'unreadable' from events where event_type in ('view', 'click', 'error') and event_id % 10 = 0"""


def stream_once(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats of a polled document dropped: events repeat by user and hour."""
    stream = _event_stream(spark, folder).withColumn("hour", F.date_trunc("hour", "datetime"))
    once = ingest.once_per_document(stream, ["user_id", "hour"], "datetime", "30 days")
    out = _folder(spark, "once")
    ingest.land(once.select("user_id", "hour"), out, f"{out}-state").awaitTermination()
    return files.read_parquet(spark, out).select("user_id", iso_text("hour").alias("hour"))


def analytics_area(spark: SparkSession, folder: str) -> DataFrame:
    """A result table written for reports and read back."""
    status = details(spark, folder).groupBy("country", "status").agg(F.count(F.lit(1)).alias("n"))
    path = sinks.write_analytics(status, _folder(spark, "base"), "status")
    return files.read_parquet(spark, path)


CHECKS = {
    "profile_from_pages_wind": (_profile_from_pages("wind", WIND), _with_stations(WIND_PROFILE_SQL)),
    "profile_from_pages_sunlight": (
        _profile_from_pages("sunlight", WEATHER),
        _with_stations(SUNLIGHT_PROFILE_SQL),
    ),
    "profile_from_pages_precipitation": (
        _profile_from_pages("precipitation", WEATHER, _SHIFT),
        # The profile rounds amounts to two digits unless told otherwise.
        _with_stations(PRECIPITATION_PROFILE_SQL)
        .replace("then value end as value", f"then value + {_SHIFT} end as value")
        .replace("/ count(*), 6)", "/ count(*), 2)")
        .replace("round(sum(value), 6)", "round(sum(value), 2)"),
    ),
    "page_rejects": (page_rejects, PAGE_REJECTS_SQL),
    "page_ledger": (page_ledger, PAGE_LEDGER_SQL),
    "details_pages": (
        details_pages,
        f"with {DETAILS_SQL} select station_id, name, country, status, valid_from, valid_to from latest",
    ),
    "record_pages": (record_pages, RECORD_PAGES_SQL),
    "csv_source": (csv_source, CSV_SQL),
    "csv_rejects": (csv_rejects, CSV_REJECTS_SQL),
    "zipped_source": (zipped_source, "select event_id, user_id, event_type, true as packed from events"),
    "message_delivery": (message_delivery, MESSAGE_DELIVERY_SQL),
    "ndjson_source": (ndjson_source, "select * from conversations"),
    "ndjson_variant": (ndjson_variant, "select event_id, event_type, value from events"),
    "landed_observations": (landed_observations, LANDED_SQL),
    "landed_accounting": (landed_accounting, LANDED_ACCOUNTING_SQL),
    "station_tables": (station_tables, STATION_TABLES_SQL),
    "json_document": (json_document, JSON_DOCUMENT_SQL),
    "yearly_output": (
        yearly_output,
        """select cast(year(o_orderdate) as integer) as year, count(*) as n,
           round(sum(o_totalprice), 2) as total from orders group by 1""",
    ),
    "monthly_output": (
        monthly_output,
        """select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
           count(*) as n, 'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice,year,month'
             as column_order from orders group by 1, 2""",
    ),
    "stream_landing": (stream_landing, STREAM_LANDING_SQL),
    "stream_hourly": (stream_hourly, STREAM_HOURLY_SQL),
    "stream_closed": (stream_closed, STREAM_CLOSED_SQL),
    "stream_labels": (stream_labels, STREAM_LABELS_SQL),
    "stream_clean": (stream_clean, STREAM_CLEAN_SQL),
    "stream_rejects": (stream_rejects, STREAM_REJECTS_SQL),
    "stream_once": (
        stream_once,
        f"select distinct user_id, strftime(date_trunc('hour', ts), {_ISO}) as hour from events",
    ),
    "analytics_area": (
        analytics_area,
        """select case o_orderstatus when 'P' then 'DNK' when 'F' then 'GRL' end as country,
           case when o_totalprice > 100000 then 'Active' when o_totalprice > 50000 then 'Inactive' end as status,
           count(*) as n from orders group by 1, 2""",
    ),
}
