"""Scalar functions, documents, unions and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions import documents, texts, times
from vejrkraft.functions.areas import price_area
from vejrkraft.functions.numbers import to_number
from vejrkraft.operators import cleaning, stats
from vejrkraft.registry.tables import table
from vejrkraft.streaming.ingest import route_topics

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def parse_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as market intervals of one hour; urgent orders lack the separator."""
    o = table(spark, folder, "orders")
    start = F.col("o_orderdate").cast("timestamp")
    text = lambda c: F.date_format(c, fv.MARKET_TIME)
    separator = F.when(F.col("o_orderpriority") == "1-URGENT", " to ").otherwise(" - ")
    interval = F.concat(text(start), separator, text(start + F.expr("interval 1 hour")))
    rows = o.select("o_orderkey", interval.alias("mtu"))
    return rows.select(
        "o_orderkey",
        times.interval_edge("mtu").alias("end_text"),
        times.iso_text(times.market_time(times.interval_edge("mtu"))).alias("end_time"),
        times.iso_text(times.market_time(times.interval_edge("mtu", "start"))).alias("start_time"),
    )


PARSE_INTERVAL_SQL = f"""with r as (
      select o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')
        || case when o_orderpriority = '1-URGENT' then ' to ' else ' - ' end
        || strftime(o_orderdate + interval 1 hour, '%d/%m/%Y %H:%M:%S') as mtu from orders),
    s as (select o_orderkey, nullif(split_part(mtu, ' - ', 2), '') as e,
                 case when contains(mtu, ' - ') then split_part(mtu, ' - ', 1) end as b from r)
    select o_orderkey, e as end_text,
      strftime(strptime(e, '%d/%m/%Y %H:%M:%S'), {_ISO}) as end_time,
      strftime(strptime(b, '%d/%m/%Y %H:%M:%S'), {_ISO}) as start_time from s"""


def timestamp_text(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    rows = e.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm").alias("to_time"),
        F.concat(F.date_format("ts", fv.ISO_TIME), F.lit("+02:00")).alias("offset_text"),
    )
    stamp = times.date_and_time("date", "to_time")
    return rows.select(
        "event_id",
        times.iso_text(stamp).alias("utc"),
        times.iso_text(times.utc_time(stamp, fv.DANISH_ZONE)).alias("from_danish"),
        times.iso_text(times.local_time(stamp)).alias("to_danish"),
        times.iso_text(times.iso_time("offset_text")).alias("from_offset"),
    )


TIMESTAMP_TEXT_SQL = f"""with r as (select event_id, date_trunc('minute', ts) as m, ts from events)
    select event_id, strftime(m, {_ISO}) as utc,
      strftime((m at time zone 'Europe/Copenhagen') at time zone 'UTC', {_ISO}) as from_danish,
      strftime((m at time zone 'UTC') at time zone 'Europe/Copenhagen', {_ISO}) as to_danish,
      strftime(date_trunc('second', ts) - interval 2 hour, {_ISO}) as from_offset from r"""


def try_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates and prices as text, damaged for two priorities."""
    o = table(spark, folder, "orders")
    low, urgent = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "1-URGENT"
    stamp = F.date_format("o_orderdate", fv.ISO_TIME)
    rows = o.select(
        "o_orderkey",
        F.when(low, F.concat(F.lit("on "), stamp)).otherwise(stamp).alias("TimeUTC"),
        F.when(low, "n/a").when(urgent, "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )
    out = times.normalize_datetime(rows, "TimeUTC", fv.ISO_TIME)
    return out.select("o_orderkey", times.iso_text("datetime").alias("datetime"), to_number("price").alias("price"))


TRY_PARSE_SQL = f"""select o_orderkey,
      case when o_orderpriority <> '5-LOW' then strftime(o_orderdate, {_ISO}) end as datetime,
      case when o_orderpriority not in ('5-LOW', '1-URGENT') then o_totalprice end as price from orders"""


def area_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Area labels, municipality codes around the limit and longitudes, some unreadable."""
    c = table(spark, folder, "customer")
    broken = F.col("c_mktsegment") == "FURNITURE"
    rows = c.select(
        "c_custkey",
        F.when(broken, "BZN|DK").otherwise(F.concat(F.lit("BZN|DK"), F.col("c_nationkey") % 2 + 1)).alias("label"),
        F.when(broken, "x").otherwise((F.col("c_nationkey") + 388).cast("string")).alias("code"),
        F.when(broken, "east").otherwise((F.col("c_nationkey") / 4 + 8).cast("string")).alias("lon"),
    )
    return rows.select(
        "c_custkey",
        price_area("label", "area").alias("by_label"),
        price_area("code", "municipality").alias("by_code"),
        price_area("lon", "longitude").alias("by_longitude"),
    )


AREA_RULES_SQL = """with r as (
      select c_custkey, c_nationkey as k, c_mktsegment = 'FURNITURE' as broken from customer)
    select c_custkey, case when not broken then cast(k % 2 + 1 as varchar) end as by_label,
      case when not broken then case when k + 388 > 400 then '1' else '2' end end as by_code,
      case when not broken then case when k / 4 + 8 < 11 then '1' else '2' end end as by_longitude from r"""


def text_case(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    segment = F.col("c_mktsegment")
    return c.select(
        "c_custkey",
        texts.title_case(F.lower(segment)).alias("title"),
        texts.mentions(segment, "machin", "build").alias("heavy"),
        texts.place_label(F.col("c_name"), F.array(F.lower(segment), F.lit("wind"))).alias("label"),
        texts.date_part(F.concat(F.lit("2024-01-0"), F.col("c_nationkey"), F.lit("T00:00"))).alias("front"),
        texts.join_present({"rich": F.col("c_acctbal") > 5000, "known": F.col("c_nationkey") < 9}).alias("marks"),
    )


TEXT_CASE_SQL = """select c_custkey,
      c_mktsegment[1] || lower(c_mktsegment[2:]) as title,
      contains(lower(c_mktsegment), 'machin') or contains(lower(c_mktsegment), 'build') as heavy,
      c_name || ' (' || lower(c_mktsegment) || ', wind)' as label,
      left('2024-01-0' || c_nationkey || 'T00:00', 10) as front,
      concat_ws(', ', case when c_acctbal > 5000 then 'rich' end,
                      case when c_nationkey < 9 then 'known' end) as marks from customer"""


def format_report(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        "event_id",
        texts.thousands(F.col("event_id") * 1000).alias("grouped"),
        texts.fixed(F.col("value"), 2).alias("value_text"),
        texts.fixed(F.col("event_id").cast("double"), 1).alias("id_text"),
        texts.fixed(F.col("user_id") / 16, 4).alias("coordinate"),
    )


FORMAT_SQL = """select event_id, format('{:,}', event_id * 1000) as grouped,
      printf('%.2f', value) as value_text, printf('%.1f', event_id::double) as id_text,
      printf('%.4f', user_id / 16) as coordinate from events"""


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    coords = F.when(F.col("value") > 50, F.array(F.col("value"))).otherwise(
        F.array(F.col("value"), F.col("value") / 2)
    )
    return e.select(
        "event_id",
        documents.field_or_empty(F.col("props"), "k").alias("k"),
        documents.field_or_empty(F.col("props"), "name").alias("name"),
        documents.coordinate(coords, "lat").alias("latitude"),
        documents.coordinate(coords, "lon").alias("longitude"),
    )


JSON_PROPS_SQL = """select event_id, coalesce(json_extract_string(props, '$.k'), '') as k,
      coalesce(json_extract_string(props, '$.name'), '') as name,
      case when value <= 50 then value / 2 end as latitude, value as longitude from events"""


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversation turns as messages; system turns carry no text."""
    c = table(spark, folder, "conversations")
    return c.withColumn("text", F.when(F.col("role") != "system", F.col("text")))


def json_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded and decoded again: every field, nulls and line breaks survive."""
    encoded = documents.encode_json(_messages(spark, folder))
    fields = F.from_json("value", "conv_id long, turn long, role string, text string")
    return encoded.select(
        F.col("conv_id"),
        F.col("turn"),
        fields["role"].alias("role"),
        fields["text"].alias("text"),
        (F.get_json_object("value", "$.turn") == F.col("turn").cast("string")).alias("same_turn"),
        F.json_object_keys("value")[3].alias("last_key"),
    )


JSON_ENCODE_SQL = """select conv_id, turn, role, case when role <> 'system' then text end as text,
      true as same_turn, 'text' as last_key from conversations"""


def json_array_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return documents.json_array_pieces(
        _messages(spark, folder), order=["turn"], keys=["conv_id"], cols=["turn", "role", "text"]
    )


JSON_ARRAY_SQL = """with r as (
      select *, min(turn) over (partition by conv_id) as lo, max(turn) over (partition by conv_id) as hi
      from conversations)
    select conv_id, turn, case when turn = lo then '[' else '' end
      || to_json({'turn': turn, 'role': role, 'text': case when role <> 'system' then text end})::varchar
      || case when turn = hi then ']' else ', ' end as piece from r"""


def topic_route(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    kinds = {"view": "weather", "click": "weather", "error": "price", "purchase": "consumption"}
    routed = route_topics(e, "event_type", kinds)
    return routed.select(
        "topic",
        documents.field_or_empty(F.col("value"), "event_id").cast("long").alias("event_id"),
        documents.field_or_empty(F.col("value"), "user_id").cast("long").alias("user_id"),
    )


TOPIC_SQL = """select case event_type when 'error' then 'price' when 'purchase' then 'consumption'
        else 'weather' end as topic, event_id, user_id
    from events where event_type in ('view', 'click', 'error', 'purchase')"""


def reject_split(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and pages judged by whole-text rules; rows per outcome."""
    d = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "text", F.when(F.col("lang") != "de", F.col("lang")).alias("lang")
    )
    p = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        F.when(F.col("page_id") % 7 != 0, F.col("html")).alias("text"),
        F.lit("html").alias("lang"),
    )
    rules = {
        "no language": F.col("lang").isNotNull(),
        "no text": F.length("text") > 0,
        "no sentence": F.col("text").contains(". "),
    }
    good, bad = cleaning.split_rejects(cleaning.union_all([d, p]), rules)
    outcome = good.withColumn("reason", F.lit("good")).unionByName(bad)
    return outcome.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


REJECT_SQL = """with r as (
      select text, case when lang <> 'de' then lang end as lang from documents
      union all select case when page_id % 7 <> 0 then html end, 'html' from pages)
    select case when lang is null then 'no language' when coalesce(length(text), 0) = 0 then 'no text'
                when not contains(text, '. ') then 'no sentence' else 'good' end as reason,
           count(*) as n, cast(sum(length(text)) as bigint) as chars from r group by 1"""


def union_all(spark: SparkSession, folder: str) -> DataFrame:
    s, c = table(spark, folder, "supplier"), table(spark, folder, "customer")
    named = lambda t, p, k: t.select(
        F.col(f"{p}_{k}").alias("id"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_acctbal").alias("balance")
    )
    return cleaning.union_all([named(s, "s", "suppkey"), named(c, "c", "custkey").select("name", "balance", "id")])


UNION_SQL = """select s_suppkey as id, s_name as name, s_acctbal as balance from supplier
    union all select c_custkey, c_name, c_acctbal from customer"""


def union_ragged(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    both = cleaning.union_all([s, c], ragged=True)
    return cleaning.with_missing_columns(both, {"status": "string", "name": "string"})


UNION_RAGGED_SQL = """select s_name as name, s_acctbal as balance, null::varchar as segment,
      null::varchar as status from supplier
    union all select c_name, null, c_mktsegment, null from customer"""


def sorted_columns(spark: SparkSession, folder: str) -> DataFrame:
    out = cleaning.sorted_columns(table(spark, folder, "supplier"))
    return out.withColumn("column_order", F.lit(",".join(out.columns)))


SORTED_COLUMNS_SQL = """select *, 's_acctbal,s_name,s_nationkey,s_suppkey' as column_order from supplier"""

_NUMBERS = ["quantity", "price", "discount", "tax", "fixed"]


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with gaps, and one column that does not vary."""
    li = table(spark, folder, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")).alias("price"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_tax") > 0.01, F.col("l_tax")).alias("tax"),
        F.lit(7.25).alias("fixed"),
        "l_returnflag",
    )


_NUMBERS_SQL = """n as (
      select case when l_returnflag <> 'A' then l_quantity end as quantity,
             case when l_linestatus <> 'O' then l_extendedprice end as price,
             l_discount as discount, case when l_tax > 0.01 then l_tax end as tax,
             7.25::double as fixed from lineitem)"""


def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.corr_matrix(cleaning.nan_to_null(_numbers(spark, folder)))
    # Adding 0.0 turns a rounded negative zero into zero.
    return out.withColumn("r", F.round("r", 6) + F.lit(0.0))


def _corr_sql() -> str:
    cells = []
    for a in _NUMBERS:
        for b in _NUMBERS:
            r = "max(null::double)" if "fixed" in (a, b) else f"round(corr({a}, {b}), 6) + 0.0"
            cells.append(f"select '{a}' as col_a, '{b}' as col_b, {r} as r from n")
    return f"with {_NUMBERS_SQL} " + " union all ".join(cells)


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    """Sixty columns over the line items: powers and shifts of four numbers, each with gaps of its own."""
    li = table(spark, folder, "lineitem")
    base = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return li.select(
        *[
            F.when((F.col("l_orderkey") + i) % (i + 2) != 0, F.pow(F.col(base[i % 4]), F.lit(1 + i // 4 / 8)) + i * 1000).alias(f"m{i:02d}")
            for i in range(60)
        ]
    )


def corr_wide(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.corr_matrix(_wide(spark, folder))
    return out.withColumn("r", F.round("r", 6) + F.lit(0.0))


def _wide_sql() -> str:
    base = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    cols = ", ".join(
        f"case when (l_orderkey + {i}) % {i + 2} <> 0 then pow({base[i % 4]}, {1 + i // 4 / 8}) + {i * 1000} end as m{i:02d}"
        for i in range(60)
    )
    cells = ", ".join(f"corr(m{i:02d}, m{j:02d}) as c_{i:02d}_{j:02d}" for i in range(60) for j in range(60))
    return f"""with n as (select {cols} from lineitem), c as (select {cells} from n),
      r as (unpivot c on columns(*) into name pair value r)
    select 'm' || pair[3:4] as col_a, 'm' || pair[6:7] as col_b, round(r, 6) + 0.0 as r from r"""


def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.box_stats(_numbers(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


BOX_SQL = f"""with {_NUMBERS_SQL},
    v as (unpivot n on {", ".join(_NUMBERS)} into name "column" value value),
    q as (select "column", count(*) as n, quantile_cont(value, 0.25) as q1,
                 quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3
          from v where value is not null group by "column"),
    f as (select v.*, q.* exclude ("column"),
                 value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
          from v join q using ("column") where value is not null)
    select "column", n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
      min(value) filter (inside) as whisker_low, max(value) filter (inside) as whisker_high,
      count(*) filter (not inside) as outliers
    from f group by all"""

CHECKS = {
    "parse_interval": (parse_interval, PARSE_INTERVAL_SQL),
    "timestamp_text": (timestamp_text, TIMESTAMP_TEXT_SQL),
    "try_parse": (try_parse, TRY_PARSE_SQL),
    "area_rules": (area_rules, AREA_RULES_SQL),
    "text_case": (text_case, TEXT_CASE_SQL),
    "format_report": (format_report, FORMAT_SQL),
    "json_props": (json_props, JSON_PROPS_SQL),
    "json_encode": (json_encode, JSON_ENCODE_SQL),
    "json_array_by_group": (json_array_by_group, JSON_ARRAY_SQL),
    "topic_route": (topic_route, TOPIC_SQL),
    "reject_split": (reject_split, REJECT_SQL),
    "union_all": (union_all, UNION_SQL),
    "union_ragged": (union_ragged, UNION_RAGGED_SQL),
    "sorted_columns": (sorted_columns, SORTED_COLUMNS_SQL),
    "corr_matrix": (corr_matrix, _corr_sql()),
    "corr_wide": (corr_wide, _wide_sql()),
    "box_stats": (box_stats, BOX_SQL),
}
