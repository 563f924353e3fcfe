"""Documents and messages as streams: poll, publish, land, and run the batch steps on them."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from vejrkraft import fixed_values as fv
from vejrkraft.functions.documents import encode_json


_BAD = "_corrupt_record"


def settings(env: Mapping[str, str] = os.environ) -> dict[str, object]:
    """Source, topic, servers and poll interval from the environment."""
    topic = env.get("TOPIC", "weather")
    return {
        "source": env.get("API_URL"),
        "topic": topic,
        "servers": env.get("BOOTSTRAP_SERVERS", "localhost:9092").split(","),
        "poll_seconds": int(env.get("POLL_INTERVAL", fv.TOPICS.get(topic, fv.DEFAULT_POLL_SECONDS))),
    }


def route_topics(df: DataFrame, col: str, topics: Mapping[str, str]) -> DataFrame:
    """``topic`` by the value of ``col`` and the row as JSON ``value``. Rows without a topic are those of
    ``unrouted``."""
    routed = df.withColumn("topic", _topic(col, topics)).where(F.col("topic").isNotNull())
    return encode_json(routed, df.columns).select("topic", "value")


def _topic(col: str, topics: Mapping[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col(col) == k, F.lit(t)) for k, t in topics.items()])


def unrouted(df: DataFrame, col: str, topics: Mapping[str, str]) -> DataFrame:
    """The rows that ``route_topics`` sends nowhere."""
    return df.where(_topic(col, topics).isNull())


def stream_files(
    spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "json", **options: str
) -> DataFrame:
    """Landed documents as a stream, each file once."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def stream_topic(spark: SparkSession, servers: Sequence[str], topic: str, **options: str) -> DataFrame:
    """A Kafka topic from its beginning (needs the Kafka connector on the cluster)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(servers))
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def _payload(schema: StructType | str, fmt: str) -> Column:
    if fmt == "json":
        return F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro("value", schema, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def _meta(messages: DataFrame) -> list[str]:
    return [c for c in messages.columns if c in ("topic", "partition", "offset", "timestamp")]


def _parsed(messages: DataFrame, schema: StructType | str, fmt: str) -> DataFrame:
    """``_payload``, and ``_bad``: the payload is no document of the schema's form."""
    if fmt == "json":
        text = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        schema = f"{text}, {_BAD} string"
    parsed = messages.withColumn("_payload", _payload(schema, fmt))
    bad = F.col("_payload").isNull()
    if fmt == "json":
        bad = bad | F.col(f"_payload.{_BAD}").isNotNull()
    return parsed.withColumn("_bad", bad)


def decode(messages: DataFrame, schema: StructType | str, fmt: str = "json") -> DataFrame:
    """Message payloads as columns, next to topic, partition, offset and timestamp if present.

    Payloads that do not parse are those of ``undecoded``. ``fmt="avro"`` takes an Avro schema text
    and needs the Avro package on the cluster.
    """
    good = _parsed(messages, schema, fmt).where(~F.col("_bad"))
    out = good.select(*_meta(messages), "_payload.*")
    return out.drop(_BAD) if fmt == "json" else out


def undecoded(messages: DataFrame, schema: StructType | str, fmt: str = "json") -> DataFrame:
    """The messages that ``decode`` leaves out, as they came."""
    return _parsed(messages, schema, fmt).where("_bad").drop("_payload", "_bad")


def once_per_document(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a document polled again within ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def hourly_consumption(
    stream: DataFrame,
    delay: str,
    time: str = "datetime",
    key: str = "municipality_code",
    value: str = "ConsumptionkWh",
) -> DataFrame:
    """Sum per hour and key, each hour emitted once ``delay`` has passed over its end.

    Works on a batch as well, where every hour is emitted.
    """
    known = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return (
        known.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("hour"), key)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))
        .select(F.col("hour.start").alias(time), key, value)
    )


def open_hours(
    landed: DataFrame,
    emitted: DataFrame,
    time: str = "datetime",
    key: str = "municipality_code",
    value: str = "ConsumptionkWh",
) -> DataFrame:
    """Hours and keys of the landed rows that the stream has not emitted, or emitted without late rows.

    A batch pass over what has been landed: the last open hours, and hours whose sum has changed since.
    """
    whole = hourly_consumption(landed, "0 seconds", time, key, value)
    same = emitted.select(
        F.col(time).alias("_time"), F.col(key).alias("_key"), F.col(value).alias("_value")
    )
    match = (F.col(time) == F.col("_time")) & (F.col(key) == F.col("_key"))
    close = F.abs(F.col(value) - F.col("_value")) <= 1e-9 * F.greatest(F.abs(F.col(value)), F.lit(1.0))
    return whole.join(same, match & close, "left_anti")


def clean_batches(
    stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run a batch clean-up, whatever its joins and distinct steps, on every micro-batch of a stream.

    Each batch has its own folder, ``batch=<number>``, which a repeated batch overwrites.
    """

    def land_batch(batch: DataFrame, number: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def land(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a Parquet folder. ``every=None`` takes what is there and ends."""
    writer = (
        stream.writeStream.format("parquet")
        .option("compression", "snappy")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return trigger(writer, every).start(folder)


def publish(
    stream: DataFrame, servers: Sequence[str], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send ``(topic, value)`` rows to Kafka, at least once (needs the Kafka connector)."""
    writer = (
        stream.select("topic", F.col("value").cast("binary"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(servers))
        .option("kafka.retries", str(fv.SEND_RETRIES))
        .option("checkpointLocation", checkpoint)
    )
    return trigger(writer, every).start()
