"""Hourly consumption with its first known labels on a stream, corrected by late rows.

An hour and key is one state: the sum so far and, per label, the first known value with its place in arrival order. A timer
emits the hour once the stream's time has passed its end by ``settle``; a row that comes later emits the hour again under the next
revision, until the stream's time has passed its end by ``keep`` and the state is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vejrkraft.plans.panel import CONSUMPTION_LABELS

_HOUR = "hour"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HOUR_MS = 3_600_000


class HourlyLabels(StatefulProcessor):
    """State of one hour and key. ``settle_ms`` and ``keep_ms`` count from the end of the hour; the watermark lies ``keep_ms`` behind
    the latest time seen, so rows are not dropped as late before the state is."""

    def __init__(self, labels: Sequence[str], value: str, order: str, state: StructType, settle_ms: int, keep_ms: int):
        self.labels, self.value, self.order = list(labels), value, order
        self.state_type, self.settle_ms, self.keep_ms = state, settle_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("hour", self.state_type)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, revision, places, found = self._known()
        for part in rows:
            total += float(part[self.value].sum())
            for i, label in enumerate(self.labels):
                known = part[part[label].notna()]
                if len(known):
                    first = known.loc[known[self.order].idxmin()]
                    if places[i] is None or first[self.order] < places[i]:
                        places[i], found[i] = int(first[self.order]), first[label]
        end = self._end(key)
        watermark = timerValues.getCurrentWatermarkInMs()
        due = end + self.settle_ms - self.keep_ms
        settled = revision > 0 or due <= watermark
        revision += settled
        self.state.update((total, revision, *places, *found))
        self.handle.registerTimer(end)
        if settled:
            yield self._row(key, total, revision, found)
        else:
            self.handle.registerTimer(due)
            yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = pd.DataFrame()
        if expiredTimerInfo.getExpiryTimeInMs() >= self._end(key):
            self.state.clear()
        elif self.state.exists():
            total, revision, places, found = self._known()
            if revision == 0:
                self.state.update((total, 1, *places, *found))
                out = self._row(key, total, 1, found)
        yield out

    def close(self) -> None:
        pass

    def _known(self) -> tuple[float, int, list, list]:
        n = len(self.labels)
        if not self.state.exists():
            return 0.0, 0, [None] * n, [None] * n
        total, revision, *rest = self.state.get()
        return total, revision, list(rest[:n]), list(rest[n:])

    def _end(self, key) -> int:
        return int(pd.Timestamp(key[0]).tz_localize("UTC").timestamp() * 1000) + _HOUR_MS

    def _row(self, key, total: float, revision: int, found: list) -> pd.DataFrame:
        return pd.DataFrame({_HOUR: [key[0]], "key": [key[1]], "total": [total], "revision": [revision]} | {
            f"label_{i}": [v] for i, v in enumerate(found)
        })


def _ms(span: str, spark: SparkSession) -> int:
    """An interval text such as '2 hours' in milliseconds."""
    return int(spark.sql(f"select unix_millis(timestamp'1970-01-01 00:00:00Z' + interval {span}) as ms").first()["ms"])


def hourly_with_labels(
    stream: DataFrame,
    settle: str = "2 hours",
    keep: str = "30 days",
    time: str = "datetime",
    key: str = "municipality_code",
    value: str = "ConsumptionkWh",
    labels: Sequence[str] = tuple(CONSUMPTION_LABELS),
    order: str = "ord",
) -> DataFrame:
    """``consumption_hourly`` of a stream: hour, key, sum, first known labels by ``order``, and ``revision``.

    An hour comes out when the latest time seen is ``settle`` past its end, and again, as the next revision, with every batch that
    brings rows of it; ``last_revisions`` of what was landed is the table as known so far. Rows more than ``keep`` older than the latest
    time seen are late for good. Rows without a time or key are left out; a sum of nothing is 0. The state store must be RocksDB
    (``rocksdb_state``).
    """
    labels = list(labels)
    spark = stream.sparkSession
    types = {f.name: f.dataType for f in stream.schema}
    state = StructType(
        [StructField("total", DoubleType()), StructField("revision", IntegerType())]
        + [StructField(f"place_{i}", LongType()) for i in range(len(labels))]
        + [StructField(f"label_{i}", StringType()) for i in range(len(labels))]
    )
    hour_type = types[time]
    output = StructType(
        [StructField(_HOUR, hour_type), StructField("key", types[key])]
        + [StructField("total", DoubleType()), StructField("revision", IntegerType())]
        + [StructField(f"label_{i}", StringType()) for i in range(len(labels))]
    )
    known = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    # Labels travel as text: whole numbers with gaps would reach the processor as floating point.
    known = known.select(
        time,
        key,
        F.col(value).cast("double").alias(value),
        F.col(order).cast("long").alias(order),
        *[F.col(c).cast("string").alias(c) for c in labels],
    )
    hours = known.withWatermark(time, keep).withColumn(_HOUR, F.date_trunc("hour", time))
    processor = HourlyLabels(labels, value, order, state, _ms(settle, spark), _ms(keep, spark))
    out = hours.groupBy(_HOUR, key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )
    names = [F.col(f"label_{i}").cast(types[c]).alias(c) for i, c in enumerate(labels)]
    return out.select(F.col(_HOUR).alias(time), F.col("key").alias(key), F.col("total").alias(value), *names, "revision")


def last_revisions(emitted: DataFrame, time: str = "datetime", key: str = "municipality_code") -> DataFrame:
    """The latest row of every hour and key that a stream has emitted."""
    latest = Window.partitionBy(time, key).orderBy(F.desc("revision"))
    return emitted.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth", "revision")


class rocksdb_state:
    """While inside, streams of the session start with RocksDB as their state store."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)

    def __exit__(self, *_: object) -> None:
        self.spark.conf.set(_PROVIDER, self.before) if self.before else self.spark.conf.unset(_PROVIDER)
