"""Steps of a job that are written before the next one reads them."""

from __future__ import annotations

import gc
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft.session import checkpoint_dir


def drop_shuffles(spark: SparkSession) -> None:
    """Drop shuffle files of finished steps now, not at the driver's next garbage collection, so that the
    disk holds one step's files and not all."""
    gc.collect()
    spark._jvm.System.gc()


MOST_KEYS = 1 << 19
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_IN_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``TEXTS_IN_BATCH`` rows, unless the session asks for fewer: rows are whole texts here, and Spark's 10,000 of
    them would stand in memory several times on both sides."""
    if int(spark.conf.get(_BATCH_ROWS)) > TEXTS_IN_BATCH:
        spark.conf.set(_BATCH_ROWS, str(TEXTS_IN_BATCH))


def among(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is among the ``keys``, a table that is cheap to read. Up to ``MOST_KEYS`` keys, counted first, are
    broadcast (a few bytes each), so that the texts of ``df`` that are not wanted stay where they are."""
    few = keys.limit(MOST_KEYS + 1).count() <= MOST_KEYS
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


class Steps:
    """Tables in the shared folder that one operator writes for itself.

    ``result`` writes the operator's result and deletes the other tables: nothing refers to them any more.
    """

    def __init__(self, spark: SparkSession) -> None:
        small_batches(spark)
        self.spark = spark
        self.folders: list[str] = []

    def write(self, df: DataFrame, release: bool = False) -> DataFrame:
        folder = f"{checkpoint_dir(self.spark).rstrip('/')}/step-{uuid4().hex}"
        df.write.parquet(folder)
        self.folders.append(folder)
        out = self.spark.read.schema(df.schema).parquet(folder)
        if release:
            del df
            drop_shuffles(self.spark)
        return out

    def forget(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        gone = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for t in tables for f in t.inputFiles()}
        for folder in [f for f in self.folders if f.rsplit("/", 1)[-1] in gone]:
            self._delete(folder)

    def result(self, df: DataFrame) -> DataFrame:
        out = self.write(df)
        for folder in self.folders[:-1]:
            self._delete(folder)
        drop_shuffles(self.spark)
        return out

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.folders.remove(folder)


def step(df: DataFrame, release: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder that outlives its operator."""
    return Steps(df.sparkSession).write(df, release)
