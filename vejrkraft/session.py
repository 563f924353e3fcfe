"""Session settings the package relies on."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Time columns are UTC everywhere; text without an offset is read as UTC.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Asked for when we build the session ourselves. A cluster's own settings win.
ADVISED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "vejrkraft", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADVISED_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and streaming state.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, where every
    executor sees the same disk, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vejrkraft-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results that are read several times: later passes scan only the columns they need, and lost
    executors never replay the inputs.
    """
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def staged_together(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """``staged`` copies of several tables, written side by side: one table's last tasks leave no core idle."""
    if len(frames) < 2:
        return [staged(f) for f in frames]
    checkpoint_dir(frames[0].sparkSession)
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(inheritable_thread_target(frames[0].sparkSession)(staged), frames))


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is rows of files or a range, filtered and projected at most: as cheap to read again as to copy."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except AttributeError:  # a session without a JVM of its own
        return False
    steps = (re.sub(r"^[\s:+|-]*", "", line) for line in plan.strip().splitlines())
    return all(re.match(r"(Relation|Project|Filter|Range|LocalRelation)\b", s) for s in steps)


def least_parallelism(spark: SparkSession) -> int | None:
    """The cores of the cluster if the shuffle partitions are set below them, else None."""
    cores = spark.sparkContext.defaultParallelism
    return cores if int(spark.conf.get("spark.sql.shuffle.partitions")) < cores else None
