"""Series as tables bucketed by their keys, which are aligned without moving them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft.session import staged

# The keys of a row as one text, equal for equal keys and never null: buckets and joins then agree on plain equality.
KEY = "_series_key"


def series_key(keys: Sequence[str]) -> Column:
    """Keys as text; nulls are marked, and texts carry their length, so different keys never make one text."""
    parts = []
    for k in keys:
        text = F.col(k).cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.length(text), F.lit(":"), text)))
    return F.concat_ws("|", *parts)


# A key with more rows is kept apart from the buckets, so that no bucket is one key's.
HOT_ROWS = 1_000_000


def write_series(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    path: str,
    buckets: int | None = None,
    hot_rows: int = HOT_ROWS,
    overwrite: bool = False,
) -> None:
    """Save ``df`` as ``table`` (its files under ``path``), cut into buckets by ``keys``.

    Rows of a key lie in one bucket of every table with the same number of buckets, so such tables are aligned by
    ``outer_align_series`` where they lie. The number of buckets (the shuffle partitions unless given) should suit the largest
    table, about 200 MB each. Keys of more than ``hot_rows`` rows go to a table of their own, ``<table>_hot``, which has no buckets.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = staged(df.withColumn(KEY, series_key(keys)))
    hot = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select(KEY)
    mode = "overwrite" if overwrite else "errorifexists"
    cold = keyed
    spark.sql(f"drop table if exists {table}_hot") if overwrite else None
    if hot.head(1):
        hot = staged(hot)
        cold = keyed.join(hot, KEY, "left_anti")
        keyed.join(hot, KEY, "left_semi").write.mode(mode).option("path", f"{path}_hot").saveAsTable(f"{table}_hot")
    # One file per bucket: rows go to the task that writes their bucket.
    laid = cold.repartition(buckets, KEY)
    writer = laid.write.mode(mode).format("parquet").option("path", path)
    writer.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)


def read_series(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame | None]:
    """The bucketed rows of a series, and those of its hot keys if it has any."""
    hot = f"{table}_hot"
    return spark.table(table), spark.table(hot) if spark.catalog.tableExists(hot) else None


def bucket_count(spark: SparkSession, table: str) -> int:
    """The buckets of a table, 0 if it has none or is not bucketed by the key text."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe formatted {table}").collect()}
    return int(said.get("Num Buckets") or 0) if KEY in (said.get("Bucket Columns") or "") else 0
