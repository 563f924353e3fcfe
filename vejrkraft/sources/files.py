"""Delimited, zipped, NDJSON and Parquet inputs. A path is any URI the cluster can open."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vejrkraft.functions.numbers import to_number
from vejrkraft.operators.cleaning import union_all

_CHUNK_ROWS = 50_000


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; unreadable values, and NaN, become null."""
    cast = {
        c: to_number(c) if t == "double" else F.col(c).try_cast(t) for c, t in types.items() if c in df.columns
    }
    return df.withColumns(cast) if cast else df


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    sep: str = ",",
    numbered: bool = False,
    record: str | None = None,
) -> DataFrame:
    """Delimited files with a header, by column name. Columns without a type stay text.

    Several files must have the same columns, in any order. ``numbered`` adds ``ord``, which orders
    the rows as they stand in the file (for a single file). ``record`` names a column to add: the whole line where it has fewer or
    more fields than the header, else null (``split_records`` parts the two). Without it such lines are padded or cut.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    read = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    tables = [read.csv(p) for p in paths]
    if record:
        tables = [_with_record(read, p, t, record) for p, t in zip(paths, tables)]
    if numbered:
        # A large file is read in blocks, which need not be numbered in file order.
        place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        tables = [t.withColumn("ord", place) for t in tables]
    return with_types(union_all(tables), types or {})


def _with_record(read: DataFrameReader, path: str, table: DataFrame, record: str) -> DataFrame:
    """``table`` read again with its malformed lines. A line is only judged if all its fields are parsed."""
    if record in table.columns:
        raise ValueError(f"the files have a column {record!r}")
    schema = StructType([StructField(c, StringType()) for c in [*table.columns, record]])
    whole = read.schema(schema).option("columnNameOfCorruptRecord", record).option("columnPruning", False).csv(path)
    # Spark refuses to read the malformed lines alone, so they depend on the fields.
    fields = F.concat_ws("", *[F.col(f"`{c}`") for c in table.columns])
    return whole.withColumn(record, F.when(F.length(fields) >= 0, F.col(record)))


def split_records(df: DataFrame, record: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_csv(..., record=...)`` whose line has the width of the header, and the other lines."""
    good, bad = F.col(record).isNull(), F.col(record).isNotNull()
    return df.where(good).drop(record), df.where(bad).select(record)


class _Stored(io.RawIOBase):
    """A stored file as ``zipfile`` knows files: a place before its beginning is an OSError, also for an archive without entries."""

    def __init__(self, data: pa.NativeFile):
        self.data = data

    def readable(self) -> bool:
        return True

    seekable = readable

    def readinto(self, buffer) -> int:
        chunk = self.data.read(len(buffer))
        buffer[: len(chunk)] = chunk
        return len(chunk)

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.data.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def tell(self) -> int:
        return self.data.tell()


class _Entry(InputPartition):
    def __init__(self, archive: str, entry: str):
        super().__init__((archive, entry))


class _ZippedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.path, self.sep = options["path"], options.get("sep", ",")
        self.first = options.get("entries", "first") == "first"
        self.columns = [f.name for f in schema if f.name not in ("archive", "entry", "ord")]
        self.names = schema.names

    def partitions(self) -> list[_Entry]:
        """Only the directories of the archives are read here."""
        store, place = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(place)
        if found.type == fs.FileType.Directory:
            files = sorted(f.path for f in store.get_file_info(fs.FileSelector(place)) if f.is_file and not f.base_name.startswith(("_", ".")))
        else:
            files = [found.path]
        out = []
        for file in files:
            with store.open_input_file(file) as data, zipfile.ZipFile(io.BufferedReader(_Stored(data))) as z:
                names = [n for n in z.namelist() if not n.endswith("/")]
            out += [_Entry(file, n) for n in (names[:1] if self.first else names)]
        return out

    def read(self, partition: _Entry) -> Iterator[pa.RecordBatch]:
        archive, name = partition.value
        store, _ = fs.FileSystem.from_uri(self.path)
        with store.open_input_file(archive) as data, zipfile.ZipFile(io.BufferedReader(_Stored(data))) as z, z.open(name) as entry:
            for chunk in pd.read_csv(entry, sep=self.sep, dtype=str, chunksize=_CHUNK_ROWS):
                rows = {c: pa.array(chunk[c] if c in chunk else [None] * len(chunk), pa.string(), from_pandas=True) for c in self.columns}
                rows["archive"] = pa.array([archive] * len(chunk), pa.string())
                rows["entry"] = pa.array([name] * len(chunk), pa.string())
                rows["ord"] = pa.array(chunk.index, pa.int64())
                yield pa.RecordBatch.from_arrays([rows[n] for n in self.names], names=self.names)


class ZippedCsv(DataSource):
    """CSV entries of zip archives, one task per entry; an entry is unpacked as it is read, so it may be of any size."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZippedReader(self.options, schema)


def read_zipped_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    types: Mapping[str, str] | None = None,
    sep: str = ",",
    entries: str = "first",
) -> DataFrame:
    """The first entry (or, with ``entries="all"``, every one) of a zip archive or of each archive in a folder, by column
    name, with ``archive``, ``entry`` and ``ord``, the row's place in its entry.

    Each entry is read by a task of its own in chunks of 50,000 rows: packed data has no places to start from inside an entry.
    """
    spark.dataSource.register(ZippedCsv)
    schema = StructType([StructField(c, StringType()) for c in [*columns, "archive", "entry"]] + [StructField("ord", LongType())])
    packed = spark.read.format("zipped_csv").schema(schema).options(sep=sep, entries=entries).load(path)
    return with_types(packed, types or {})


def read_ndjson(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object per line, blank lines skipped; a bad line fails the query.

    Without a schema each document is one ``document`` column of variant type.
    """
    if schema is None:
        return spark.read.option("singleVariantColumn", "document").json(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)
