"""Messages handed to a receiver by the tasks, at least once, with a table of those it refuses.

``sender`` names a function as ``"module:function"`` that executors can import; it takes the options and returns an object with
``send(topic, value)`` and ``close()``. A receiver that will never take a message raises ``Refused``: the message becomes a dead letter. Any other
error is tried again and then fails the task, so that Spark repeats it: no message is lost, some may be sent twice.

Dead letters are written by the tasks, a file each, and count once the batch's commit lists the file. A repeated batch writes a new list
in place of the old one, so letters of attempts that failed never count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from vejrkraft import fixed_values as fv
from vejrkraft.sources.requests import _function
from vejrkraft.streaming.ingest import trigger

LETTERS = "topic string, value string, reason string"
COMMITS = "batch long, file string, sent long, refused long"


class Refused(Exception):
    """The receiver will never take this message."""


class FileSpool:
    """A receiver that keeps messages as JSON lines, a file per task, in the folder ``spool``; messages of more than ``max_bytes`` are refused."""

    def __init__(self, options: Mapping[str, str]) -> None:
        store, folder = fs.FileSystem.from_uri(options["spool"])
        store.create_dir(folder)
        self.most = int(options.get("max_bytes", 1 << 20))
        self.out = store.open_output_stream(f"{folder}/{uuid4().hex}.json")

    def send(self, topic: str, value: str) -> None:
        if len(value.encode()) > self.most:
            raise Refused("message too large")
        self.out.write(json.dumps({"topic": topic, "value": value}).encode() + b"\n")

    def close(self) -> None:
        self.out.close()


@dataclass
class _Sent(WriterCommitMessage):
    file: str | None
    sent: int
    refused: int


class _Delivery:
    """What the batch and the stream writer share."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = dict(options)
        self.folder = options["dead_letters"]
        self.attempts = 1 + int(options.get("retries", fv.SEND_RETRIES))

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        receiver = _function(self.options["sender"])(self.options)
        letters, name, sent, refused = None, None, 0, 0
        try:
            for row in iterator:
                reason = self._send(receiver, row["topic"], row["value"])
                if reason is None:
                    sent += 1
                    continue
                refused += 1
                if letters is None:
                    store, folder = self._place("letters")
                    name = f"{uuid4().hex}.json"
                    letters = store.open_output_stream(f"{folder}/{name}")
                letter = {"topic": row["topic"], "value": row["value"], "reason": reason}
                letters.write(json.dumps(letter).encode() + b"\n")
        finally:
            receiver.close()
            if letters is not None:
                letters.close()
        return _Sent(name, sent, refused)

    def _send(self, receiver, topic: str, value: str) -> str | None:
        """Why the receiver refuses the message, None if it has it."""
        if topic is None or value is None:
            return "no topic" if topic is None else "no value"
        for left in range(self.attempts, 0, -1):
            try:
                receiver.send(topic, value)
                return None
            except Refused as e:
                return str(e) or "refused"
            except Exception:
                if left == 1:
                    raise
        return None

    def _place(self, part: str) -> tuple[fs.FileSystem, str]:
        store, folder = fs.FileSystem.from_uri(f"{self.folder.rstrip('/')}/{part}")
        store.create_dir(folder)
        return store, folder

    def record(self, part: str, name: str, messages: list, batch: int) -> None:
        self._place("letters")
        store, folder = self._place(part)
        lines = [
            json.dumps({"batch": batch, "file": m.file, "sent": m.sent, "refused": m.refused}) for m in messages if m is not None
        ]
        with store.open_output_stream(f"{folder}/{name}.json") as out:
            out.write("".join(line + "\n" for line in lines).encode())


class _StreamWriter(_Delivery, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.record("commits", f"batch-{batchId}", messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.record("aborts", f"batch-{batchId}-{uuid4().hex}", messages, batchId)


class _BatchWriter(_Delivery, DataSourceWriter):
    def commit(self, messages: list) -> None:
        self.record("commits", f"run-{uuid4().hex}", messages, -1)

    def abort(self, messages: list) -> None:
        self.record("aborts", f"run-{uuid4().hex}", messages, -1)


class Messages(DataSource):
    """The sink ``messages`` for rows of (topic, value)."""

    @classmethod
    def name(cls) -> str:
        return "messages"

    def schema(self) -> str:
        return "topic string, value string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(self.options)


def _texts(messages: DataFrame) -> DataFrame:
    messages.sparkSession.dataSource.register(Messages)
    return messages.select(F.col("topic").cast("string").alias("topic"), F.col("value").cast("string").alias("value"))


def send_stream(
    messages: DataFrame, sender: str, dead_letters: str, checkpoint: str, every: str | None = None, **options: str
) -> StreamingQuery:
    """Send (topic, value) rows of a stream. ``every=None`` takes what is there and ends."""
    writer = _texts(messages).writeStream.format("messages").option("checkpointLocation", checkpoint)
    writer = writer.options(sender=sender, dead_letters=dead_letters, **options)
    return trigger(writer, every).start()


def send_batch(messages: DataFrame, sender: str, dead_letters: str, **options: str) -> None:
    """Send (topic, value) rows of a table. Run again, it sends all of them again."""
    writer = _texts(messages).write.format("messages").mode("append")
    writer.options(sender=sender, dead_letters=dead_letters, **options).save()


def deliveries(spark: SparkSession, dead_letters: str) -> DataFrame:
    """One row per task of every committed batch: batch (-1 for tables), file of dead letters (or null), sent, refused."""
    return spark.read.schema(COMMITS).json(f"{dead_letters.rstrip('/')}/commits")


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """topic, value, reason of the messages refused in committed batches."""
    letters = spark.read.schema(LETTERS).json(f"{folder.rstrip('/')}/letters")
    named = letters.select("*", F.col("_metadata.file_name").alias("_file"))
    listed = deliveries(spark, folder).where("file is not null").select(F.col("file").alias("_file"))
    return named.join(listed, "_file", "left_semi").drop("_file")
