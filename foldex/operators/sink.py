"""Actions sent out of Spark as a data source writer, exactly once per batch.

Tasks write their action rows aside; when all have ended, the driver publishes the batch by one small file that names what
they wrote. Whatever a failed, repeated or aborted task left is named nowhere and never read. A batch that was published
before is not published again, so repeating an export after a failure sends nothing twice. Readers of the target, such as
a loader of a remote index, take the batches in order with ``sent_actions``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from foldex.plans.store import IndexStore
from foldex.sources.feed import opened

FORMAT = "action_batches"
ACTIONS = "index_name string, database string, collection string, uid string, action string, body string"


@dataclass
class Written(WriterCommitMessage):
    """A file that a task has written to its end."""

    name: str
    rows: int


class BatchWriter:
    """Writes batches below ``path``: ``rows/`` holds what tasks wrote, ``batches/`` names what counts."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = opened(self.path)
        system.create_dir(f"{root}/rows", recursive=True)
        name, rows = f"{uuid.uuid4().hex}.jsonl", 0
        with system.open_output_stream(f"{root}/rows/{name}") as file:
            for row in iterator:
                file.write(json.dumps(row.asDict(recursive=True), ensure_ascii=False).encode() + b"\n")
                rows += 1
        return Written(name, rows)

    def publish(self, messages: list[Written | None], number: int) -> None:
        system, root = opened(self.path)
        names = sorted(m.name for m in messages if m is not None and m.rows)
        target = f"{root}/batches/{number:020d}.json"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            self.discard(messages)
            return
        system.create_dir(f"{root}/batches", recursive=True)
        draft = f"{root}/rows/{uuid.uuid4().hex}.draft"
        with system.open_output_stream(draft) as file:
            file.write(json.dumps({"number": number, "files": names}).encode())
        system.move(draft, target)

    def discard(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        for message in messages:
            if message is not None:
                system.delete_file(f"{root}/rows/{message.name}")


class ActionWriter(DataSourceWriter):
    def __init__(self, path: str, number: int):
        self.batches, self.number = BatchWriter(path), number

    def write(self, iterator: Iterator[Row]) -> Written:
        return self.batches.write(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.batches.publish(messages, self.number)

    def abort(self, messages: list[Written | None]) -> None:
        self.batches.discard(messages)


class ActionStreamWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.batches = BatchWriter(path)

    def write(self, iterator: Iterator[Row]) -> Written:
        return self.batches.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.batches.publish(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.batches.discard(messages)


class ActionBatches(DataSource):
    """``action_batches``: a sink for batch jobs (option ``number``) and streams (the number of the micro-batch)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ActionWriter:
        return ActionWriter(self.options["path"], int(self.options["number"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> ActionStreamWriter:
        return ActionStreamWriter(self.options["path"])


def sent_batches(path: str) -> list[dict]:
    """The published batches in order: number and files."""
    system, root = opened(path)
    found = []
    for info in system.get_file_info(fs.FileSelector(f"{root}/batches", allow_not_found=True)):
        with system.open_input_stream(info.path) as file:
            found.append(json.loads(file.read()))
    return sorted(found, key=lambda b: b["number"])


def sent_actions(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """The action rows of the batches behind number ``after``, each with its ``number``."""
    named = [(b["number"], f"{path}/rows/{f}") for b in sent_batches(path) if b["number"] > after for f in b["files"]]
    if not named:
        return spark.createDataFrame([], f"{ACTIONS}, number bigint")
    rows = spark.read.schema(ACTIONS).json([p for _, p in named]).withColumn("_file", F.col("_metadata.file_name"))
    # One row per file of the batches asked for.
    numbers = spark.createDataFrame([(n, p.rsplit("/", 1)[1]) for n, p in named], "number bigint, _file string")
    return rows.join(numbers, "_file").drop("_file")


def export_changes(store: IndexStore, path: str, columns: Sequence[str] | None = None) -> int:
    """Sends the net changes since the version that was sent last; the number of a batch is the store's version.

    ``columns`` restricts the documents' fields.
    """
    store.spark.dataSource.register(ActionBatches)
    version = store.head().version
    last = max((b["number"] for b in sent_batches(path)), default=0)
    if version > last:
        actions = store.changes(last, version, columns)
        names = [f.split(" ")[0] for f in ACTIONS.split(", ")]
        actions.select(names).write.format(FORMAT).option("path", path).option("number", version).mode("append").save()
    return version
