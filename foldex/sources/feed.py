"""A change feed over rolling event files, as a Spark data source with positions to resume from.

Event files hold one JSON event per line and are read in the order of their names; the newest may still be written. A position
is a file and a byte in it, so a stream stops and resumes in the middle of a file, and only whole lines are read. What lies
between two positions is cut into byte ranges that tasks read by themselves.

A stream remembers its position in its checkpoint. ``maxBytesPerTrigger`` bounds a micro-batch; for that the source keeps the
positions that Spark has committed in the folder ``positions``, because Spark does not tell a source where a resumed stream
stands. With the trigger ``availableNow`` a bounded stream reads one such batch.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from foldex.sources.changes import EVENT_TYPES, parse_events

FORMAT = "rolling_events"
SCHEMA = "value string, file string, at bigint"
BLOCK = 1 << 16
#: Bytes of a task's range, and lines of a batch that a task hands to Spark.
SPLIT = 32 << 20
LINES = 5_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def line_end_after(system: fs.FileSystem, path: str, at: int, size: int) -> int:
    """The first byte at or after ``at`` at which a line begins, or the file's size."""
    with system.open_input_file(path) as file:
        at = max(0, at - 1)
        while at < size:
            found = file.read_at(min(BLOCK, size - at), at).find(b"\n")
            if found >= 0:
                return at + found + 1
            at += BLOCK
    return size


def last_line_end(system: fs.FileSystem, path: str, size: int) -> int:
    """The byte after the last line end; what follows is still being written."""
    with system.open_input_file(path) as file:
        end = size
        while end > 0:
            start = max(0, end - BLOCK)
            found = file.read_at(end - start, start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            end = start
    return 0


@dataclass
class Range(InputPartition):
    """Whole lines of a file: those that begin at ``start`` or later and before ``end``."""

    file: str
    start: int
    end: int


class FeedReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int | None, positions: str | None, split: int):
        if limit is not None and positions is None:
            raise ValueError("maxBytesPerTrigger needs a folder for positions")
        self.path, self.limit, self.positions, self.split = path, limit, positions, split
        self.at: dict | None = None

    # -- positions ------------------------------------------------------------------------------

    def files(self) -> list[tuple[str, int]]:
        system, root = opened(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        named = [(posixpath.basename(f.path), f.size) for f in found if f.type == fs.FileType.File]
        return sorted((n, s) for n, s in named if not n.startswith((".", "_")))

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def latestOffset(self) -> dict:
        """The end of what can be read now, or of the next bounded batch."""
        files = self.files()
        if not files:
            return self.at or self.initialOffset()
        system, root = opened(self.path)
        newest, size = files[-1]
        end = {"file": newest, "at": last_line_end(system, f"{root}/{newest}", size)}
        if self.limit is None:
            return end
        start = self.at or self.committed()
        left = self.limit
        for name, size in files:
            begin = start["at"] if name == start["file"] else 0
            if name < start["file"]:
                continue
            if size - begin > left:
                cut = {"file": name, "at": line_end_after(system, f"{root}/{name}", begin + left, size)}
                end = min(end, cut, key=lambda p: (p["file"], p["at"]))
                break
            left -= size - begin
        self.at = max(start, end, key=lambda p: (p["file"], p["at"]))
        return self.at

    def committed(self) -> dict:
        """The last position that Spark has told this source it is done with."""
        system, root = opened(self.positions)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        done = []
        for info in found:
            if info.path.endswith(".json"):
                with system.open_input_stream(info.path) as file:
                    done.append(json.loads(file.read()))
        return max(done, key=lambda p: (p["file"], p["at"]), default=self.initialOffset())

    def commit(self, end: dict) -> None:
        if self.limit is None:
            return
        system, root = opened(self.positions)
        system.create_dir(root, recursive=True)
        older = [f.path for f in system.get_file_info(fs.FileSelector(root))]
        name = f"{root}/{uuid.uuid4().hex}"
        with system.open_output_stream(name) as file:
            file.write(json.dumps(end).encode())
        system.move(name, f"{name}.json")
        for path in older:
            system.delete_file(path)

    # -- reading ----------------------------------------------------------------------------------

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, size in self.files():
            if start["file"] <= name <= end["file"]:
                first = start["at"] if name == start["file"] else 0
                last = min(size, end["at"]) if name == end["file"] else size
                out += [Range(name, at, min(at + self.split, last)) for at in range(first, last, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.path)
        path = f"{root}/{partition.file}"
        size = system.get_file_info(path).size
        at = partition.start if partition.start == 0 else line_end_after(system, path, partition.start, size)
        values, places = [], []
        with system.open_input_file(path) as file:
            file.seek(at)
            rest = b""
            while at < partition.end and (block := file.read(BLOCK * 16)):
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    if at >= partition.end:
                        break
                    if line.strip():
                        values.append(line.decode("utf-8", "replace"))
                        places.append(at)
                    at += len(line) + 1
                if len(values) >= LINES:
                    yield self._batch(partition.file, values, places)
                    values, places = [], []
            if at < partition.end and rest.strip():
                # The last line of a file that is complete, without a line end.
                values.append(rest.decode("utf-8", "replace"))
                places.append(at)
        if values:
            yield self._batch(partition.file, values, places)

    @staticmethod
    def _batch(file: str, values: list[str], places: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array([file] * len(values)), pa.array(places, pa.int64())], ["value", "file", "at"])


class RollingEvents(DataSource):
    """``rolling_events``: lines of the files below ``path``, with the file and the byte at which each begins."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> FeedReader:
        limit = self.options.get("maxBytesPerTrigger")
        return FeedReader(self.options["path"], int(limit) if limit else None, self.options.get("positions"), int(self.options.get("split", SPLIT)))


def feed_stream(spark: SparkSession, path: str, max_bytes: int | None = None, positions: str | None = None,
                event_types: Mapping[str, str] = EVENT_TYPES) -> DataFrame:
    """Change rows of a folder of rolling event files, as a stream that resumes where it stopped."""
    spark.dataSource.register(RollingEvents)
    options = {"path": path} | ({"maxBytesPerTrigger": str(max_bytes), "positions": positions} if max_bytes else {})
    return parse_events(spark.readStream.format(FORMAT).options(**options).load(), event_types=event_types)
