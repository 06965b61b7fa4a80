"""Small files of a store: listing, reading, and publishing a name once, on any Hadoop file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if it is not there."""
    found, system = _path(spark, path)
    if not system.exists(found):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(found))


def complete(spark: SparkSession, path: str) -> list[str]:
    """The folders below a folder that a job has written to its end, in order, by one listing."""
    found, system = _path(spark, f"{path}/*/_SUCCESS")
    return sorted(entry.getPath().getParent().getName() for entry in system.globStatus(found) or [])


def read_text(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file under a name that must be new; false if someone else has published that name.

    The content is complete before the name appears: it is written aside and renamed without overwriting. Where a
    file system cannot rename without overwriting in one step (object stores), two writers at the same moment may both succeed.
    """
    found, system = _path(spark, path)
    draft, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else system.getUri(),
                                                            spark._jsc.hadoopConfiguration()).rename(draft, found, options)
    except Exception as error:  # noqa: BLE001 - py4j wraps every Java exception
        if "FileAlreadyExistsException" not in str(error):
            raise
        system.delete(draft, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    found, system = _path(spark, path)
    system.delete(found, True)
