"""Sinks that write by partition.

``parts`` is a data source whose tasks each write a file of their own, and whose rows are
there only from the commit on: the driver then lists the files of the tasks that have
succeeded. A task that fails, or is run twice, leaves a file that nothing lists, and a
batch of a stream that is repeated replaces its list.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


def _at(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


class _Parts:
    """What the batch and the stream writer have in common."""

    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, rows: Iterator[Row]) -> Part:
        files, root = _at(self.folder)
        # the name is new for each attempt, so that two of them cannot meet
        name, n = f"part-{uuid.uuid4().hex}.json", 0
        files.create_dir(root, recursive=True)
        try:
            with files.open_output_stream(f"{root}/{name}") as out:
                for row in rows:
                    out.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())
                    n += 1
        except BaseException:
            files.delete_file(f"{root}/{name}")
            raise
        return Part(name, n)

    def _list(self, label: str, messages: list[Part | None]) -> None:
        files, root = _at(self.folder)
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/list-{label}.json") as out:
            out.write(json.dumps([m.name for m in messages if m and m.rows]).encode())

    def _drop(self, messages: list[Part | None]) -> None:
        files, root = _at(self.folder)
        for m in messages:
            if m:
                files.delete_file(f"{root}/{m.name}")


class PartsWriter(_Parts, DataSourceWriter):
    def commit(self, messages) -> None:
        self._list(uuid.uuid4().hex, messages)

    def abort(self, messages) -> None:
        self._drop(messages)


class PartsStreamWriter(_Parts, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self._list(f"batch-{batchId}", messages)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class PartsSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parts"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return PartsWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return PartsStreamWriter(dict(self.options))


def write_parts(df: DataFrame, folder: str) -> None:
    """Append the rows of a finite frame to ``folder``, all or none of them."""
    df.sparkSession.dataSource.register(PartsSink)
    df.write.format("parts").option("path", folder).mode("append").save()


def read_parts(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """The rows of all finished writes to ``folder``."""
    lists = spark.read.text(f"{folder}/list-*.json", wholetext=True)
    names = sorted(name for row in lists.toLocalIterator() for name in json.loads(row[0]))
    if not names:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).json([f"{folder}/{name}" for name in names])


def write_rows(df: DataFrame, connect: Callable, write: Callable) -> None:
    """Rows to an outside system: one connection per partition.

    ``write(connection, row)`` must tolerate a repeat, since a lost task runs again.
    """

    def partition(rows) -> None:
        connection = connect()
        try:
            for row in rows:
                write(connection, row)
        finally:
            connection.close()

    df.foreachPartition(partition)
