"""A user-defined stream source: replays a table by ranges of a whole-number column.

Every micro-batch takes the next ``step`` values of the column. Its range is cut
into partitions, and each partition reads only its own part of the parquet files,
on an executor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.column = options["path"], options["column"]
        self.end = int(options["end"])
        self.step = int(options.get("step", "1000"))
        self.parts = int(options.get("partitions", "4"))
        self.columns = columns
        self.last = 0

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        self.last = min(self.last + self.step, self.end)
        return {"at": self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = start["at"], end["at"]
        self.last = max(self.last, high)
        cuts = [low + (high - low) * i // self.parts for i in range(self.parts + 1)]
        return [Range(a, b) for a, b in zip(cuts, cuts[1:]) if a < b] or [Range(low, high)]

    def read(self, partition: Range) -> Iterator:
        import pyarrow.dataset as ds

        at = ds.field(self.column)
        yield from ds.dataset(self.path).to_batches(
            columns=self.columns, filter=(at >= partition.low) & (at < partition.high)
        )

    def commit(self, end: dict) -> None:
        pass


class ReplaySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return self.options["ddl"]

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ReplayReader(dict(self.options), schema.names)


def replay_stream(
    spark: SparkSession, path: str, ddl: str, column: str, end: int, step: int, partitions: int = 4
):
    """Rows with 0 <= column < end, ``step`` values per micro-batch."""
    spark.dataSource.register(ReplaySource)
    return (
        spark.readStream.format("replay")
        .options(path=path, ddl=ddl, column=column, end=end, step=step, partitions=partitions)
        .load()
    )
