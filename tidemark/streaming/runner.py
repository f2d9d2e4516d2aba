"""Run a streaming frame over what is available and hand back its result table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.session import rocksdb_state, scratch_dir

END_OF_TIME = "2200-01-01 00:00:00"
R = TypeVar("R")
END_US = 7_258_118_400_000_000  # the same instant


def with_end_marker(spark: SparkSession, stream: DataFrame, ts: str) -> DataFrame:
    """Close a finite stream: one more row, far in the future and null elsewhere.

    It pushes the watermark past all windows and timers, which otherwise stay open
    when the input ends. For a replay read as one batch; see ``without_marker``.
    """
    path = scratch_dir(spark, "end-marker")
    marker(stream, ts).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))


def without_marker(df: DataFrame, at: str) -> DataFrame:
    return df.where(F.col(at) < F.lit(END_OF_TIME).cast("timestamp"))


def drain(query: StreamingQuery) -> None:
    """Finish all accepted input, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _start(stream: DataFrame, out: str, mode: str, available_now: bool, sink) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", f"{out}/checkpoint").outputMode(mode)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with rocksdb_state(stream.sparkSession):
        return sink(writer).start()


def _wait(query: StreamingQuery, available_now: bool) -> None:
    if available_now:
        query.awaitTermination()
    else:
        drain(query)


def run_append(
    stream: DataFrame, label: str, out: str | None = None, available_now: bool = True
) -> DataFrame:
    """Append-mode result, through a parquet sink in shared scratch space."""
    spark = stream.sparkSession
    out = out or scratch_dir(spark, label)
    query = _start(
        stream, out, "append", available_now, lambda w: w.format("parquet").option("path", f"{out}/rows")
    )
    _wait(query, available_now)
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def run_batches(
    stream: DataFrame, label: str, fn: Callable[[DataFrame, int, str], None], mode: str = "append",
    out: str | None = None, available_now: bool = True,
) -> str:
    """``fn(batch, batch_id, out)`` per micro-batch; gives the output folder."""
    out = out or scratch_dir(stream.sparkSession, label)
    query = _start(
        stream, out, mode, available_now,
        lambda w: w.foreachBatch(lambda df, batch_id: fn(df, batch_id, out)),
    )
    _wait(query, available_now)
    return out


def fed(
    spark: SparkSession, parts: Iterable[DataFrame], schema: T.StructType, label: str,
    run: Callable[[DataFrame, str], R],
) -> R:
    """Hand a recorded stream on part by part: each is appended to a folder, and ``run`` is given
    the stream of that folder and an output folder, both the same every time, and works off
    what is new. So every part is at least one micro-batch, and a query goes on from its
    checkpoint for each. The last result is returned."""
    path, out, result = scratch_dir(spark, f"{label}-in"), scratch_dir(spark, label), None
    for part in parts:
        part.write.mode("append").parquet(path)
        result = run(spark.readStream.schema(schema).parquet(path), out)
    return result


def marker(df: DataFrame, ts: str) -> DataFrame:
    """The end marker as a last part of a fed stream like ``df``."""
    cells = [
        (F.lit(END_OF_TIME).cast("timestamp") if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in df.schema.fields
    ]
    return df.sparkSession.range(1).select(*cells)


def state_of(spark: SparkSession, out: str, name: str | None = None) -> DataFrame:
    """What the query with output folder ``out`` holds in state after its last batch: the state
    variable ``name``, or the state of its only aggregate."""
    reader = spark.read.format("statestore")
    return (reader.option("stateVarName", name) if name else reader).load(f"{out}/checkpoint")


def run_sink(
    stream: DataFrame, label: str, sink: Callable[[DataStreamWriter], DataStreamWriter], out: str | None = None,
    mode: str = "append", available_now: bool = True,
) -> str:
    """Run into what ``sink`` makes of the writer; gives the folder of the checkpoint."""
    out = out or scratch_dir(stream.sparkSession, label)
    _wait(_start(stream, out, mode, available_now, sink), available_now)
    return out


def run_state(
    stream: DataFrame, label: str, mode: str = "update", out: str | None = None, available_now: bool = True,
) -> str:
    """Run a stateful frame for its state alone; gives the folder for ``state_of``."""
    return run_sink(stream, label, lambda w: w.format("noop"), out, mode, available_now)


def carried(spark: SparkSession, batch_id: int, out: str, name: str, ddl: str) -> Row | None:
    """The one row that the batch before left under ``name``, if there was one."""
    if not batch_id:
        return None
    return spark.read.schema(ddl).parquet(f"{out}/{name}/batch={batch_id - 1}").first()


def write_batch(df: DataFrame, batch_id: int, out: str, name: str = "rows") -> None:
    """A repeated batch overwrites its own folder, so a retry changes nothing."""
    df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")


def run_update(
    stream: DataFrame, label: str, keys: Sequence[str], out: str | None = None,
    available_now: bool = True, mode: str = "update",
) -> DataFrame:
    """The last row per key of an update-mode aggregate."""
    spark = stream.sparkSession
    out = run_batches(stream, label, write_batch, mode, out, available_now)
    log = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    return last_per_key(log, keys, "batch")


def last_per_key(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in log.columns if c not in (*keys, order)]
    last = F.max_by(F.struct(*rest), order).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, *[f"_last.{c}" for c in rest])
