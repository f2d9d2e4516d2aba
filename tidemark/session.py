"""Session settings and scratch space shared by the operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Event time is UTC everywhere, whatever zone the machines run in. No other setting
    is touched."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    Only a local session, such as a test's, may do without that setting; it then has a
    folder of its own until the process ends. Every executor of a cluster has to see the
    folder, so there it is an error to leave it out.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a finished table in shared scratch space: its lineage ends there, and
    several readers do not compute it again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside use the RocksDB state store."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)
