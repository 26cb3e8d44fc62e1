"""Session defaults and the folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

# A reducer of 64 MB keeps a symbol's sorted history and its window buffers well inside an
# executor core's share of memory; AQE merges smaller ones and splits larger ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sixty years of a symbol's trading days stay in the window's plain row buffer.
    "spark.sql.windowExec.buffer.in.memory.threshold": "16384",
    "spark.ui.enabled": "false",
    # Call sites on every column expression cost several driver round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_own_folder: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors are one process, may fall back to a
    temporary folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _own_folder:
        _own_folder[sc.applicationId] = tempfile.mkdtemp(prefix="tickerloom-")
    return _own_folder[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tickerloom/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Cuts lineage with a plain Parquet table: later passes read only the columns they need, and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """The file system that ``path`` is on, and the path as that file system takes it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def delete(spark: SparkSession, path: str) -> None:
    fs, location = hadoop(spark, path)
    fs.delete(location, True)


class Staging:
    """``stage`` for the length of a ``with`` block: its copies are deleted at the end, or on an error."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self._spark, name)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        for path in self._paths:
            delete(self._spark, path)
