"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
#: For each open ``scratch`` the folders to delete at its end.
_SCRATCH: list[list[str]] = []


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the job's own session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a fresh
    temporary folder. On a cluster a machine-local folder would be lost with
    its machine, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_BASE:
        _LOCAL_BASE[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_BASE[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``settle`` wrote inside, but for ``lasting`` tables.

    No frame that still has to be computed may read one of them.
    """
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield
    finally:
        _SCRATCH.pop()
        for path in paths:
            delete_folder(spark, path)


def outlast() -> None:
    """Hand the table that ``settle`` wrote last to the scratch around the innermost one, if there is one."""
    path = _SCRATCH[-1].pop()
    if len(_SCRATCH) > 1:
        _SCRATCH[-2].append(path)


def settle(df: DataFrame, name: str = "settled", lasting: bool = False) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    For the result of a long plan that the next step reads several times: the
    plan runs once, and a lost executor costs a read of the written table. Inside
    ``scratch`` the table goes with it, unless it is ``lasting``: then it goes with
    the scratch around that one, if there is one.
    """
    path = new_folder(df.sparkSession, name)
    owners = _SCRATCH[:-1] if lasting else _SCRATCH
    if owners:
        owners[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
