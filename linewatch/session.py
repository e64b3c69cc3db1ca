"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "linewatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local session may fall back to a folder of
    its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_dir:
        _local_dir.append("file:" + tempfile.mkdtemp(prefix="linewatch-"))
    return _local_dir[0]


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one for a table or a stream checkpoint. All folders of a session lie in one, until
    :func:`release`."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete one folder of :func:`run_dir`. Tables that read it are void afterwards."""
    if not path.startswith(_session_dir(spark) + "/"):
        raise ValueError(f"{path} was not made by this session")
    _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete what this session has stored. Tables that read it are void afterwards."""
    _delete(spark, _session_dir(spark))


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(spark: SparkSession, df, name: str):
    """Write ``df`` to the shared folder and read it back, which cuts lineage and
    survives the loss of executors."""
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What each of a few steps returns, run side by side: jobs of short tables leave most of a cluster idle, and take as long as their planning. The first error is raised once all have
    ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        made = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [m.result() for m in made]
