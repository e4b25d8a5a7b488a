"""Session set-up, table loading and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_own_dirs: dict[str, str] = {}


def local_session(app: str = "millrace", cores: str = "8") -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: there the driver
    and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="millrace-")
    return _own_dirs[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def planned_once(spark: SparkSession, tasks: int):
    """Plan each query inside once, with ``tasks`` tasks after a shuffle.

    For many short jobs over rows that are known to be few. Adaptive execution plans and reports each of
    them several times, to find a size that is known here; all of that is the driver's work and memory.
    """
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(tasks)}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives any executor, and fixes one
    outcome for plans that several branches read.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
