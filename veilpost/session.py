"""Session defaults, and the one shared folder for data that must outlive an executor."""

import os
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "veilpost", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution; on a cluster the submit settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed on every node or given as `--py-files`.
    """
    root = str(Path(__file__).resolve().parent.parent)
    settings = spark.sparkContext.environment
    paths = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        settings["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a local one is set up only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="veilpost-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside go when these end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder, used by one run only."""
    return os.path.join(shared_dir(spark), f"veilpost-{purpose}-{uuid.uuid4().hex}")


def drop_dir(spark: SparkSession, folder: str) -> None:
    """Delete a path that `fresh_dir` gave and nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
