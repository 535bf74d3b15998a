"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows of a hot key are merged in each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
STATIC = {
    "spark.ui.enabled": "false",
    # Recording a call site for every Column call costs several gateway round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "viewtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **STATIC, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    """One process, whose folders all tasks see; a ``local-cluster`` has executors of its own."""
    return spark.sparkContext.master.partition("[")[0] == "local"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on to a session somebody else built.

    On a cluster the number of shuffle partitions is the operator's choice and is left alone; AQE merges small ones.
    In local mode the default of 200 only costs task start-up, so it follows the cores.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    ship_package(spark)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they would not find it by PYTHONPATH or their working folder.

    Spark itself distributes the archive to all executors; it is built and added once for each context.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd() if is_local(spark) else ""]
    if home in (os.path.abspath(p) for p in known if p) or getattr(sc, "_viewtide_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="viewtide-code-"), "viewtide")
    sc.addPyFile(shutil.make_archive(base, "zip", home, "viewtide"))
    sc._viewtide_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``; a temporary folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="viewtide-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's intermediate table, checkpoint or sink."""
    return f"{shared_root(spark)}/viewtide/{name}-{uuid.uuid4().hex}"
