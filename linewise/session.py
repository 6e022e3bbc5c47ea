"""Session settings, shipping the package to the executors, and cutting lineage."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "linewise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    Nothing here fixes a partition count for production: AQE sizes shuffles by bytes
    and splits skewed join sides at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_shipped: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Sends this package's own modules to the executors, once per application, so that
    Python workers can import them. Nothing is done when it already runs from an archive
    (``--py-files``) or there is no session yet."""
    session = spark or SparkSession.getActiveSession()
    here = os.path.dirname(os.path.abspath(__file__))
    if session is None or not os.path.isdir(here) or session.sparkContext.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="linewise-"), "linewise.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(here):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(here)))
    session.sparkContext.addPyFile(archive)
    _shipped.add(session.sparkContext.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: the one ``spark.checkpoint.dir`` names. Where the
    session names none, a private one is set on one machine, and a cluster is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not configured and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="linewise-checkpoints-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that lost executors can re-read it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
