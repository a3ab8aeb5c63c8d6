"""A session with what the results depend on: UTC, ANSI and adaptive execution; and the folder that its machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "siftline", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset and the executors run on the
    driver's own machine, a new one there. On a cluster there has to be one."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: driver and executors share no folder")
        where = "file://" + tempfile.mkdtemp(prefix="siftline-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(where)
    return where


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
