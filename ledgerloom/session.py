"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Runtime SQL settings.  A join on a hot key is split even where the split costs one more
# exchange, so a key that holds a third of all rows does not end up in one task.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings for whoever builds the session: Python call sites are not recorded for every
# column expression, which makes wide plans several times faster to build.
BUILD_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers of a cluster need not have it installed; ``spark-submit --py-files`` would do the same.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(here)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, here)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to the session and make the package known to its workers."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Without that setting a session of one machine gets a temporary folder, and a cluster an error.
    """
    return f"{_shared_base(spark)}/{uuid.uuid4().hex}"


def stable_folder(spark: SparkSession, *parts: str) -> str:
    """The same path below the shared folder for the same parts, in every attempt of a job."""
    return "/".join([_shared_base(spark), *parts])


_local_bases: dict[str, str] = {}


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _local_bases.setdefault(app, tempfile.mkdtemp(prefix="ledgerloom-"))
    return base.rstrip("/")
