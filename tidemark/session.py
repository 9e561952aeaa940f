"""Session defaults and the one place that decides where shared scratch data goes."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Runtime settings the operators rely on. Timestamps in the model are zone-free, so
# UTC only matters for values that arrive with a zone. The skew settings let AQE split a
# hot join key even when the join feeds an aggregation on the same key.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Static settings, taken when a session is created. Call-site capture costs a stack walk per
# column expression while a plan is built.
STATIC_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SQL_DEFAULTS, **STATIC_DEFAULTS}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per context: they need not share the driver's path."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return spark
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # else it already came in an archive
        archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
    context._tidemark_shipped = True
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the runtime defaults on a session somebody else created."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return ship_package(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir`` for data that must outlive executors.

    Where it is unset a scratch folder is made, in local mode only: on a cluster a machine-local
    folder would be lost with its machine, so that is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()
