"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Runtime settings that change results, so they are the same everywhere.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON column may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session; returns the session."""
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up when the master itself is local.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    key = spark.sparkContext.applicationId
    if key not in _local_folders:
        _local_folders[key] = tempfile.mkdtemp(prefix="millrace-")
    return _local_folders[key]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, for the functions that run next to the data."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace-package")
    root, name = os.path.split(package)
    context.addPyFile(shutil.make_archive(archive, "zip", root, name))
    _shipped.add(context.applicationId)
