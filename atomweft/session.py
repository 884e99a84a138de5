"""SparkSession factory with the settings the engine expects."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app: str = "atomweft", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. Cluster settings given outside (spark-submit, an existing session) are kept."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.enabled": "false"}
    if master and master.startswith("local"):
        settings |= {"spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"), "spark.sql.shuffle.partitions": str(shuffle_partitions or os.cpu_count() or 8)}
    elif shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers this package once per session, so that tasks can import it wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_atomweft_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="atomweft-")) / "atomweft.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    context._atomweft_shipped = True
