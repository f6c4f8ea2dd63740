"""Sessions, and this package's code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors this package (once a Spark context), for clusters on which it isn't installed."""
    context = spark.sparkContext
    if not getattr(context, "_lingolake_shipped", False):
        root = Path(__file__).resolve().parent
        target = os.path.join(tempfile.mkdtemp(prefix="lingolake-"), "lingolake_code.zip")
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, f"{root.name}/{path.relative_to(root)}")
        context.addPyFile(target)
        context._lingolake_shipped = True
    if spark.conf.get(BATCH, "10000") == "10000":
        # texts are long: Spark's own default would be tens of megabytes a batch and more
        spark.conf.set(BATCH, "512")
    return spark


def session(app: str = "lingolake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())
