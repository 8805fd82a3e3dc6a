"""Sessions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors of a session, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidewell-ship-")) / "tidewell_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def local(cores: int = 8, name: str = "tidewell", **conf: str) -> SparkSession:
    """A session on this machine with UTC, adaptive plans and as many shuffle partitions as cores."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    base = {"spark.sql.shuffle.partitions": str(cores), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("TIDEWELL_DRIVER_MEMORY", "4g")}
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
