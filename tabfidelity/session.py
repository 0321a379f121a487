"""Sessions, and the package on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def local_session(cpus: int = 8, partitions: int | None = None) -> SparkSession:
    """A local session with the settings that the tests and the benchmark share."""
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([str(ROOT), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabfidelity")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, where PYTHONPATH does not have it already: once an application."""
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or spark.sparkContext.applicationId in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp(prefix="tabfidelity-ship-")) / "tabfidelity.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "tabfidelity").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(spark.sparkContext.applicationId)
