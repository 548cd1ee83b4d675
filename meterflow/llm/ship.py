"""Making the package importable in the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's modules along with the application, once per application, so that batches
    can be handled on nodes (or by workers) that do not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="meterflow-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
