"""Makes the package importable in the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, unless PYTHONPATH names it there already."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlane-"), "ledgerlane.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((root / "ledgerlane").rglob("*.py")):
            archive.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
