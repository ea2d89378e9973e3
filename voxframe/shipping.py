"""Send this package to Python workers that can't import it from their own path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each application, unless the path has it."""
    package = Path(__file__).resolve().parent
    root, app = str(package.parent), spark.sparkContext.applicationId
    if app in _sent or root in os.environ.get("PYTHONPATH", "").split(":") or os.getcwd() == root:
        return
    target = Path(tempfile.mkdtemp(prefix="spark-ship-")) / "voxframe_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)
