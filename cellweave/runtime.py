"""Getting this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers whose PYTHONPATH does not name it: Spark serves them a copy."""
    root = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(":") or getattr(context, "_cellweave_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="cellweave-ship-")) / "cellweave_src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((root / "cellweave").rglob("*.py")):
            z.write(p, p.relative_to(root).as_posix())
    context.addPyFile(str(archive))
    context._cellweave_shipped = True
