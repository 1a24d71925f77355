"""This package for the Python workers of executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import scenlens

_shipped: dict[str, tempfile.TemporaryDirectory] = {}  # by application; removed when the driver ends


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(scenlens.__file__).resolve().parent
    folder = tempfile.TemporaryDirectory(prefix="scenlens-code-")
    target = Path(folder.name) / "scenlens.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped[context.applicationId] = folder
