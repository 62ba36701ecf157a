"""Give Python workers the package, wherever the driver imported it from."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per SparkContext.

    Spark sends the archive to executors itself, so workers need neither the
    driver's path nor a shared folder.
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    context._tidemark_shipped = True
