"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each Spark context, so that Python workers can import it
    wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfspark_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="shelfspark-source-")) / "shelfspark.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._shelfspark_shipped = True
