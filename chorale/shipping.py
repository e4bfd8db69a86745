"""The package for Python workers that do not have it installed."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from .staging import shared_folder, write_bytes


def ship(spark: SparkSession) -> None:
    """Give Python workers this package as an archive in the shared folder, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_chorale_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(write_bytes(spark, f"{shared_folder(spark)}/{package.name}-{uuid.uuid4().hex}.zip", [archive.getvalue()]))
    sc._chorale_shipped = True
