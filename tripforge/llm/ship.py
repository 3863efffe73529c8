"""Sending this package to the executors, whose Python workers run parts of it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import tripforge

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's source to the application once; Spark hands it to every executor."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(tripforge.__file__))
        # Only the driver reads this folder: Spark serves the archive from there.
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="tripforge-code-"), "tripforge"),
            "zip",
            os.path.dirname(package),
            os.path.basename(package),
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
