"""Sends this package to the executors, for sessions whose Python workers cannot import it."""

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip to the session, once for each application. Spark's own file server
    hands it to the executors, so the zip itself only has to be on the driver."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    made = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(made)
    _sent.add(context.applicationId)
