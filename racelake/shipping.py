"""Send the package to the Python workers, so that jobs run from any folder and on any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's modules to the session's Python files, once per application.

    Spark distributes them to every executor, the ones that join later included. Installing the wheel
    on all machines (see ``pyproject.toml``) does the same; then this call changes nothing.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="racelake-"), "racelake_modules.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, files in os.walk(package):
                for name in sorted(files):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
