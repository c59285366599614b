"""Getting this package to the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import cinderlake

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's files to the application, once, so that workers without an installed copy find it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(cinderlake.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cinderlake-"), "cinderlake.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
