"""Sends the package to the executors, as ``spark-submit --py-files`` does."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tierlake

NAME = "tierlake_py_files.zip"


def ship(spark: SparkSession) -> None:
    """Once per application: the driver serves a zip of the package's sources."""
    sc = spark.sparkContext
    if any(f.endswith(NAME) for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.abspath(tierlake.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tierlake-"), NAME)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
