"""Making this package importable on workers that don't have it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ensure_importable(spark: SparkSession) -> None:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.path.realpath(p or ".") for p in os.environ.get("PYTHONPATH", "").split(":")] + [os.getcwd()]
    sc = spark.sparkContext
    if root in paths or os.path.isdir("dossierforge") or getattr(sc, "_dossierforge_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "dossierforge"), "zip", root, "dossierforge"))
    sc._dossierforge_shipped = True
