"""What Python workers need from the session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Put this package's place on the workers' path; where executors don't see it, ship the package with --py-files."""
    place = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if place not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (paths, place) if x)
