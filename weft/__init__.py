"""weft: analytics on Spark DataFrames, SQL and Structured Streaming."""

from __future__ import annotations

import os
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])


def share_code(spark) -> None:
    """Puts this package's folder on the path of Python workers that start from now on. On a
    cluster where that folder isn't on the executors, pass the package with --py-files."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
