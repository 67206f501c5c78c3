"""Session settings that the library relies on, and shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def session(app: str = "tidemark", **settings: str) -> SparkSession:
    """A session with the library's settings; further ones as keyword arguments with _ for dots are not guessed, pass a dict."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | settings).getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a context, for Python workers that can't import it otherwise."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(to)  # the driver serves it; executors fetch it
    sc._tidemark_shipped = True
