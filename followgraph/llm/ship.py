"""Make this package importable in the Python workers of any cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def package(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once for each Spark context
    (Spark serves the file from the driver, as with ``--py-files``)."""
    sc = spark.sparkContext
    if getattr(sc, "_followgraph_sent", False):
        return
    path = Path(tempfile.mkdtemp(prefix="followgraph-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    sc.addPyFile(str(path))
    sc._followgraph_sent = True
