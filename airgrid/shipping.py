"""The package's own code on the executors, wherever the driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for an application. A few small files."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="airgrid-"), "airgrid_source.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("airgrid", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)
