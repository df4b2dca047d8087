"""The package on the workers' path, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of the session's application, once.

    Where PYTHONPATH already names its folder, as on a cluster that installs it,
    there is nothing to do.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    if root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))):
        return
    folder = tempfile.mkdtemp(prefix="tidewright-ship-")
    path = os.path.join(folder, "tidewright_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(os.path.join(root, "tidewright")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
