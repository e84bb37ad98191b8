"""Give the executors this package: the functions run there import it."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_LOCK = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application (``addPyFile``).

    Spark's own file server distributes the archive; it is written to the
    driver's temporary folder only to be handed over.
    """
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app in _SHIPPED:
            return
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="tessera-code-")
        archive = shutil.make_archive(os.path.join(folder, "tessera_code"), "zip",
                                      os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
