"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Registers the package's source, once per application, with Spark, which hands it to every executor.

    Also makes batches for Python workers small, unless the session has set their size: whole texts may be long.
    """
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, "1000")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        archive.write(os.path.join(top, "__init__.py"), f"{os.path.basename(top)}/__init__.py")
        for name in sorted(os.listdir(package)):
            if name.endswith(".py"):
                archive.write(os.path.join(package, name), f"{os.path.basename(top)}/{os.path.basename(package)}/{name}")
    path = os.path.join(tempfile.mkdtemp(), "ledgerline_llm.zip")
    with open(path, "wb") as file:
        file.write(body.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
