"""The package on the executors, for functions that run there in Python."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    # Read by the driver alone, which hands it out.
    path = Path(tempfile.mkdtemp(prefix="namewake-package-"), "namewake_functions.zip")
    path.write_bytes(packed.getvalue())
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
