"""The package on executors that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the modules that tasks import to all executors, once in an application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="payloom-")) / "payloom_tasks.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
