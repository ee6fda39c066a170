"""Make this package importable for Python workers that would not find it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Workers inherit PYTHONPATH and, in local mode, the working folder; where neither leads here, send the sources along."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    local = context.master.startswith("local[") or context.master == "local"
    on_path = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root) in on_path or (local and os.path.realpath(os.getcwd()) == str(root)) or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="salesmart-")) / "salesmart_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "salesmart").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
