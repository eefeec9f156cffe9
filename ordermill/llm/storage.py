"""Intermediate results in the folder all machines share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import ordermill
from ordermill.sources.workspace import fresh_path


def kept(rows: DataFrame, label: str) -> DataFrame:
    """The rows written once below ``spark.checkpoint.dir`` and read back: later steps do not depend on executors."""
    path = fresh_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application; needed where executors do not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(ordermill.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="ordermill-ship-")) / "ordermill.zip"  # read by the driver alone, which serves it
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
