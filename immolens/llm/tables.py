"""Reading the corpus tables and naming scratch data."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from immolens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of the cluster and read back: its
    lineage is cut, any executor can be lost afterwards, and later steps read
    one fixed result. A fresh folder is used for each call."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/immolens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers of this
    application, wherever the driver was started: its sources go to the
    executors once as a zip."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="immolens-ship-")) / f"{root.name}-src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
