"""Tables in the folder that driver and executors share: they cut lineage, and a lost executor costs nothing that it holds."""

from __future__ import annotations

import atexit
import contextlib
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset and all runs in one process, one of our own.

    On a cluster it must be set: a folder of the driver's machine would not be the executors'.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='strandwork-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/strandwork/{uuid.uuid4().hex}/{tag}"
    _WRITTEN.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written table through Spark's file system layer."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _WRITTEN:
        with contextlib.suppress(Exception):
            drop_path(spark, path)


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() gave, once all that reads them is written itself."""
    for df in tables:
        entry = (df.sparkSession, df.stored_at)
        with contextlib.suppress(ValueError):
            _WRITTEN.remove(entry)
        drop_path(*entry)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors by way of the shared folder, once for each application, so that its functions load there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    target = new_path(spark, f"{root.name}.zip")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    stream.write(data.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(target)
