"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.session import ensure_checkpoint_dir

# Characters that separate words: space, tab, newline, \v, \f, \r.
SEPARATORS = r"[\x20\x09-\x0D]+"

# Id lists up to this many rows (16 bytes each) may be broadcast; longer ones
# are joined with a shuffle.
BROADCAST_IDS = 1_000_000

# Stored tables of up to so many bytes may be broadcast.
BROADCAST_BYTES = 8 << 20

# Bytes of an Arrow batch sent to a worker, one text at least.
BATCH_BYTES = 32 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and empty texts give []."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts the lineage with files every executor sees."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Prepare a session for Python in tasks: bound the rows and bytes of an
    Arrow batch, so that long texts fit in a worker, and give workers this
    package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Add this package to the Python files of the session, once, unless
    workers find it on PYTHONPATH."""
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in on_path or getattr(sc, "_fitframe_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="fitframe-"), "fitframe.zip")  # on the driver, which serves it
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    sc._fitframe_shipped = True


def small(stored: DataFrame) -> DataFrame:
    """A broadcast hint for a table that ``keep`` stored, if its files have at
    most BROADCAST_BYTES, else the table as is.  Spark knows their size from
    listing them, so no job counts rows."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(stored) if size <= BROADCAST_BYTES else stored


def bounded(ids: DataFrame, n_rows: int) -> DataFrame:
    """A broadcast hint for an id list of checked length, else ``ids`` as is."""
    return F.broadcast(ids) if n_rows <= BROADCAST_IDS else ids
