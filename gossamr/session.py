"""Session helpers: a local session for tests and scripts, and tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of a side that may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, as tests and bench.py use it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gossamr")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


_SHIPPED: set[str] = set()
#: What bounds the memory of passes over texts, where the session does not say: rows and bytes of a batch that goes to
#: Python, rows that a Parquet reader decodes at a time.
BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application; it need not be installed there.

    Also keeps batches small, unless the session sets their size itself.
    """
    app = spark.sparkContext.applicationId
    for key, value in BOUNDS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if app in _SHIPPED:
        return
    top, folder = Path(__file__).parent, tempfile.mkdtemp(prefix="gossamr-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the file as long as it runs
    archive = f"{folder}/{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(top.rglob("*.py")):
            z.write(source, source.relative_to(top.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset on a local master (tests, one machine), one of our own.

    Any other master needs the setting: its executors do not see a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
        spark.sparkContext.setCheckpointDir(named)
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gossamr/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder of the shared file system that Spark has written to the end."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    own = [x.getPath() for x in files.listStatus(at) if x.isDirectory()]
    done = lambda x: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")
    return sorted(x.getName() for x in own if files.exists(done(x)))


def clean(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that were not written yet are lost with them."""
    delete(spark, f"{shared_dir(spark)}/gossamr/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, rows: int | None = None, rows_per_bucket: int = 500_000, least: int = 5_000_000) -> DataFrame:
    """A materialized table for many joins on key. From `least` rows on it is bucketed and sorted by the key, in the
    shared folder, so that those joins do not shuffle it again; a small one is written plainly.
    """
    if rows is None:
        df = materialize(df, name)
        rows = df.count()
    if rows < least:
        return df
    spark, table, n = df.sparkSession, f"gossamr_{name.replace('-', '_')}_{uuid.uuid4().hex}", min(20_000, max(1, rows // rows_per_bucket) + 1)
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read any more."""
    for top in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/gossamr/" in top:
            delete(df.sparkSession, top)


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes that a column's values take, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return 8 * F.greatest(F.size(name), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((_width(f"{name}.`{f.name}`", f.dataType) for f in kind), F.lit(8))
    return F.lit(8) if isinstance(kind, T.AtomicType) else F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16


def fits(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether df is small enough to broadcast, by its rows and their bytes.

    rows: their number, where it is known; rows of numbers alone then need no pass over df.
    """
    if rows is not None and (rows > limit or all(isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in df.schema)):
        return rows <= limit and 8 * rows * len(df.columns) <= most
    width = sum((_width(f"`{f.name}`", f.dataType) for f in df.schema), F.lit(0).cast("long"))
    n, size = df.agg(F.count("*"), F.sum(width)).first()
    return n <= limit and (size or 0) <= most


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if it fits(); else as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, rows, limit, most) else df
