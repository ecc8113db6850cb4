"""Session factory, shared-folder handling and small plan helpers.

Everything here is about running on a cluster whose executors may be lost at
any time: intermediate tables go to the folder named in
``spark.checkpoint.dir`` (shared by all executors), never to a machine-local
folder and never through ``localCheckpoint``.
"""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "millrace", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    ``master`` and ``shuffle_partitions`` are left to the cluster's defaults
    when not given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.

    Read from ``spark.checkpoint.dir``; only in local mode, where the setting
    may be absent, a temporary folder takes its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = "file://" + tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone already
        pass


def exists(spark: SparkSession, path: str, as_file: bool = False) -> bool:
    """Whether a path is there (as a plain file, if asked)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.exists(where) and (not as_file or files.getFileStatus(where).isFile()))


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate results when the Python process ends."""
    atexit.register(_remove, spark, path)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage durably (a lost executor costs nothing) and stores less
    than an RDD checkpoint, which is neither columnar nor compressed. The
    folder is removed when the Python process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete materialised tables (see :func:`materialise`) that nothing will read again.

    Also lets the driver collect its garbage, on which the shuffle files of
    the finished steps are removed; results must have been written before.
    """
    for df in tables:
        for folder in {os.path.dirname(x) for x in df.inputFiles()}:
            if os.path.basename(os.path.dirname(folder)) == "millrace":
                _remove(df.sparkSession, folder)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once a context.

    A zip of the sources is served by the driver; where the package is
    installed on the workers already, theirs is found first or is the same.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="millrace-")  # read by the driver's file server only
    atexit.register(shutil.rmtree, folder, True)
    name = os.path.join(folder, "millrace_sources.zip")
    with zipfile.ZipFile(name, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, Path(root.name) / source.relative_to(root))
    context.addPyFile(name)
    sys.path[:] = [x for x in sys.path if not x.endswith("millrace_sources.zip")]
    context._millrace_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One test-layout table: ``folder/name.parquet`` (file or directory)."""
    ship(spark)
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so extra or clashing ones cannot interfere."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def scan_slices(df: DataFrame, least: int | None = None) -> DataFrame:
    """Spread a scan that feeds costly Python work over all cores.

    A small table may arrive in a single split; only then is it reshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    want = least or cores
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def salt_of(key: Column, parts: int) -> Column:
    """A salt in ``[0, parts)`` from a well-mixed hash of ``key``."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
