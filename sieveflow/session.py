"""Session helpers: a local session for tests and the bench, and the shared
folder used to cut lineage and hold intermediate tables.

Library code never invents a machine-local folder on a cluster: it reads
``spark.checkpoint.dir`` (or the SparkContext checkpoint dir). Only a
``local[...]`` master without that setting gets a temporary folder, which is
the test / laptop case. Intermediate tables lie in a folder of the application;
:func:`clear_scratch` deletes it when its results have been written.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "sieveflow", extra: dict | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a local session configured like a small cluster;
    ``checkpoint_dir`` names its folder for intermediate tables."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster for checkpoints.

    Read from ``spark.checkpoint.dir`` or the SparkContext setting; only a
    local master may fall back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder "
                "(HDFS/S3/ABFS) that all executors can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/sieveflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none when there is no such folder."""
    p, fs = _hadoop_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 when there is no such folder."""
    p, fs = _hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.mkdirs(p)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application. Results read from
    them lazily: write those first."""
    remove(spark, _scratch_root(spark))


def materialize(df, name: str, path: str | None = None):
    """Write ``df`` to the shared folder and read it back: cuts lineage,
    fixes nondeterministic columns (partition ids, sampled range bounds) for
    every later consumer, and survives the loss of any executor."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


#: rows of a file that a task may write several of: a file is read by one task as
#: long as it has one row group, so a large one would keep that task's share of the rows
FILE_ROWS = 1 << 17

#: Spark's bound of the bytes it hands to a Python worker at a time
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: a bound for whole texts: by its default Spark hands over 10,000 rows, up to 64 MB
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> str:
    """From now on this session hands at most about ``size`` bytes to a Python
    worker at a time, or as few as it did before; returns the setting before.
    The JVM and the worker each hold such a batch more than once."""
    before = spark.conf.get(_ARROW_BYTES)
    if not 0 < _bytes(before) <= size:
        spark.conf.set(_ARROW_BYTES, f"{size}b")
    return before


@contextmanager
def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """:func:`bound_batches` for what is written inside the block."""
    before = bound_batches(spark, size)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_BYTES, before)


#: about how many bytes a row of keys takes in a broadcast
KEY_ROW_BYTES = 100


def small_side(table: DataFrame, rows: int | None = None) -> DataFrame:
    """``table``, a written table of keys, as the side of a join that Spark may
    broadcast. Spark goes by the bytes of the files, and repeated values make
    these many times smaller than the rows that would pass through the driver:
    a table whose ``rows`` (counted if not given, from the files' footers) are
    beyond the session's broadcast threshold is joined by a shuffle."""
    limit = _bytes(table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    if limit < 0:
        return table
    return table.hint("merge") if (table.count() if rows is None else rows) * KEY_ROW_BYTES > limit else table


def _bytes(size: str) -> int:
    """Bytes of a size as settings have it: 64m, 10485760b, -1."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one when there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
