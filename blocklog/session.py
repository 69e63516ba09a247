"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_root: str | None = None


def local_session(cpus: int | str = "*", app: str = "blocklog", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    n = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``. A temporary folder is used only by
    a local master that sets none; a cluster without the setting is refused, because a folder of one
    machine would be lost with it.
    """
    global _local_root
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="blocklog-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a new table. Hashes in hex digits, which fill most of these tables, take half the room with zstd."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema; unlike a list without rows it starts no Python in the tasks."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class Staging:
    """Writes intermediate tables as Parquet in the shared folder and reads them back.

    This cuts the lineage, so an executor lost later does not repeat the work. Reading back also gives
    the planner the real size of the table: a join with it is broadcast only when it is small.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/stage-{uuid.uuid4().hex}"
        self._count = 0
        self._paths: dict[str, list[str]] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self._count:03d}-{name}"
        self._count += 1
        self._paths.setdefault(name, []).append(path)
        write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_table(self, name: str) -> None:
        """Delete the tables written under a name; what still reads them must be written first."""
        for path in self._paths.pop(name, []):
            delete_path(self.spark, path)

    def drop(self) -> None:
        """Delete the tables of this stage; results that still read them must be written first."""
        delete_path(self.spark, self.root)


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, folders are listed by four tasks for each core at most, in place of one for each folder up to 10,000.

    A folder is listed in about a millisecond, so with one to a task nearly all of the time goes to starting tasks.
    """
    before = spark.conf.get(_LISTING_TASKS, None)
    most = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set(_LISTING_TASKS, str(most if before is None else min(int(before), most)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LISTING_TASKS)
        else:
            spark.conf.set(_LISTING_TASKS, before)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, empty if it does not exist."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def file_version(spark: SparkSession, path: str) -> tuple[int, int]:
    fs, hadoop_path = _fs(spark, path)
    status = fs.getFileStatus(hadoop_path)
    return status.getModificationTime(), status.getLen()


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)
