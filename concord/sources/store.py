"""Intermediate tables in the folder that driver and executors share, and how long a table is worth a broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables of no more rows than this are sent to all tasks; longer ones are joined by shuffle.
SMALL_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a local folder is made, which only a local master may use."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows of a shuffle that a task takes at most, about.
TASK_ROWS = 250_000


def widen(spark: SparkSession, rows: int) -> None:
    """Raises the session's number of shuffle partitions (a setting that stays) to one for each TASK_ROWS of so many rows, so
    that a task's share of a shuffle fits its memory however long the input is. Adaptive execution puts small ones together."""
    wanted = -(-rows // TASK_ROWS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)


class Store:
    """Tables written once and read again. They cut lineage: a lost executor costs its running tasks only."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def put(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def drop(self, *stored: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for df in stored:
            remove(self.spark, df.stored_at)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, at = _fs(spark, path)
    fs.create(at, True).close()


#: The file that names the version of a published table which readers take.
POINTER = "_current"


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Writes df as a new version beside all earlier ones and then puts the pointer to it in place of the old one, by one
    rename. A reader sees the old table or the new one, whole; a writer that dies leaves the old one. Returns the version."""
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    _point(spark, path, version)
    return version


def _point(spark: SparkSession, path: str, version: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, staged = _fs(spark, f"{path}/{POINTER}.{version}")
    out = fs.create(staged, True)
    out.write(bytearray(version.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(staged), fs.makeQualified(_fs(spark, f"{path}/{POINTER}")[1]), how)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version, None before the first one."""
    fs, at = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return None
    source = fs.open(at)
    name = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return f"{path}/{name}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(found)


def published_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """The published versions' folders of the tables in a folder, by the tables' names."""
    fs, at = _fs(spark, folder)
    tables = [x.getPath() for x in fs.listStatus(at) if x.isDirectory()] if fs.exists(at) else []
    found = {x.getName(): current(spark, x.toString()) for x in tables}
    return {name: path for name, path in found.items() if path}


def prune(spark: SparkSession, path: str) -> list[str]:
    """Deletes versions other than the published one, left over or no longer read; returns their names."""
    held = current(spark, path)
    fs, at = _fs(spark, path)
    old = [x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory() and x.getPath().getName().startswith("v-")]
    old = [name for name in old if held is None or not held.endswith(name)]
    for name in old:
        remove(spark, f"{path}/{name}")
    return sorted(old)
