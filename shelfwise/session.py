"""Session helpers: shipping this package to executors and scratch tables in the shared folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Bytes of an Arrow batch between the JVM and Python; both sides hold one or two of them per task.
BATCH_BYTES = 10 << 20
#: How much larger rows are in a hash table than in a file: columns that repeat are a byte a row there and a hundred here.
FILE_FACTOR = 50.0


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that UDF code imports there, and bound Arrow batches.

    ``spark.sql.execution.arrow.maxBytesPerBatch`` is set for the session where it still has Spark's own value; every
    operator that runs Python calls this, and a value that the caller set stays.
    """
    sc = spark.sparkContext
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's own setting
        spark.conf.set(key, str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shelfwise-"), "shelfwise.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.join("shelfwise", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def expand_estimates(spark: SparkSession) -> None:
    """Let Spark take a file's rows for larger than the file, so that it does not broadcast millions of them through the driver.

    ``spark.sql.sources.fileCompressionFactor`` is set for the session where it still has Spark's own value.
    """
    key = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(key)) == 1.0:  # Spark's own setting
        spark.conf.set(key, str(FILE_FACTOR))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows by columns over at least four tasks a core: a small file whose rows take long is one task else, and adaptive
    execution would join small partitions again."""
    spark = df.sparkSession
    expand_estimates(spark)
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *columns)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block; the value before it comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written whole to a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class Scratch:
    """Tables in a folder of their own under ``spark.checkpoint.dir``.

    Writing a table cuts lineage and survives lost executors.  The folder that the
    cluster names is used as it is; one is set only where the setting is empty.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        expand_estimates(spark)
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:  # no cluster named one: a folder of this process, gone when it ends
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="shelfwise-shared-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            base = f"file://{folder}"
            spark.conf.set("spark.checkpoint.dir", base)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
        #: With its scheme, so that code outside Spark finds the same file system.
        self.uri = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
        atexit.register(self._leave)

    def _leave(self) -> None:
        """Delete the folder when the driver ends, if its session still runs."""
        with contextlib.suppress(Exception):
            self.drop()

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; the shuffle files of writing it go at once."""
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more (all of them if none are named)."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for target in [self.path(n) for n in names] or [self.uri]:
            where = jvm.org.apache.hadoop.fs.Path(target)
            where.getFileSystem(conf).delete(where, True)
