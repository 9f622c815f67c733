"""Session defaults and the shared work area for materialised intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_dirs: dict[str, str] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(app: str = "corpusloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are planned for.

    Adaptive execution does the run-time work: it splits hot partitions of
    joins and of rebalanced writes, and turns small joins into broadcasts by
    measured size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return _local_dirs[app]


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    On a cluster the package is installed or sent with the job; in a session of one
    machine it may lie anywhere, and the working folder need not be its own.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


# Spark counts 4 MB for opening a file, which makes a task, and a file of its results, for
# every 32 small ones; it takes 64 MB of shuffled rows for a task, which are millions of rows
# of a few numbers; and it takes a table for as large as its files, so that millions of
# author rows, which lie in less than 10 MB, would be broadcast. More than 32 folders, as
# every table has after as many loads, or named files are listed in a task each.
_EVEN_TASKS = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.files.openCostInBytes": str(128 << 10),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
    "spark.sql.sources.fileCompressionFactor": "16.0",
}


@contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for the jobs run in here."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def even_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs run in here read up to 1,000 small files in a task, share rows of few bytes over
    more tasks and broadcast only what is small in memory."""
    with conf_set(spark, _EVEN_TASKS):
        yield


def side_by_side(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run jobs that do not need each other: small ones wait for the driver most of the time."""
    with ThreadPoolExecutor(8) as threads:
        begun = [threads.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in begun:
        job.result()


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of `schema`, known to be empty when a plan is optimised."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns).limit(0)


class Workspace:
    """Intermediate tables of one job, written so that lost executors cost
    a re-read instead of a recomputation, and so that later joins see real
    sizes when Spark decides whether a side may be broadcast.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
        self._saved: list[tuple[str, DataFrame]] = []
        self._count = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self._count:02d}-{name}"
        self._count += 1
        df.write.mode("errorifexists").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._saved.append((path, table))
        return table

    def release(self, *tables: DataFrame) -> None:
        """Free the space of saved tables whose results are saved themselves."""
        freed = [s for s in self._saved if any(s[1] is t for t in tables)]

        def free(path: str, table: DataFrame) -> None:
            empty_frame(self.spark, table.schema).write.mode("overwrite").parquet(path)

        side_by_side(self.spark, *[partial(free, *one) for one in freed])
        self._saved = [s for s in self._saved if not any(s[1] is t for t in tables)]

    def clear(self) -> None:
        """Free the space of all saved tables; frames built on them end here."""
        self.release(*[table for _, table in self._saved])
