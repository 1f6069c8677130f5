"""Session settings and the shared working folder."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

Result = TypeVar("Result")

# Runtime settings the joins rely on: a hot join key is split by AQE even when
# that costs one more exchange further up the plan.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Joins of sides that have been shuffled already: hashed, not sorted, where each partition of the
# side that is hashed turned out to have so many bytes at most. Others are sorted as before.
HASHED_PARTITIONS = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")


# The files of a query's shuffles are removed when it has ended. Else they stay until the driver
# happens to collect its garbage, and those of all tables of a load are on disk at once.
CLEANED_SHUFFLES = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
#: Codec of the Parquet files that the engine writes for itself: tables and working folders.
COMPRESSION = "zstd"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Let AQE hash small partitions in joins that run meanwhile; the setting is put back."""
    with _setting(spark, *HASHED_PARTITIONS):
        yield


@contextmanager
def cleaned_shuffles(spark: SparkSession) -> Iterator[None]:
    """Remove what queries that begin meanwhile have shuffled when they end; the setting is put back.

    A frame that is run again shuffles again.
    """
    with _setting(spark, *CLEANED_SHUFFLES):
        yield


def build_session(app_name: str = "zilverspoor", **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **RUNTIME_CONF,
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_test_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where driver and executors are one process (unit tests) a temporary
    folder stands in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _test_dirs:
        _test_dirs[app] = tempfile.mkdtemp(prefix="run-")
    return _test_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


@contextmanager
def working_folders() -> Iterator[list[str]]:
    """The folders that ``keep`` fills meanwhile, also in actions that run side by side."""
    folders: list[str] = []
    before = _kept.set(folders)
    try:
        yield folders
    finally:
        _kept.reset(before)


def drop_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove working folders; one that cannot be removed stays."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        try:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception as error:
            log.warning("%s stays: %s", folder, error)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one frame feeds several actions: later steps prune columns on the
    written table, and losing executors never recomputes what went before.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    if (folders := _kept.get()) is not None:
        folders.append(path)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_bytes(df: DataFrame) -> int:
    """Bytes that reading a frame takes, as Spark estimates them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Actions that read so many bytes for each core are small enough to run beside a large one.
SMALL_BYTES = 8 << 20


def small_bytes(spark: SparkSession) -> int:
    return SMALL_BYTES * spark.sparkContext.defaultParallelism


def together(
    spark: SparkSession,
    actions: Sequence[Callable[[], Result]],
    width: int = 4,
    weights: Sequence[int] | None = None,
) -> list[Result]:
    """Run independent Spark actions side by side and give their results in order.

    A small table's job then fills the cores a large one leaves idle. ``weights``
    are the bytes that the actions read: the heaviest start first, and beside the
    heaviest one that is running others run only while they read little
    (``small_bytes``), as the shuffles of all are on disk at once. The first error
    is raised once the actions already started have ended.
    """
    weights = list(weights or [0] * len(actions))
    room = small_bytes(spark) if any(weights) else 0
    waiting = sorted(range(len(actions)), key=lambda i: -weights[i])
    running: dict[Future, int] = {}
    results: dict[int, Result] = {}
    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        while waiting or running:
            for i in list(waiting):
                beside = [weights[j] for j in running.values()] + [weights[i]]
                if len(beside) <= max(1, width) and sum(beside) - max(beside) <= room:
                    waiting.remove(i)
                    action = inheritable_thread_target(spark)(actions[i])
                    running[pool.submit(copy_context().run, action)] = i
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for job in sorted(ended, key=running.__getitem__):
                results[running.pop(job)] = job.result()
    return [results[i] for i in range(len(actions))]
