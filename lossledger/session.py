"""Session defaults and the shared folder where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lossledger.sources import files

# Partitions that an exchange begins with, and the size up to which they are joined or files cut.
PARTITIONS, PARTITION = "400", "8m"
# Bytes of input from which on that is so: below, a task holds few rows anyway.
LARGE = 100_000_000

_ONCE: dict[tuple, object] = {}
_SCOPES: list[list[str]] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lossledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Xss8m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Settings this library relies on; all can be set on a running session.

    Loan dates are UTC. Cleaning projects some sixty expressions at once: fused into one method
    that exceeds the size the JVM compiles, so such plans fall back to smaller methods. The same
    rows are expensive per byte, so small exchanges are kept apart for more parallel tasks.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    return spark


def bounded(spark: SparkSession, folder: str) -> SparkSession:
    """With ``LARGE`` bytes of order lines or more, the largest input, exchanges begin with many
    partitions, which Spark joins up to ``PARTITION``, and files are read in parts of that size. What
    a task sorts or groups then does not grow with the tables, so it need not spill. A session's own
    settings of the three stay; smaller inputs are read with what the session has."""
    large = files.size(spark, f"{folder}/lineitem.parquet") >= LARGE
    # Which of them were set here, so that only these are taken back for a small input.
    ours = (spark.conf.get("spark.lossledger.bounded", None) or "").split()
    for key, value in (("spark.sql.adaptive.coalescePartitions.initialPartitionNum", PARTITIONS),
                       ("spark.sql.adaptive.advisoryPartitionSizeInBytes", PARTITION),
                       ("spark.sql.files.maxPartitionBytes", PARTITION)):
        if large and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            ours.append(key)
        elif not large and key in ours:
            spark.conf.unset(key)
            ours.remove(key)
    spark.conf.set("spark.lossledger.bounded", " ".join(ours))
    return spark


def cores(spark: SparkSession) -> tuple[int, int]:
    """The cores of all executors, and of one."""
    context = spark.sparkContext
    total = context.defaultParallelism
    if context.master.split("[")[0] == "local":
        return total, total
    told = context.getConf().get("spark.executor.cores")
    executors = max(1, context._jsc.sc().getExecutorMemoryStatus().size() - 1)
    return total, int(told) if told else max(1, total // executors)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster a folder of one
    machine would lose tables together with that machine, so there the setting is required.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.master.startswith("local") and named.startswith("file:"):
            raise RuntimeError("spark.checkpoint.dir names a folder of one machine")
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lossledger-")
    context.setCheckpointDir(folder)
    return (context.getCheckpointDir() or folder).rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lossledger-{app}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage durably (a lost executor costs no recomputation), and the reader knows
    the true size of the files, so that Catalyst's own broadcast threshold decides each join on a
    proven size instead of on a hint.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    for scope in _SCOPES:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, through the folder's own file system, what was staged meanwhile. Only
    for work whose results are written elsewhere."""
    scope: list[str] = []
    _SCOPES.append(scope)
    try:
        yield
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not scope]
        for path in scope:
            files.delete(spark, path)


def leaves_nothing(step: Callable) -> Callable:
    """For a step of a batch, called with the session first, whose results are written tables:
    what it stages is deleted at its end, after an error too."""
    @wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        with temporary_stages(spark):
            return step(spark, *args, **kwargs)

    return run


def once(spark: SparkSession, label: str, folder: str, build: Callable[[], object]):
    """``build()`` once per application and state of the input files in ``folder``."""
    key = (spark.sparkContext.applicationId, label, folder, files.fingerprint(spark, folder))
    if key not in _ONCE:
        _ONCE[key] = build()
    return _ONCE[key]


def built(spark: SparkSession, label: str, folder: str):
    """What ``once`` has built for this state of the input, or None."""
    return _ONCE.get((spark.sparkContext.applicationId, label, folder,
                      files.fingerprint(spark, folder)))


def side_by_side(*builds: Callable[[], object]) -> list:
    """The results of ``builds``, whose Spark jobs share the cluster."""
    with ThreadPoolExecutor(len(builds)) as pool:
        return [job.result() for job in [pool.submit(build) for build in builds]]


def clear_staged(spark: SparkSession) -> None:
    """Delete the tables this application has staged."""
    app = spark.sparkContext.applicationId
    files.delete(spark, f"{shared_folder(spark)}/lossledger-{app}")
    for key in [k for k in _ONCE if k[0] == app]:
        del _ONCE[key]
