"""Session settings the operators are tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings that matter to the plans. AQE coalesces small shuffle partitions,
#: splits skewed join partitions and turns a sort-merge join into a broadcast
#: join once the measured side is small, so no operator carries a fixed
#: broadcast hint. ``forceOptimizeSkewedJoin`` lets it split a hot key even if
#: that costs one more shuffle.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM interprets methods above 8,000 bytes, so a stage whose generated code
    # has one runs operator by operator, in methods that are small enough to compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables of some thousand folders are listed by few tasks instead of one a folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Without the call site of every column expression plans build much faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Bytes a task should handle: small enough to sort in memory beside its
#: neighbours, large enough that files and tasks stay few.
TASK_BYTES = 256 * 1024**2

def sizing_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Task sizes for a job that reads about ``input_bytes`` on ``cores`` cores.

    The partition count is where AQE starts from; it merges what turns out small.
    """
    wanted = -(-input_bytes // TASK_BYTES)
    partitions = max(wanted, cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    }


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with :data:`ENGINE_CONF`; ``extra`` wins over it.

    ``master`` is left unset on a cluster, where the submitter names it.
    Keyword names use ``__`` for the dots of a setting; :func:`sizing_conf`
    gives the settings for a job's size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(ENGINE_CONF)
    settings.update({name.replace("__", "."): value for name, value in extra.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Settings of a running session that the plans rely on, for hot keys above all.
SKEW_CONF = (
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
)


def enable_skew_handling(spark: SparkSession) -> SparkSession:
    """Turn on run-time splitting of hot keys in a session built elsewhere."""
    for name in SKEW_CONF:
        spark.conf.set(name, ENGINE_CONF[name])
    return spark


#: Bytes of given Parquet tables for each partition that a shuffle starts with, and
#: of shuffled rows that AQE makes one task of. Codes compress well: the rows a task
#: sorts are many times as large as either.
GIVEN_BYTES = 8 * 1024**2
SHUFFLED_BYTES = 16 * 1024**2
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


#: The number last asked for, by application.
_asked: dict[str, str] = {}


def first_partitions(spark: SparkSession) -> int:
    """The number of partitions that shuffles start with."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def size_shuffles(spark: SparkSession, given_bytes: int) -> SparkSession:
    """Let the number of shuffle partitions follow the given tables, so a task's memory need not.

    AQE merges those that turn out small. Sizes that the session was set up with
    stay if they ask for more partitions, or for tasks of another size.
    """
    app = spark.sparkContext.applicationId
    if app in _asked and spark.conf.get(INITIAL_PARTITIONS, None) == _asked.pop(app):
        spark.conf.unset(INITIAL_PARTITIONS)
    wanted = -(-given_bytes // GIVEN_BYTES)
    if wanted > first_partitions(spark):
        _asked[app] = str(wanted)
        spark.conf.set(INITIAL_PARTITIONS, _asked[app])
    if spark.conf.get(ADVISORY_BYTES, None) is None:
        spark.conf.set(ADVISORY_BYTES, str(SHUFFLED_BYTES))
    return spark


#: Shuffle files of a statement go when it ends, not when the driver's collector
#: comes to it. What is read again afterwards must be a table.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def temporary_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Run some actions under other settings and put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
