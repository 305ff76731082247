"""Where intermediate tables go.

Intermediate results that several jobs read are written as Parquet below the
folder ``spark.checkpoint.dir`` names, so that they outlive any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from saleswright.session import SHUFFLES_GO, temporary_conf

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}
#: Paths handed out within the runs that clean up after themselves.
_runs: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh local one only in local mode."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="saleswright-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for run in _runs:
        run.append(path)
    return path


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made within, when all that reads them is done."""
    made: list[str] = []
    _runs.append(made)
    try:
        yield
    finally:
        _runs.pop()
        for path in made:
            drop(spark, path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system names it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder; none if it is not there."""
    files, place = _files(spark, path)
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, place = _files(spark, path)
    files.delete(place, True)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.before"


def recover(spark: SparkSession, path: str) -> None:
    """Put a table back that a failed :func:`swap_in` left aside."""
    if not exists(spark, path) and exists(spark, _aside(path)):
        _rename(spark, _aside(path), path)


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Let the folder ``fresh``, fully written, take the place of ``path``.

    The old folder stands aside until the new one is in place. A failure in
    between leaves one of them, which :func:`recover` puts back.
    """
    recover(spark, path)
    drop(spark, _aside(path))
    if exists(spark, path):
        _rename(spark, path, _aside(path))
    _rename(spark, fresh, path)
    drop(spark, _aside(path))


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, place = _files(spark, old)
    if not files.rename(place, _files(spark, new)[1]):
        raise OSError(f"{old} cannot become {new}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage the way a reliable checkpoint does, but columnar and
    compressed, so later readers scan only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with temporary_conf(spark, SHUFFLES_GO):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
