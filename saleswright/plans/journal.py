"""What a run has finished, so that a repeated run goes on where it broke off."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from saleswright.storage import drop, exists


def inputs_identity(spark: SparkSession, paths: Sequence[str]) -> str:
    """Tells apart what lies at some paths: names, sizes and times of the files, not their content."""
    found = []
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            told = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
            row = told.agg(F.count("h").alias("n"), F.expr("bit_xor(h)").alias("x")).first()
            found.append((path, row.n, row.x))
        except AnalysisException:
            found.append((path, 0, None))
    return sha256(json.dumps(found).encode()).hexdigest()


class RunJournal:
    """The last finished run of each stage: its run, its inputs and its counts.

    A stage is passed over if the same run finished it with the same settings
    and input files, all stages before it were passed over, and its tables are
    there. Before a stage begins, its own record and those of all later stages
    go, since their tables may change from then on: a record is proof that the
    tables are those of its run. It is written after the stage's tables, so a
    run that breaks off in between does the stage again.
    """

    def __init__(self, spark: SparkSession, lake: str, run_id: str, settings: object, inputs: Sequence[str], stages: Sequence[str]):
        self._spark, self._stages = spark, tuple(stages)
        self._folder = f"{lake.rstrip('/')}/run_journal"
        told = json.dumps(asdict(settings), sort_keys=True, default=str)
        self._proof = {
            "run_id": run_id,
            "settings": sha256(told.encode()).hexdigest(),
            "inputs": inputs_identity(spark, inputs),
        }
        self._going_on = True
        #: Stages that were passed over.
        self.skipped: list[str] = []

    def _path(self, stage: str) -> str:
        return f"{self._folder}/{stage}"

    def _record(self, stage: str) -> dict | None:
        # The marker of a finished write tells a record from the rest of one.
        if not exists(self._spark, f"{self._path(stage)}/_SUCCESS"):
            return None
        row = self._spark.read.schema("record string").text(self._path(stage)).first()
        return None if row is None else json.loads(row.record)

    def once(self, stage: str, tables: Callable[[Mapping], Sequence[str]], work: Callable[[], dict[str, int]]) -> dict[str, int]:
        """The counts of ``stage``: those on record if it is proven done, else of ``work``.

        ``tables`` gives the paths that the stage has written, by its counts.
        """
        record = self._record(stage) if self._going_on else None
        if (
            record is not None
            and record["proof"] == self._proof
            and all(exists(self._spark, path) for path in tables(record["counts"]))
        ):
            self.skipped.append(stage)
            return record["counts"]
        self._going_on = False
        for later in self._stages[self._stages.index(stage) :]:
            drop(self._spark, self._path(later))
        counts = work()
        told = json.dumps({"proof": self._proof, "counts": counts})
        self._spark.createDataFrame([(told,)], "record string").coalesce(1).write.mode("overwrite").text(self._path(stage))
        return counts
