"""Releases of a set of datasets that readers see all at once or not at all.

A release is written below a folder of its own, ``runs/<id>``. When all its datasets are there, one small
file, ``releases/<number>.json``, names their folders, rows and columns: creating that file is the
switch. Readers open the file with the highest number. A run that fails leaves no such file, so
readers keep what they have; two runs that finish together get two numbers, never one mix.

Nothing that a release names is changed later. Old releases stay readable until ``retire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reelmetrics.sources import files


class Run:
    """A release in the making: ``folder`` takes the datasets."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.name = uuid.uuid4().hex
        self.folder = f"{self.base}/runs/{self.name}"

    def publish(self, rows: Mapping[str, int], notes: Mapping[str, Any] | None = None, attempts: int = 100) -> int:
        """Switch to this run and return the number of its release.

        ``rows`` names the datasets below ``folder`` with their number of rows; each must be readable.
        """
        datasets = {}
        for name, n in rows.items():
            schema = self.spark.read.parquet(f"{self.folder}/{name}").schema
            datasets[name] = {"folder": f"runs/{self.name}/{name}", "rows": n, "schema": schema.jsonValue()}
        text = json.dumps({"run": self.name, "datasets": datasets, "notes": dict(notes or {})}, indent=1, default=str)
        for _ in range(attempts):
            number = max(releases(self.spark, self.base), default=0) + 1
            if files.create_text(self.spark, _record(self.base, number), text):
                return number
        raise RuntimeError(f"other runs took {attempts} numbers below {self.base}")

    def discard(self) -> None:
        """Delete what was written, for a run that failed."""
        files.delete(self.spark, self.folder)


def _record(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/releases/{number:08d}.json"


def publish(spark: SparkSession, base: str, write: Callable[[str], Mapping[str, int]], notes: Mapping[str, Any] | None = None) -> int:
    """Let ``write`` fill a new folder, then switch to it; returns the number of the release.

    ``write`` gets the folder and returns the rows of the datasets that it wrote there. If it raises, the
    folder is deleted, the error goes on, and readers see what they saw before.
    """
    run = Run(spark, base)
    try:
        return run.publish(write(run.folder), notes)
    except BaseException:
        run.discard()
        raise


def releases(spark: SparkSession, base: str) -> list[int]:
    """The numbers of all releases, oldest first."""
    names = files.list_names(spark, f"{base.rstrip('/')}/releases")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]


def describe(spark: SparkSession, base: str, number: int | None = None) -> dict[str, Any]:
    """The record of a release, by default the newest one."""
    if number is None:
        known = releases(spark, base)
        if not known:
            raise FileNotFoundError(f"no release below {base}")
        number = known[-1]
    return {"number": number} | json.loads(files.read_text(spark, _record(base, number)))


def open_release(
    spark: SparkSession, base: str, number: int | None = None, names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The datasets of one release by name; all come from the same run, whatever is published meanwhile."""
    datasets = describe(spark, base, number)["datasets"]
    return {
        name: spark.read.schema(StructType.fromJson(datasets[name]["schema"])).parquet(f"{base.rstrip('/')}/{datasets[name]['folder']}")
        for name in (datasets if names is None else names)
    }


def retire(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` releases; returns their numbers.

    The record goes first, so nobody opens a release whose data is on its way out. Runs that have
    no record are left alone: they may still be at work.
    """
    if keep < 1:
        raise ValueError("at least one release must stay")
    old = releases(spark, base)[:-keep]
    for number in old:
        run = describe(spark, base, number)["run"]
        files.delete(spark, _record(base, number))
        files.delete(spark, f"{base.rstrip('/')}/runs/{run}")
    return old
