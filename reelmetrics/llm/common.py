"""Small helpers that several operators share."""

from __future__ import annotations

import contextlib
import pathlib
import string
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import reelmetrics
from reelmetrics.sources.scratch import scratch_dir

# The word patterns of the contracts.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The same for bytes: A-Z become small letters, all that is no part of a word becomes a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b) in string.digits + string.ascii_lowercase else 32
    for b in range(256)
)


def lower_ascii(col: Column) -> Column:
    """A-Z in small letters; no other letter changes."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def whole_bytes(name: str) -> Column:
    """The UTF-8 bytes of a text column, null as no bytes."""
    return whole_text(name).cast("binary")


def fold(name: str, parts: int) -> Column:
    """crc32 of an id, written as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(f"`{name}`").cast("string").cast("binary")) % parts


def in_fold(name: str, parts: int, which: int) -> Column:
    """Whether an id falls into one fold; a null id falls into none."""
    return F.coalesce(fold(name, parts) == which, F.lit(False))


def not_in_fold(name: str, parts: int, which: int) -> Column:
    """Whether an id falls into another fold; a null id falls into none."""
    return F.coalesce(fold(name, parts) != which, F.lit(False))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the application was started.

    Once per application the sources go to the executors, as ``--py-files`` would send them.
    """
    context = spark.sparkContext
    if getattr(context, "_ships_reelmetrics", False):
        return
    folder = pathlib.Path(reelmetrics.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='reelmetrics-')}/reelmetrics.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(folder.rglob("*.py")):
            out.write(source, source.relative_to(folder.parent))
    context.addPyFile(archive)
    context._ships_reelmetrics = True


@contextlib.contextmanager
def _shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each query that ends inside."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option, None)
    spark.conf.set(option, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(option)
        else:
            spark.conf.set(option, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read again.

    This cuts the lineage: what follows never computes the rows anew, and a lost executor
    takes nothing along. So the shuffle files behind the rows can go as soon as they are written.
    Nobody else waits for these files, so they get no marker of success: on a local disk the driver
    starts processes that set its mode, and each holds the driver's memory for a moment.
    """
    path = scratch_dir(df.sparkSession, name)
    with _shuffle_files_go(df.sparkSession):
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
