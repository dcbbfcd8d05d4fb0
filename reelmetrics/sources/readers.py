"""Typed CSV input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.sources import schemas

REJECT = "_rejected_line"
POSITION = "position"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
    keep_rejects: bool = False,
    with_position: bool = False,
) -> DataFrame:
    """Read CSV files with a header, a fixed schema (as text) and ISO dates.

    A doubled quote inside quotes is one quote. A header that differs from the schema in
    names or order is an error. ``multi_line`` allows line breaks inside quotes, but then
    a file is read by one task, so it is meant for small tables.

    In the default mode a field that does not fit its type becomes NULL. With
    ``keep_rejects`` the whole line is kept as well, in ``_rejected_line``, for
    ``split_rejects``. ``mode="FAILFAST"`` stops the job instead.

    ``with_position`` adds a ``position`` that sorts like the lines in the files.
    """
    read_as = f"{schema}, {REJECT} string" if keep_rejects else schema
    reader = spark.read.schema(read_as).options(
        header=True,
        encoding="UTF-8",
        quote='"',
        escape='"',
        dateFormat="yyyy-MM-dd",
        enforceSchema=False,
        multiLine=multi_line,
        mode=mode,
    )
    if keep_rejects:
        reader = reader.option("columnNameOfCorruptRecord", REJECT)
    df = reader.csv(path)
    if keep_rejects:
        # Only fields that a query uses are parsed, so a line counts as rejected only if all
        # fields are used. This condition uses them and always holds.
        always = F.pmod(F.xxhash64(*[c for c in df.columns if c != REJECT]), F.lit(2)) >= 0
        df = df.withColumn(REJECT, F.when(always, F.col(REJECT)))
    if with_position:
        # Within one block of a file the id grows with the lines.
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
        df = df.withColumn(POSITION, place)
    return df


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a ``keep_rejects`` read into rows that fit the schema and lines that do not."""
    return df.where(F.col(REJECT).isNull()).drop(REJECT), df.where(F.col(REJECT).isNotNull())


def read_star(
    spark: SparkSession, folder: str, mode: str = "PERMISSIVE", with_position: bool = False, keep_rejects: bool = False
) -> dict[str, DataFrame]:
    """Read the six CSV files of a folder; with ``keep_rejects``, each table for ``split_rejects``."""
    tables = {}
    for table, file in schemas.FILES.items():
        df = read_csv(
            spark,
            f"{folder}/{file}",
            schemas.read_schema(table),
            multi_line=table in schemas.MULTI_LINE,
            mode=mode,
            keep_rejects=keep_rejects,
            with_position=with_position,
        )
        renamed = {header: name for name, header in schemas.HEADER_NAMES.get(table, {}).items()}
        tables[table] = df.withColumnsRenamed(renamed)
    return tables
