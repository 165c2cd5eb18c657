"""Scan and sinks of the panel."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.sources.schema import MEMBER, PANEL, PERIOD


#: Rows that one task gathers, sorts and writes: some 25 MB of Parquet and 400 MB in memory in rows of 54 columns.
ROWS_PER_FILE = 250_000


def read_panel(spark: SparkSession, path: str, schema: T.StructType = PANEL) -> DataFrame:
    """Parquet scan under the declared schema and column order; nothing is inferred."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def stored_periods(spark: SparkSession, path: str, period: str = PERIOD) -> list[datetime.date]:
    """The periods a table at ``path`` has, ascending, from the names of its folders alone.

    No file is opened: the cost is one listing a folder, whatever the rows.  Folders without a data file do not
    count, nor does the folder of rows without a period.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for folder in store.listStatus(root):
        name, _, value = folder.getPath().getName().partition("=")
        if name != period or value == "__HIVE_DEFAULT_PARTITION__":
            continue
        if any(not f.getPath().getName().startswith(("_", ".")) for f in store.listStatus(folder.getPath())):
            found.append(datetime.date.fromisoformat(value))
    return sorted(found)


def read_period(spark: SparkSession, path: str, which: int = -1, schema: T.StructType = PANEL) -> DataFrame:
    """The rows of one stored period: -1 for the latest, 0 for the earliest, and so on.

    The period is known before the scan is planned, so only its folder is listed and read; a table
    without periods gives no rows.
    """
    periods = stored_periods(spark, path)
    if not periods:
        return spark.createDataFrame([], schema)
    return read_panel(spark, path, schema).where(F.col(PERIOD) == F.lit(periods[which]))


def laid_out(
    df: DataFrame, sort_by: tuple[str, ...] = ("tribe_code", MEMBER), files_per_period: int | None = None, periods: int | None = None
) -> DataFrame:
    """Row order that lets Parquet statistics stand in for indexes.

    The rows are sorted inside each task only.  With ``files_per_period`` they are first
    gathered into that many even pieces per period, which costs a shuffle of the whole table.  Where the number of ``periods`` is
    known and they are consecutive months, every piece is a task of its own; otherwise some tasks get several pieces.
    """
    if files_per_period:
        piece = F.pmod(F.xxhash64(MEMBER), F.lit(files_per_period))
        if periods:
            month = F.coalesce(F.year(PERIOD) * 12 + F.month(PERIOD), F.lit(0))
            task = F.pmod(month, F.lit(periods)) * files_per_period + F.coalesce(piece, F.lit(0))
            df = df.repartitionById(periods * files_per_period, task.cast("int"))
        else:
            df = df.repartition(PERIOD, piece)
    return df.sortWithinPartitions(PERIOD, *sort_by)


def files_for(rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Files that a period of ``rows`` rows is cut into, whatever the number of tasks or periods."""
    return max(1, -(-rows // rows_per_file))


def write_panel(
    df: DataFrame, path: str, mode: str = "overwrite", files_per_period: int | None = None, periods: int | None = None
) -> None:
    """Snappy Parquet, one folder per period.

    ``overwrite`` replaces the periods in ``df`` and keeps others when the session's
    partitionOverwriteMode is dynamic; ``append`` adds a new period.
    """
    (
        laid_out(df, files_per_period=files_per_period, periods=periods)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(PERIOD)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, buckets: int, by: str = MEMBER) -> None:
    """Table bucketed by member, for joins and histories that need no shuffle."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by).saveAsTable(table)
