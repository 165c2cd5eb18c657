"""Layouts that let a scan skip what a lookup does not want: by several columns at once, or by member.

*Clustered*: rows are sorted by a space-filling key.  Each column becomes an ordinal among splitters taken from the data, and
the bits of all ordinals are interleaved, so that a file and a row group cover a small box of all columns at once and their
minima and maxima rule them out for a lookup on any of the columns.  Parquet bloom filters (or, where a chunk
is dictionary-encoded throughout, its dictionary) rule out row groups for equality with a value that no box names.

*By member*: a folder per bucket of members, sorted by member and period.  All periods of one member lie side by side;
the member may be known at run time only, and still one folder and few row groups are read.

The splitters come from a bounded sample of rows (``SAMPLE_ROWS``).  They decide how well rows are laid out, never which
rows are found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.sources.schema import MEMBER, PERIOD

SAMPLE_ROWS = 20_000
ORDINAL_BITS = 6
#: Rows that one task gathers, sorts and writes: about 150 MB shuffled and 400 MB in memory in rows of 54 columns.
ROWS_PER_FILE = 250_000
ROW_GROUP_BYTES = 32 << 20
BUCKET, BUCKETS = "member_bucket", "member_buckets"


def splitters(values: Sequence[object], bits: int = ORDINAL_BITS) -> list:
    """Distinct values that cut the sorted ``values`` into at most 2^bits even classes; nulls are left out."""
    known = sorted(v for v in values if v is not None)
    cuts = [known[len(known) * i >> bits] for i in range(1, 1 << bits)] if known else []
    return sorted(set(cuts) - {known[0]}) if known else []


def ordinal(column: Column, cuts: Sequence[object], bits: int = ORDINAL_BITS) -> Column:
    """Class of a value among the splitters by binary search, spread over 2^bits numbers; null is in the lowest."""
    classes = len(cuts) + 1

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit((low << bits) // classes)
        middle = (low + high) // 2
        return F.when(column < F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(column.isNull(), F.lit(0)).otherwise(search(0, classes - 1))


def interleaved(ordinals: Sequence[Column], bits: int = ORDINAL_BITS) -> Column:
    """One BIGINT with the bits of all ordinals in turn, the highest bits first."""
    k = len(ordinals)
    if k * bits > 62:
        raise ValueError("at most 62 bits in all")
    total = F.lit(0).cast("bigint")
    for c, own in enumerate(ordinals):
        for i in range(bits):
            bit = F.shiftright(own, i).bitwiseAND(F.lit(1)).cast("bigint")
            total = total.bitwiseOR(F.shiftleft(bit, i * k + k - 1 - c))
    return total


def space_filling_key(df: DataFrame, columns: Sequence[str], rows: int, bits: int = ORDINAL_BITS) -> Column:
    """The sort key of ``columns`` with splitters from a sample of about ``SAMPLE_ROWS`` of the ``rows`` rows."""
    narrow = df.select(*columns)
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    seen = (narrow if share >= 1 else narrow.sample(share, seed=1)).collect()
    return interleaved([ordinal(F.col(c), splitters([row[c] for row in seen], bits), bits) for c in columns], bits)


def _bloom(columns: Mapping[str, int]) -> dict[str, str]:
    options = {}
    for column, values in columns.items():
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(values)
    return options


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], period: str = PERIOD, blooms: Sequence[str] = (MEMBER,),
    rows_per_file: int = ROWS_PER_FILE, row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """A folder per period, rows sorted by the space-filling key of ``columns``, bloom filters on ``blooms``.

    Files are ranges of (period, key) of about ``rows_per_file`` rows, whatever the periods' sizes.
    """
    rows = df.count()
    keyed = df.withColumn("_place", space_filling_key(df, columns, rows))
    files = max(1, -(-rows // rows_per_file))
    (
        keyed.repartitionByRange(files, period, "_place", *columns)
        .sortWithinPartitions(period, "_place", *columns)
        .drop("_place")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.block.size", row_group_bytes)
        .options(**_bloom({c: rows_per_file for c in blooms}))
        .partitionBy(period)
        .parquet(path)
    )


def write_by_member(
    df: DataFrame, path: str, buckets: int, member: str = MEMBER, period: str = PERIOD,
    rows_per_file: int = ROWS_PER_FILE, row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """A folder per bucket of members; the number of buckets is a folder name too, so that readers know it."""
    n = F.lit(buckets)
    placed = df.withColumn(BUCKETS, n).withColumn(BUCKET, F.pmod(F.xxhash64(member), n).cast("int"))
    files = max(1, -(-df.count() // rows_per_file))
    (
        placed.repartitionByRange(files, BUCKET, member, period)
        .sortWithinPartitions(BUCKET, member, period)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.block.size", row_group_bytes)
        .options(**_bloom({member: rows_per_file}))
        .partitionBy(BUCKETS, BUCKET)
        .parquet(path)
    )


def read_by_member(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The layout of :func:`write_by_member` under the declared schema, with its two bucket columns."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKETS, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(whole).parquet(path)


def rows_of_member(df: DataFrame, chosen: DataFrame | object, member: str = MEMBER) -> DataFrame:
    """Rows of one member of a layout by member; ``chosen`` is a value, or a DataFrame whose first row holds it.

    The member is a scalar of the plan: it prunes folders, and row groups by statistics and bloom filter,
    once it is known.  An empty ``chosen`` gives no rows.
    """
    value = chosen.select(member).limit(1).scalar() if isinstance(chosen, DataFrame) else F.lit(chosen)
    own = F.pmod(F.xxhash64(value), F.col(BUCKETS)).cast("int")
    return df.where((F.col(BUCKET) == own) & (F.col(member) == value)).drop(BUCKETS, BUCKET)
