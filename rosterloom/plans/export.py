"""Entity sample and flat export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.functions.draws import DEFAULT_SEED, draw
from rosterloom.functions.text import json_array
from rosterloom.operators.ranking import in_sample, sample_limits
from rosterloom.sources.schema import MEMBER, PERIOD


def entity_sample(
    df: DataFrame, n: int, member: str = MEMBER, key: Column | None = None, seed: int = DEFAULT_SEED
) -> DataFrame:
    """All rows of n members chosen at random; all members if there are fewer.

    The draw hangs on the member alone, so the choice is one cut-off: distinct members are counted
    by draw range, and the long table itself is only filtered, neither joined nor shuffled.
    Members may be of any type: text is hashed as it is, and ``key`` may give another unique form of the
    member to draw on.
    """
    chosen = F.col(member) if key is None else key
    keyed = df.withColumn("_member", chosen)
    if isinstance(keyed.schema["_member"].dataType, T.IntegralType):
        keyed = keyed.withColumn("_member", F.col("_member").cast("bigint"))
        keyed = keyed.withColumn("_member_u", draw("entity_sample", "_member", seed=seed))
    else:
        keyed = keyed.withColumn("_member_u", draw("entity_sample", F.col("_member"), seed=seed, text=True))
    limits = sample_limits(keyed.select("_member", "_member_u"), n, "_member_u", "_member", distinct=True)
    limit = limits.select(F.struct("_limit_draw", "_limit_key")).scalar()
    sided = keyed.withColumn("_limit", limit).select(
        "*", F.col("_limit._limit_draw").alias("_limit_draw"), F.col("_limit._limit_key").alias("_limit_key")
    )
    return sided.where(in_sample("_member_u", "_member", n)).select(*df.columns)


def flatten(df: DataFrame, period: str = PERIOD) -> DataFrame:
    """Array columns as JSON text, the period as ISO text, decimals and floats as double."""
    out = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            col = json_array(col)
        elif field.name == period and isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        out.append(col.alias(field.name))
    return df.select(*out)


def export_flat(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    n_members: int | None = None,
    key: Column | None = None,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Flat relational copy of a panel, optionally of n members with their whole history.

    Written to Parquet at ``path`` or to a table, replacing what is there; returns the flat rows.
    """
    rows = df if n_members is None else entity_sample(df, n_members, key=key, seed=seed)
    flat = flatten(rows)
    writer = flat.sortWithinPartitions(PERIOD, "tribe_code", MEMBER).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static").partitionBy(PERIOD)  # the access path by date
    if path is not None:
        writer.option("compression", "snappy").parquet(path)
        return df.sparkSession.read.schema(flat.schema).parquet(path).select(*flat.columns)
    if table is not None:
        writer.format("parquet").saveAsTable(table)
        return df.sparkSession.table(table)
    return flat
