"""Joins of a long table with dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.draws import PICK_BITS
from rosterloom.functions.scores import whole_div
from rosterloom.operators.sides import bounded_or_merged

LEAST_BITS = 12


def weighted_lookup(
    df: DataFrame,
    u: Column,
    options: DataFrame,
    columns: dict[str, str],
    low: str = "pick_low",
    high: str = "pick_high",
    rows: int | None = None,
    bits: int | None = None,
    draw_bits: int = PICK_BITS,
) -> DataFrame:
    """Joins each row with the option whose [low, high) holds the row's draw of ``draw_bits`` bits.

    ``columns`` maps wanted option columns to output names.  The interval test becomes
    an equi join on the draw's range: an option is repeated once per range it touches,
    so a heavy option is spread over many ranges and no join key is hot.  ``rows`` is a
    known bound on the number of options; only within it is the side broadcast.  There are 2^``bits``
    ranges; by default about as many as options, which are counted if no bound is known.
    """
    if bits is None:
        bits = max(LEAST_BITS, (options.count() if rows is None else rows).bit_length())
    width = F.lit(1 << (draw_bits - bits))
    touched = options.where(F.col(low) < F.col(high)).select(
        F.explode(F.sequence(whole_div(F.col(low), width), whole_div(F.col(high) - 1, width))).alias("_range"),
        F.col(low).alias("_low"),
        F.col(high).alias("_high"),
        *[F.col(c).alias(n) for c, n in columns.items()],
    )
    bound = None if rows is None else rows + (1 << bits)
    drawn = df.withColumn("_u", u).withColumn("_range", F.shiftright("_u", draw_bits - bits).cast("bigint"))
    hit = (F.col("_low") <= F.col("_u")) & (F.col("_u") < F.col("_high"))
    joined = drawn.join(
        bounded_or_merged(touched, bound),
        (drawn["_range"] == touched["_range"]) & hit,
    )
    return joined.select(*[drawn[c] for c in df.columns], *columns.values())


def with_ancestors(df: DataFrame, path: str, name: str) -> DataFrame:
    """One row per unit on the path of each row, the own unit included."""
    return df.withColumn(name, F.explode(path))


def peer_ordinals(n: Column, *draws: Column) -> Column:
    """A distinct ordinal of 0..n-1 per draw (as many as n allows): each is moved past the sorted earlier ones.

    Three draws have a closed form; other numbers are folded, where ``n`` and the draws may hold no subquery.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    if len(draws) == 3:
        first = draws[0] % F.greatest(n, one)
        second = draws[1] % F.greatest(n - one, one)
        second = second + F.when(second >= first, one).otherwise(none)
        third = draws[2] % F.greatest(n - F.lit(2), one)
        third = third + F.when(third >= F.least(first, second), one).otherwise(none)
        third = third + F.when(third >= F.greatest(first, second), one).otherwise(none)
        return F.array(first, second, third)
    left = F.array(*[(d % F.greatest(n - F.lit(k), one)).cast("bigint") for k, d in enumerate(draws)])

    def insert(taken: Column, x: Column) -> Column:
        moved = F.aggregate(F.array_sort(taken), x, lambda y, t: y + F.when(y >= t, one).otherwise(none))
        return F.concat(taken, F.array(moved))

    return F.aggregate(left, F.array().cast("array<bigint>"), insert)


def random_peers(
    roster: DataFrame, period: str, ordinal: str, member: str, asker: str, ordinals: Column, count: Column
) -> DataFrame:
    """Members of the same period at the drawn ordinals, as (asker, _peers).

    ``_peers`` is an array of (period, place, member) over all periods of an asker,
    so it has at most as many entries per period as ordinals were drawn; a larger count is
    an error.  Join keys are spread evenly: an ordinal is drawn by chance.
    """
    short = F.raise_error(F.lit("more peers wanted than ordinals drawn"))
    wanted = F.when(count > F.size(ordinals), short).otherwise(F.slice(ordinals, F.lit(1), count.cast("int")))
    # A column of its own: inside the generator the draws would be interpreted.
    asked = roster.select(period, asker, wanted.alias("_wanted")).select(period, asker, F.posexplode("_wanted").alias("_place", ordinal))
    known = roster.select(period, ordinal, member)
    return (
        asked.join(known, [period, ordinal])
        .groupBy(asker)
        .agg(F.sort_array(F.collect_list(F.struct(period, "_place", member))).alias("_peers"))
    )


def peers_in_period(peers: Column, period: Column, period_name: str, member: str) -> Column:
    """The peers of one period, in drawn order; empty when there are none."""
    found = F.transform(
        F.filter(peers, lambda p: p[period_name] == period), lambda p: p[member].cast("string")
    )
    return F.coalesce(found, F.array().cast("array<string>"))
