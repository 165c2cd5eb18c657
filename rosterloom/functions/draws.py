"""Seeded random draws as column expressions.

A draw is a hash of (seed, name, key...), so a value depends on nothing but its
key: not on the partitioning, the row order, or on other draws.  Recomputing a
lost partition gives the same rows again.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42
DRAW_BITS = 32
WIDE_BITS = 63
# Draws that pick one of a table's intervals: fine enough for any number of rows that a table can have.
PICK_BITS = 62
PICK_RANGE = 1 << PICK_BITS
DRAW_RANGE = 1 << DRAW_BITS
FEISTEL_TURNS = 3
#: Steps of a permutation outside its range, beyond which it is an error; of 4,096 numbers and fewer none walks so far.
MOST_STEPS = 64


def draw_tag(name: str, seed: int = DEFAULT_SEED) -> int:
    """The constant that separates one stream of draws from another."""
    if not 0 <= seed < 1 << 31:
        raise ValueError("seed must lie in [0, 2^31)")
    return (seed << 32) | zlib.crc32(name.encode("utf-8"))


Key = Column | str | int


def _hash_text(name: str, keys: Sequence[str | int], seed: int) -> str:
    casts = ", ".join(f"CAST({k if isinstance(k, int) else f'`{k}`'} AS BIGINT)" for k in keys)
    return f"xxhash64(CAST({draw_tag(name, seed)} AS BIGINT), {casts})"


def _hash(name: str, keys: Sequence[Key], seed: int, text: bool) -> Column:
    if not text and not any(isinstance(k, Column) for k in keys):
        return F.expr(_hash_text(name, keys, seed))
    cols = []
    for key in keys:
        col = F.lit(key) if isinstance(key, int) else F.col(key) if isinstance(key, str) else key
        cols.append(col if text else col.cast("bigint"))
    return F.xxhash64(F.lit(draw_tag(name, seed)).cast("bigint"), *cols)


def draw(name: str, *keys: Key, seed: int = DEFAULT_SEED, text: bool = False) -> Column:
    """Uniform BIGINT in [0, 2^32).  Numeric keys; ``text=True`` hashes them as they are."""
    return F.shiftrightunsigned(_hash(name, keys, seed, text), 64 - DRAW_BITS)


def wide_draw(name: str, *keys: Key, seed: int = DEFAULT_SEED, text: bool = False) -> Column:
    """Uniform BIGINT in [0, 2^63), for picks from more than 2^32 things."""
    return F.shiftrightunsigned(_hash(name, keys, seed, text), 64 - WIDE_BITS)


def pick_draw(name: str, *keys: Key, seed: int = DEFAULT_SEED, text: bool = False) -> Column:
    """Uniform BIGINT in [0, 2^62), to be looked up in intervals."""
    return F.shiftrightunsigned(_hash(name, keys, seed, text), 64 - PICK_BITS)


def uniform_int(u: Column, low: Column | int, high: Column | int) -> Column:
    """Integer in [low, high]; either bound may be a column."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return low + u % (high - low + F.lit(1))


def uniform_decimal(u: Column, low: int, high: int, digits: int) -> Column:
    """Double with ``digits`` decimals; the bounds are given in units of 10^-digits."""
    return uniform_int(u, low, high) / F.lit(float(10**digits))


def cutoff(p: float) -> int:
    return int(p * DRAW_RANGE)


def chance(u: Column, p: float) -> Column:
    """True with probability p."""
    return u < F.lit(cutoff(p))


def _sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, int) and not -(1 << 31) <= value < 1 << 31:
        return f"CAST('{value}' AS BIGINT)"
    return str(value)


def literal_array(values: Sequence[object]) -> Column:
    return F.expr("array(" + ", ".join(map(_sql_literal, values)) + ")")


def pick(u: Column, pool: Sequence[object]) -> Column:
    """Uniform pick from a pool."""
    return F.get(literal_array(pool), (u % F.lit(len(pool))).cast("int"))


def ladder(weights: Sequence[int]) -> list[int]:
    """Upper draw limits of integer weights; the last one is 2^32."""
    total, seen, out = sum(weights), 0, []
    for weight in weights:
        seen += weight
        out.append(seen * DRAW_RANGE // total)
    return out


def weighted(u: Column, options: Sequence[tuple[object, int]]) -> Column:
    """Pick by integer weights; an option may be NULL or a column."""
    limits = ladder([w for _, w in options])
    values = [v if isinstance(v, Column) else F.lit(v) for v, _ in options]
    expr = F.when(u < F.lit(limits[0]), values[0])
    for value, limit in zip(values[1:-1], limits[1:-1]):
        expr = expr.when(u < F.lit(limit), value)
    return expr.otherwise(values[-1]) if len(values) > 1 else values[0]


def shuffle_marks(name: str, size: int, *keys: str | int, seed: int = DEFAULT_SEED) -> Column:
    """The ordinals 0..size-1 in random order, each as the low byte of a BIGINT.

    Draw and ordinal share one number, so the sort runs on primitives in generated code.
    Select it as a column before :func:`first_items` reads it several times.
    """
    if size > 256:
        raise ValueError("pools hold at most 256 items; distinct_picks takes larger ones")
    marks = ", ".join(
        f"shiftrightunsigned({_hash_text(name, [*keys, i], seed)}, {64 - DRAW_BITS}) * 256 + {i}" for i in range(size)
    )
    return F.expr(f"sort_array(array({marks}))")


def first_items(marks: str, items: Column, k: Column, most: int | None = None) -> Column:
    """The first k shuffled items, all of them if there are fewer; ``marks`` is the shuffled order of the array ``items``.

    Where k is known to be at most ``most``, the items are picked place by place in generated code: a lambda would be
    interpreted, and with it whatever its arguments are made of.  A larger k is an error then.
    """
    k = F.greatest(k.cast("int"), F.lit(0))

    def item(mark: Column) -> Column:
        return F.get(items, (mark % F.lit(256)).cast("int"))

    if most is None:
        return F.transform(F.slice(F.col(marks), F.lit(1), k), item)
    beyond = F.raise_error(F.lit(f"more than {most} items wanted")).cast("int")
    found = F.array(*[item(F.get(F.col(marks), F.lit(i))) for i in range(most)])
    return F.slice(found, F.lit(1), F.when(k > most, beyond).otherwise(F.least(k, F.size(marks))))


def _rounds(size: int) -> tuple[int, int]:
    """Sides of the smallest near-square that holds ``size`` numbers."""
    wide = max(1, math.isqrt(max(size, 1) - 1) + 1)
    return wide, -(-size // wide)


def permuted(place: Column, size: int, name: str, *keys: Key, seed: int = DEFAULT_SEED) -> Column:
    """Where a keyed permutation of 0..size-1 sends ``place``, in constant time and space.

    The place is a cell of a near-square; row and column are moved by a draw on the other one in turn (a Feistel network), which
    can be undone and so is a permutation of the square.  Cells beyond ``size`` are sent on until one falls inside.
    """
    rows, columns = (F.lit(x).cast("bigint") for x in _rounds(size))

    def turn(cell: Column, number: Column) -> Column:
        across = F.pmod(cell["across"] + draw(f"{name}/across", *keys, number, cell["up"], seed=seed), columns)
        return F.struct(F.pmod(cell["up"] + draw(f"{name}/up", *keys, number, across, seed=seed), rows).alias("up"), across.alias("across"))

    def step(x: Column) -> Column:
        cell = F.struct(F.floor(x / columns).cast("bigint").alias("up"), F.pmod(x, columns).alias("across"))
        turns = F.sequence(F.lit(1).cast("bigint"), F.lit(FEISTEL_TURNS).cast("bigint"))
        return F.aggregate(turns, cell, turn, lambda cell: cell["up"] * columns + cell["across"])

    # A path through the cells outside is no longer than they are many, and almost never as long as MOST_STEPS.
    outside = math.prod(_rounds(size)) - size
    walk = F.slice(F.sequence(F.lit(1), F.lit(MOST_STEPS)), F.lit(1), F.lit(min(outside, MOST_STEPS)))
    lost = F.raise_error(F.lit("permutation walk too long")).cast("bigint")
    return F.aggregate(
        walk, step(place.cast("bigint")), lambda x, _: F.when(x < size, x).otherwise(step(x)), lambda x: F.when(x < size, x).otherwise(lost)
    )


def distinct_picks(k: Column | int, size: int, name: str, *keys: Key, seed: int = DEFAULT_SEED) -> Column:
    """Array of k distinct ordinals of 0..size-1 in random order, all of them if there are fewer; the pool is not laid out."""
    k = F.lit(k) if isinstance(k, int) else k
    return repeated(F.least(F.greatest(k, F.lit(0)), F.lit(size)), lambda i: permuted(i - F.lit(1), size, name, *keys, seed=seed))


def repeated(n: Column, value: Callable[[Column], Column]) -> Column:
    """Array of n values, n from another column; n = 0 gives an empty array.  ``value`` gets the places 1..n."""
    places = F.sequence(F.lit(1).cast("bigint"), F.greatest(n, F.lit(1)).cast("bigint"))
    return F.transform(F.slice(places, F.lit(1), n.cast("int")), value)


def past_date(ref: Column, u: Column, low: int, high: int) -> Column:
    """A date low..high days before ``ref``."""
    return F.date_sub(ref, uniform_int(u, low, high).cast("int"))
