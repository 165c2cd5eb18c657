"""Alias tables: exact shares for any weights, and the picks drawn from them."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rosterloom.functions.draws import PICK_RANGE, pick_draw, wide_draw
from rosterloom.operators import alias


def shares(rows, n):
    out = {}
    for r in rows:
        out[r.key] = out.get(r.key, 0) + Fraction(r.cut, PICK_RANGE * n)
        out[r.alias] = out.get(r.alias, 0) + Fraction(PICK_RANGE - r.cut, PICK_RANGE * n)
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("weights", [[5], [1, 1, 1], [1, 2, 3, 4], [100, 1, 1, 1, 1], [1] * 50 + [1000, 999, 3], [0, 7, None, -2, 7], [10**12, 1, 10**11] * 5, "random", "steep"])
def test_shares_are_the_weights(spark, weights):
    r = random.Random(3)
    if weights == "random":
        weights = [r.randint(1, 1_000_000) for _ in range(700)]
    if weights == "steep":
        weights = [int(1.07**k) + 1 for k in range(400)]
        r.shuffle(weights)
    df = spark.createDataFrame([(k * 3 - 7, w) for k, w in enumerate(weights)], "k bigint, w bigint").repartition(3)
    table, n = alias.alias_table(df, "k", "w")
    rows = table.collect()
    known = {k * 3 - 7: w for k, w in enumerate(weights) if w and w > 0}
    total = sum(known.values())
    assert n == len(known) == len(rows) and sorted(x.slot for x in rows) == list(range(n))
    got = shares(rows, n)
    assert all(0 <= x.cut <= PICK_RANGE for x in rows) and set(got) <= set(known)
    assert all(abs(got.get(k, 0) - Fraction(w, total)) < Fraction(n + 1, PICK_RANGE) for k, w in known.items())


def test_picks_follow_the_weights(spark):
    weights = {1: 1, 2: 10, 3: 100, 4: 889}
    table, n = alias.alias_table(spark.createDataFrame(list(weights.items()), "k bigint, w int"), "k", "w")
    df = spark.range(200_000)
    picked = alias.alias_pick(df, wide_draw("a", "id"), pick_draw("b", "id"), table, n, "k")
    found = {r.k: r.n for r in picked.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    for k, w in weights.items():
        p = w / 1000
        assert abs(found[k] - 200_000 * p) < 5 * (200_000 * p * (1 - p)) ** 0.5


def test_nothing_to_pick_from(spark):
    table, n = alias.alias_table(spark.createDataFrame([(1, 0)], "k bigint, w int"), "k", "w")
    assert n == 0 and table.count() == 0
    with pytest.raises(ValueError):
        alias.alias_pick(spark.range(3), F.lit(1), F.lit(1), table, n, "k")


def test_first_after_goes_through_a_range_once(spark, capsys):
    r = random.Random(5)
    rows = [(k // 3, k, r.choice([None, None, k * 10])) for k in range(300)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, v bigint").repartition(5)
    got = alias.first_after(df, ["a", "b"], F.floor(F.col("a") / 20), F.col("v"), "following")
    found = {x.b: x.following for x in got.collect()}
    assert found == {k: next((v for _, j, v in rows if j > k and v is not None), None) for _, k, _ in rows}
    got.explain()
    # A frame from a row to the end of its range is computed anew for every row; only the one over a row per range may be one.
    windows = [line for line in capsys.readouterr().out.splitlines() if "unboundedfollowing" in line]
    assert windows and not [line for line in windows if "_value" in line]
