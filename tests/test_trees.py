"""Trees of any depth against a walk in plain Python."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rosterloom.operators import trees
from rosterloom.operators.trees import is_below, tour
from rosterloom.sources.staging import shared_dir


def walked(rows):
    """rows: (node, parent, v); (first, last, depth, size, v) by node."""
    known = {n for n, _, _ in rows}
    children, value, out = {}, {n: v or 0 for n, _, v in rows}, {}
    for n, p, _ in sorted(rows, key=lambda r: r[0]):
        children.setdefault(p if p in known else None, []).append(n)
    stack, order, depth = [(n, 1) for n in reversed(children.get(None, []))], [], {}
    while stack:
        n, d = stack.pop()
        order.append(n)
        depth[n] = d
        stack += [(c, d + 1) for c in reversed(children.get(n, []))]
    first = {n: k for k, n in enumerate(order)}
    size, total = {}, {}
    for n in reversed(order):
        size[n] = 1 + sum(size[c] for c in children.get(n, []))
        total[n] = value[n] + sum(total[c] for c in children.get(n, []))
        out[n] = (first[n], first[n] + size[n] - 1, depth[n], size[n], total[n])
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, "node bigint, parent bigint, v int").repartition(4)
    return {r.node: (r.first, r.last, r.depth, r.size, r.v) for r in tour(df, ["v"]).collect()}


def test_forest_with_gaps_and_nulls(spark):
    r = random.Random(4)
    ids = r.sample(range(-50, 10_000), 120)
    rows = [(n, r.choice([None, 77_777, *ids[:k]]) if k < 40 else r.choice(ids[:k]), r.choice([None, 1, 5])) for k, n in enumerate(ids)]
    assert found(spark, rows) == walked(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "one", "none"])
def test_shapes(spark, shape):
    rows = {
        "chain": [(k, k - 1 if k else None, k) for k in range(1000)],
        "star": [(0, None, 1)] + [(k, 0, 1) for k in range(1, 500)],
        "one": [(5, None, 7)],
        "none": [],
    }[shape]
    got = found(spark, rows)
    assert got == walked(rows)
    if shape == "chain":
        assert got[0] == (0, 999, 1, 1000, 499_500) and got[999][:4] == (999, 999, 1000, 1)


def test_rounds_hand_on_no_estimate_and_no_table(spark):
    before = set(os.listdir(shared_dir(spark)))
    df = spark.createDataFrame([(k, k - 1 if k else None) for k in range(1000)], "node bigint, parent bigint")
    # Each join's estimate is the product of its sides: handed on from round to round it had thousands of digits here.
    size = str(tour(df)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert len(size) < 20
    assert not [f for f in set(os.listdir(shared_dir(spark))) - before if f.startswith("tour-")]


def test_ended_events_stay_out_of_the_join(spark):
    rows = [(e, e + 1 if e < 10 else None, 1) for e in range(5000)]
    ahead = spark.createDataFrame(rows, "event bigint, next bigint, _n bigint")
    got = {r.event: (r.next, r._n) for r in trees._further(ahead, ["_n"], 10**9).collect()}
    after = {e: (n, c) for e, n, c in rows}
    assert got == {e: (after[n][0], c + after[n][1]) if n is not None else (n, c) for e, n, c in rows}
    plan = trees._further(ahead, ["_n"], 10**9)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "isnotnull(next" in plan


def test_below_is_an_interval(spark):
    rows = [(1, None, 1), (2, 1, 1), (3, 2, 1), (4, 1, 1), (5, 4, 1)]
    t = tour(spark.createDataFrame(rows, "node bigint, parent bigint, v int"))
    a, b = t.alias("a"), t.alias("b")
    pairs = a.join(b, is_below(F.col("a.first"), F.col("b.first"), F.col("b.last"))).select("a.node", "b.node").collect()
    assert {tuple(p) for p in pairs} == {(1, 1), (2, 2), (2, 1), (3, 3), (3, 2), (3, 1), (4, 4), (4, 1), (5, 5), (5, 4), (5, 1)}


@pytest.mark.parametrize("rows", [[(1, 2), (2, 1), (3, None)], [(1, 1)], [(1, None), (1, None)], [(None, None)]])
def test_what_is_no_forest_is_an_error(spark, rows):
    with pytest.raises(ValueError):
        tour(spark.createDataFrame(rows, "node bigint, parent bigint"))
