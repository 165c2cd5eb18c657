"""Operators on hand-made rows, with skewed and empty inputs, against brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rosterloom.functions.draws import distinct_picks, draw, first_items, permuted, repeated, shuffle_marks
from rosterloom.functions.scores import letter_score, shortfall
from rosterloom.functions.text import contains_pattern, json_array, json_first, last_token, latin_word, prefix_before, strip_leading_word
from rosterloom.operators.lookups import peer_ordinals, random_peers, weighted_lookup
from rosterloom.operators import ranking, sides
from rosterloom.operators.presence import always_there, presence_bitmaps, turnover_of_all_pairs
from rosterloom.operators.ranking import draw_bucket, even_bucket, greedy_cover, sample_exactly, with_rank
from rosterloom.operators.sides import dimension_lookup
from rosterloom.operators.windows import chunk_no
from rosterloom.plans import snapshots
from rosterloom.plans.attributes import Attributes
from rosterloom.plans.org import build_organisation, default_blocks
from rosterloom.plans.panel import panel
from rosterloom.plans.roster import PanelSpec, numbered_slots
from rosterloom.plans.export import entity_sample, flatten


def skewed(spark, n=4000):
    """One group holds a third of all rows."""
    group = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return spark.range(n).select("id", group.cast("bigint").alias("g"), draw("t", "id").alias("u"))


def by_group(rows):
    out = {}
    for r in rows:
        out.setdefault(r.g, []).append((r.u, r.id))
    return {g: sorted(v) for g, v in out.items()}


@pytest.mark.parametrize("bits", [1, 6, 12])
def test_rank_in_skewed_groups(spark, bits):
    df = skewed(spark)
    ranked = with_rank(df, "r", ["u", "id"], draw_bucket(F.col("u"), bits), ["g"]).collect()
    expected = by_group(df.collect())
    assert len(ranked) == 4000
    assert all(expected[r.g][r.r] == (r.u, r.id) for r in ranked)


@pytest.mark.parametrize("k", [0, 1, 60, 5000])
def test_exact_sample_in_groups(spark, k):
    df = skewed(spark)
    found = by_group(sample_exactly(df, k, "u", "id", ["g"]).collect())
    expected = {g: v[:k] for g, v in by_group(df.collect()).items() if k}
    assert found == expected


@pytest.mark.parametrize("k", [0, 1, 17, 4000, 9999])
def test_exact_sample_of_all(spark, k):
    df = skewed(spark)
    found = sorted((r.u, r.id) for r in sample_exactly(df, k, "u", "id", bits=4).collect())
    assert found == sorted((r.u, r.id) for r in df.collect())[:k]


def test_exact_sample_with_equal_draws(spark):
    df = spark.range(100).select("id", F.lit(5).cast("bigint").alias("u"))
    assert sorted(r.id for r in sample_exactly(df, 30, "u", "id").collect()) == list(range(30))


def test_greedy_cover_keeps_the_crossing_row(spark):
    df = spark.range(500).select("id", (F.col("id") % 7 + 1).alias("w"), draw("c", "id").alias("u"))
    rows = sorted(df.collect(), key=lambda r: (r.u, r.id))
    total, seen, expected = sum(r.w for r in rows), 0, []
    for r in rows:
        if seen * 10 >= total * 8:
            break
        expected.append(r.id)
        seen += r.w
    assert sorted(r.id for r in greedy_cover(df, "w", "u", "id", (8, 10), bits=3).collect()) == sorted(expected)


@pytest.mark.parametrize("rows_bound", [None, 3])
def test_weighted_lookup(spark, rows_bound):
    options = spark.createDataFrame([("a", 0, 3 << 30), ("b", 3 << 30, 3 << 30), ("c", 3 << 30, 1 << 32)], "name string, pick_low bigint, pick_high bigint")
    df = spark.range(2000)
    found = weighted_lookup(df, draw("w", "id"), options, {"name": "chosen"}, rows=rows_bound, draw_bits=32)
    expected = {r.id: "a" if r.u < 3 << 30 else "c" for r in df.select("id", draw("w", "id").alias("u")).collect()}
    assert {r.id: r.chosen for r in found.collect()} == expected


@pytest.mark.parametrize("bound", [None, 50])
def test_dimension_lookup_with_a_hot_key(spark, bound):
    dim = spark.range(0, 50, 2).select(F.col("id").alias("g"), (F.col("id") * 10).alias("v"))
    found = dimension_lookup(skewed(spark), dim, ["g"], rows=bound).collect()
    assert len(found) == 4000
    assert all(r.v == (r.g * 10 if r.g % 2 == 0 else None) for r in found)


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_peer_ordinals_are_distinct(spark, n):
    df = spark.range(500).select(
        peer_ordinals(F.lit(n).cast("bigint"), draw("a", "id"), draw("b", "id"), draw("c", "id")).alias("p")
    )
    for row in df.collect():
        wanted = row.p[: min(n, 3)]
        assert len(set(wanted)) == len(wanted) and all(0 <= i < n for i in wanted)


@pytest.mark.parametrize("k", [1, 5, 12])
def test_any_number_of_peers(spark, k):
    roster = spark.range(20).select(F.lit(1).alias("month"), F.col("id").alias("slot"), (F.col("id") + 100).alias("member"), F.col("id").alias("asker"))
    ordinals = peer_ordinals(F.lit(20).cast("bigint"), *[draw(f"d{i}", "slot") for i in range(k)])
    found = random_peers(roster, "month", "slot", "member", "asker", ordinals, F.lit(k)).collect()
    assert len(found) == 20 and all(len({p.member for p in r._peers}) == k for r in found)
    with pytest.raises(Exception, match="more peers wanted"):
        random_peers(roster, "month", "slot", "member", "asker", ordinals, F.lit(k + 1)).collect()


def test_chunks_leave_a_remainder(spark):
    df = spark.range(7).select(F.lit(1).alias("g"), "id")
    found = [r.c for r in df.select("id", chunk_no(["g"], ["id"], F.lit(3)).alias("c")).orderBy("id").collect()]
    assert found == [0, 0, 1, 1, 2, 2, 3]


def test_json_array_is_python_json(spark):
    rng = random.Random(3)
    alphabet = ['"', "\\", ",", "[", "]", " ", "я", "a", "\n", "null", '","', "{", "}", ":"]
    values = [[rng.choice([None, "".join(rng.choices(alphabet, k=rng.randint(0, 8)))]) for _ in range(rng.randint(0, 6))] for _ in range(300)]
    values.append(["x" * 100_000 + '",' * 50_000, None])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<string>")
    for r in df.select("i", json_array(F.col("v")).alias("j")).collect():
        assert r.j == json.dumps(values[r.i], ensure_ascii=False)
    deep = [[rng.choice([None, rng.choices(values, k=rng.randint(0, 3))]) for _ in range(rng.randint(0, 3))] for _ in range(300)]
    deep += [[], [[]], [[[]]], [[], [[], []], None], [[values[-1]]]]
    nested = spark.createDataFrame([(i, v) for i, v in enumerate(deep)], "i int, v array<array<array<string>>>")
    for r in nested.select("i", json_array(F.col("v")).alias("j")).collect():
        assert r.j == json.dumps(deep[r.i], ensure_ascii=False)
    numbers = spark.createDataFrame([([1, None, -3],), ([],), (None,)], "v array<bigint>")
    assert [r.j for r in numbers.select(json_array(F.col("v")).alias("j")).collect()] == ["[1, null, -3]", "[]", None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Отдел Кедр-4", "A / B"), ("Отделка x", "none"), ("  ", None)], "a string, b string")
    got = df.select(
        strip_leading_word(F.col("a"), ["Отделение", "Отдел"]).alias("s"), prefix_before(F.col("b"), " /").alias("p"),
        last_token(F.col("a"), F.lit("?")).alias("t"), contains_pattern(F.col("a"), "КЕДР").alias("c"),
        json_first(F.lit('["q", 1]')).alias("j"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Кедр-4", "A", "Кедр-4", True, "q"), ("Отделка x", "", "x", False, "q"), ("  ", None, "?", False, "q"),
    ]


def test_scores(spark):
    df = spark.createDataFrame([("A", 5, 0.5), ("E", 4, 1.0), ("Z", 3, 0.5), (None, 2, 0.3)], "l string, n bigint, m double")
    got = df.select(letter_score(F.col("l")).alias("s"), shortfall(F.col("n"), F.col("m")).alias("o")).collect()
    assert [(r.s, r.o) for r in got] == [(5, 3), (1, 0), (None, 1), (None, 1)]


def test_repeated_of_zero(spark):
    df = spark.createDataFrame([(0,), (2,)], "n int")
    assert [r.a for r in df.select(repeated(F.col("n"), lambda i: i.cast("int")).alias("a")).collect()] == [[], [1, 2]]


MEMBERS = [
    # member, period, group, group code, letter, tenure, grade, items
    ("1", "2025-01-31", "x", 1, "A", 100, 7, ["p"]), ("1", "2025-02-28", "x", 1, "Z", 130, 7, ["p"]),
    ("2", "2025-01-31", None, None, "B", 10, 8, []), ("3", "2025-02-28", "y", 2, "C", 5, 7, ["q", "p"]),
    ("4", "2025-02-28", None, None, "E", 365, 9, []),
]


@pytest.fixture
def members(spark):
    return spark.createDataFrame(
        MEMBERS, "employee_id string, d string, tribe_name string, tribe_code int, fp_res string, sber_los_cnt_days int, grade_num int, all_skills array<string>",
    ).withColumn("report_date", F.to_date("d")).drop("d")


def test_snapshot_questions(members):
    assert [tuple(r) for r in snapshots.snapshot_diff(members).collect()] == [(2, 3, 1, 2)]
    assert [tuple(r) for r in snapshots.top_groups(members).collect()] == [("x", 1, 1), ("y", 2, 1)]
    assert [tuple(r) for r in snapshots.top_groups(members, k=1).collect()] == [("x", 1, 1)]
    assert [tuple(r) for r in snapshots.grade_profile(members).collect()] == [(7, 2, 3.0, 0.2), (9, 1, 1.0, 1.0)]
    assert [tuple(r) for r in snapshots.skill_holders(members, "p").collect()] == [(2, 3.0)]
    assert [tuple(r) for r in snapshots.skill_holders(members, "nothing").collect()] == [(0, None)]
    assert [tuple(r) for r in snapshots.skill_popularity(members).collect()] == [("p", 2), ("q", 1)]
    assert [r[0] for r in snapshots.full_history(members).collect()] == ["1"]
    one = snapshots.full_history(members)
    history = snapshots.entity_history(members, one, ["report_date", "fp_res"]).collect()
    assert [r.fp_res for r in history] == ["A", "Z"]
    assert [r.fp_res for r in snapshots.lookup_history(members, "3", ["report_date", "fp_res"]).collect()] == ["C"]
    assert snapshots.missing_from(snapshots.earliest_snapshot(members), snapshots.latest_snapshot(members)).count() == 1


def test_questions_on_the_flat_form(members):
    flat = flatten(members)
    assert dict(flat.dtypes)["report_date"] == dict(flat.dtypes)["all_skills"] == "string"
    assert [tuple(r) for r in snapshots.skill_popularity(flat).collect()] == [("p", 2), ("q", 1)]
    assert [tuple(r) for r in snapshots.snapshot_diff(flat).collect()] == [(2, 3, 1, 2)]


def test_one_period_only(members):
    last = snapshots.latest_snapshot(members)
    assert [tuple(r) for r in snapshots.snapshot_diff(last).collect()] == [(3, 3, 0, 0)]
    assert snapshots.snapshot_diff(members.where("false")).collect()[0].at_start == 0


@pytest.mark.parametrize("n", [0, 7, 10_000])
def test_entity_sample_keeps_whole_histories(spark, n):
    df = skewed(spark, 3000).select("g", "id")
    found = entity_sample(df, n, "g").groupBy("g").count().collect()
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    assert len(found) == min(n, len(sizes))
    assert all(sizes[r.g] == r["count"] for r in found)


def test_null_group_is_a_group(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.lit("a")).alias("g"), "id", draw("trial", "id").alias("u")
    )
    ranked = with_rank(df, "r", ["u", "id"], draw_bucket(F.col("u")), ["g"])
    assert sorted((str(r.g), r.n, r.top) for r in ranked.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("top")).collect()) == [
        ("None", 500, 499), ("a", 500, 499)
    ]
    for groups in (None, 2):
        some = sample_exactly(df, 10, "u", "id", ["g"], groups=groups)
        assert sorted((str(r.g), r["count"]) for r in some.groupBy("g").count().collect()) == [("None", 10), ("a", 10)]


def test_sample_of_text_members(spark):
    df = spark.range(300).select(F.concat(F.lit("E-"), (F.col("id") % 100).cast("string")).alias("member"), "id")
    some = entity_sample(df, 7, "member")
    assert {r["count"] for r in some.groupBy("member").count().collect()} == {3} and some.count() == 21
    assert entity_sample(df, 1000, "member").count() == 300


def test_any_number_of_items(spark):
    df = spark.createDataFrame([(0,), (2,), (40,)], "n int").withColumn("marks", shuffle_marks("trial", 5, "n"))
    rows = df.select(
        repeated(F.col("n"), lambda i: i).alias("many"), first_items("marks", F.array(*map(F.lit, "abcde")), F.col("n")).alias("items")
    ).collect()
    assert [list(r.many) for r in rows] == [[], [1, 2], list(range(1, 41))]
    assert [len(r["items"]) for r in rows] == [0, 2, 5] and sorted(rows[2]["items"]) == list("abcde")


def test_addresses_are_spelled_and_unique(spark):
    assert [latin_word(w) for w in ("Юрий", "Жуков", "Семён")] == ["uriy", "jukov", "semen"]
    rows = spark.range(5000).select((F.col("id") + 10_000_001).alias("emp_no"))
    mails = rows.select(Attributes(42).work_email().alias("mail"))
    assert mails.distinct().count() == 5000


def test_every_option_can_be_picked(spark):
    """Intervals of width one, far below what 32 bits tell apart, and the last place of the range."""
    places = [0, 1, 2, 2**31, 2**40 + 1, 2**62 - 2, 2**62 - 1]
    bounds = sorted({*places, *(p + 1 for p in places)})
    options = spark.createDataFrame(list(zip(bounds, [*bounds[1:], 2**62])), "pick_low bigint, pick_high bigint").where("pick_low < pick_high")
    df = spark.createDataFrame([(p,) for p in places], "u bigint")
    for bits in (None, 20):
        found = weighted_lookup(df, F.col("u"), options, {"pick_low": "low"}, bits=bits).collect()
        assert sorted((r.u, r.low) for r in found) == [(p, p) for p in places]


# -- even ranges, limits without a shuffle of the rows ---------------------------------------


def exchanges_above(df, table_size):
    """Exchanges between the result and the scan of the rows: down the plan, on the streamed side of joins."""
    node, found = df._jdf.queryExecution().sparkPlan(), []
    while True:
        name = node.getClass().getSimpleName()
        children = node.children()
        if "Exchange" in name or "SortMergeJoin" in name or "Shuffled" in name:
            found.append(name)
        if children.size() == 0:
            return found
        at = 0
        if children.size() == 2 and node.getClass().getSimpleName() == "BroadcastHashJoinExec" and "Left" in str(node.buildSide()):
            at = 1
        node = children.apply(at)


def test_a_sample_filters_rows_where_they_are(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = skewed(spark)
        assert exchanges_above(sample_exactly(df, 60, "u", "id", ["g"]), 4000) == []
        assert exchanges_above(sample_exactly(df, 60, "u", "id"), 4000) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("k", [1, 700, 1300, 5000])
def test_limits_found_by_finer_ranges(spark, monkeypatch, k):
    """Ranges of two bits, refined until no more than three rows are ordered; nulls and equal draws among them."""
    monkeypatch.setattr(ranking, "CANDIDATE_ROWS", 3)
    df = skewed(spark).withColumn("u", F.when(F.col("id") % 10 == 1, F.lit(77)).otherwise(F.col("u"))).withColumn("g", F.nullif("g", F.lit(7)))
    found = by_group(sample_exactly(df, k, "u", "id", ["g"], bits=2).collect())
    assert found == {g: v[:k] for g, v in by_group(df.collect()).items()}


def test_more_groups_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sides, "BROADCAST_ROWS", 5)
    df = skewed(spark)
    assert by_group(sample_exactly(df, 20, "u", "id", ["g"]).collect()) == {g: v[:20] for g, v in by_group(df.collect()).items()}


@pytest.mark.parametrize("ranges", [1, 2, 5, 64, 1000])
def test_even_ranges_follow_the_order(spark, ranges):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, -5, -(1 << 63), (1 << 63) - 1, 7, 7, 7, *range(200)])], "id int, v bigint")
    rows = df.withColumn("b", even_bucket(df, "v", ranges)).collect()
    known = sorted((r.v, r.b) for r in rows if r.v is not None)
    assert all(x[1] <= y[1] for x, y in zip(known, known[1:])) and all(0 <= r.b < max(ranges, 1) for r in rows)
    ranked = with_rank(df, "r", ["v", "id"], even_bucket(df, "v", ranges)).collect()
    assert {r.id: r.r for r in ranked} == {i: k for k, (_, i) in enumerate(sorted((r.v is not None, r.v or 0, r.id)[1:] if r.v is not None else (-(1 << 64), r.id) for r in rows))}
    empty = df.limit(0)
    assert empty.withColumn("b", even_bucket(empty, "v", ranges)).count() == 0


def test_ranges_of_a_skewed_key_are_even(spark):
    """Ten million keys, most of them tiny and a few huge: no range holds twice the mean."""
    df = spark.range(10_000_000).select(F.floor(F.exp(F.col("id") / 300_000.0)).alias("v"), "id").select((F.col("v") * 64 + F.col("id") % 64).alias("v"))
    n, most = df.groupBy(even_bucket(df, "v", 256).alias("b")).count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert n == 256 and most <= 2 * 10_000_000 / 256


# -- permutations and large pools, presence bitmaps -----------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 10, 97, 100, 101, 1000])
def test_permuted_is_a_permutation(spark, size):
    df = spark.range(size).select(permuted(F.col("id"), size, "p", F.lit(3)).alias("a"), permuted(F.col("id"), size, "p", F.lit(4)).alias("b"))
    rows = df.collect()
    assert sorted(r.a for r in rows) == sorted(r.b for r in rows) == list(range(size))
    assert size < 90 or [r.a for r in rows] != [r.b for r in rows]


def test_picks_of_a_million(spark):
    """k distinct ordinals out of 10^6 for each of 2,000 keys; all places are about equally likely."""
    df = spark.range(2000).select(distinct_picks(20, 1_000_000, "m", "id").alias("x"))
    rows = [r.x for r in df.collect()]
    assert all(len(set(x)) == 20 and 0 <= min(x) and max(x) < 1_000_000 for x in rows)
    tenths = [0] * 10
    for x in rows:
        for v in x:
            tenths[v // 100_000] += 1
    assert all(abs(n - 4000) < 5 * 60 for n in tenths) and len({tuple(x) for x in rows}) == 2000
    few = spark.range(3).select(distinct_picks(F.col("id") * 4, 5, "m", "id").alias("x")).collect()
    assert [sorted(r.x) for r in few][::2] == [[], [0, 1, 2, 3, 4]] and len(set(few[1].x)) == 4


def test_presence_bitmaps(spark):
    r = random.Random(6)
    rows = [(r.choice([None, 0, 1, 32_767, 32_768, 40_000, 10**7, 10**7 + 5]), r.choice([None, 1, 2, 3])) for _ in range(60)] + [(1, 9)]
    bitmaps = presence_bitmaps(spark.createDataFrame(rows, "member bigint, period int"), "member", "period")
    held = {p: {m for m, q in rows if q == p and m is not None} for p in (1, 2, 3, 9)}
    expected = {(a, b, len(held[a]), len(held[b]), len(held[a] - held[b]), len(held[b] - held[a])) for a in held for b in held if a < b}
    assert {tuple(x) for x in turnover_of_all_pairs(bitmaps).collect()} == expected
    assert tuple(always_there(bitmaps).first()) == (len(held[1] & held[2] & held[3] & held[9]), len(held[1] | held[2] | held[3] | held[9]))
    none = bitmaps.limit(0)
    assert turnover_of_all_pairs(none).count() == 0 and tuple(always_there(none).first()) == (0, 0)


def test_items_of_a_known_bound_are_not_picked_by_lambda(spark):
    """Where few items are wanted, the shuffled order stays a column of its own and no lambda interprets it."""
    df = spark.createDataFrame([(0,), (2,), (3,)], "n int").withColumn("marks", shuffle_marks("trial", 5, "n"))
    items = F.array(*map(F.lit, "abcde"))
    few = df.select("n", first_items("marks", items, F.col("n"), most=3).alias("items"))
    assert few.collect() == df.select("n", first_items("marks", items, F.col("n")).alias("items")).collect()
    assert "lambda" not in few._jdf.queryExecution().optimizedPlan().toString()
    every = first_items("marks", items, F.lit(7), most=8)
    assert sorted(df.select(every.alias("i")).first().i) == list("abcde")
    with pytest.raises(Exception, match="more than 2 items"):
        df.select(first_items("marks", items, F.col("n"), most=2)).collect()


def test_panel_pools_are_not_interpreted(spark):
    """The columns that take several items of a pool are generated code in the panel's plan."""
    org = build_organisation(default_blocks(spark), 42, 5)
    plan = panel(spark, numbered_slots(spark, 20), org, PanelSpec(months=1), ["all_skills", "all_goals_desc", "achievement_desc"])
    assert "transform(" not in plan._jdf.queryExecution().optimizedPlan().toString()
