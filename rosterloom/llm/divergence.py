"""Source divergence audit: how the sources of a language differ in their terms, by a frequent-pattern tree.

Every source has a smoothed share ``p`` of every kept term, also of those it lacks (``p0``).  Two sources are compared over
all terms, yet most terms are missing in most sources.  With f(p, q) = (p - q)² div q the sum over all V terms is

    V f(p0, q0) + terms of p: f(p, q0) - f(p0, q0) + terms of q: f(p0, q) - f(p0, q0)
                + terms of both: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

so only terms that both sources have need a look at the pair.  A term's row is its list of (source, p), the largest
source first.  Rows go into a frequent-pattern tree: equal rows are counted once with their multiplicity, rows
that begin alike share nodes, and a node with its multiplicity gives one correction per ancestor.  The rows
are sorted over the whole table (ranges of equal rows and prefixes), so a task grows the tree of its own range,
some ``TREE_ITEMS`` list items at a time; a node that two trees share is merely counted in parts, as sums add up.

Terms are counted within tasks before anything is shuffled, one row per language and term with its sources.  A hot
source is a longer list in many rows, never one task's rows; what meets in one row is bounded by the number of sources.

Defined results: null language, source and text are ''; a source without terms still has all its pairs; without kept
terms all values are 0; repeated rows and documents with equal ids count each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.scores import whole_div
from rosterloom.llm.words import chunks
from rosterloom.operators.sides import BROADCAST_ROWS, dimension_lookup
from rosterloom.sources.staging import staging_path

LEAST_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
TREE_ITEMS = 1 << 19
#: Rows of counts that a task holds before it hands them on.
HELD_ROWS = 1_000_000
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[0x41:0x5B] = TERM_BYTES[0x61:0x7B] = TERM_BYTES[0x80:] = True
PAIRS = ["lang", "group_no", "item_no"]


def _counted(texts: pa.Array, group: np.ndarray) -> Iterator[pa.Table]:
    """(group, term, n, docs) of whole texts, about a megabyte at a time."""
    for chunk in chunks(texts):
        words = chunk.words(lower=True, table=TERM_BYTES)
        if not len(words):
            continue
        sizes = words.end - words.start
        inside = words.data[np.repeat(words.start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(inside)]).dictionary_encode()
        n, code, doc = len(coded.dictionary), coded.indices.to_numpy().astype(np.int64), words.text_of()
        own = group[chunk.first_row : chunk.first_row + len(chunk)]
        keys, count = np.unique(own[doc] * n + code, return_counts=True)
        each = np.unique(doc * n + code)
        docs = np.unique(own[each // n] * n + each % n, return_counts=True)[1]
        yield pa.table({"group": keys // n, "term": coded.dictionary.take(pa.array(keys % n)), "n": count, "docs": docs})


def _merged(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns({"n_sum": "n", "docs_sum": "docs"})


def _by_term(table: pa.Table, groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """A row per language and term, with the list of its sources."""
    langs = sorted({lang for lang, _ in groups})
    lang_of = np.array([langs.index(lang) for lang, _ in groups], np.int64)
    coded = table.column("term").combine_chunks().dictionary_encode()
    group = table.column("group").to_numpy()
    key = lang_of[group] * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
    entries = pa.StructArray.from_arrays(
        [pa.array([s for _, s in groups]).take(pa.array(group[order])), *[table.column(c).combine_chunks().take(pa.array(order)) for c in ("n", "docs")]],
        ["source", "n", "docs"],
    )
    head = order[first]
    rows = pa.table(
        {
            "lang": pa.array(langs).take(pa.array(lang_of[group[head]])),
            "term": coded.dictionary.take(coded.indices.take(pa.array(head))).cast(pa.binary()).cast(pa.string()),
            "counts": pa.ListArray.from_arrays(pa.array(np.concatenate((first, [len(order)])), pa.int32()), entries),
        }
    )
    yield from rows.to_batches(10_000)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    groups: dict[tuple[str, str], int] = {}
    for batch in batches:
        pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for pair in pairs:
            if pair not in groups:
                groups[pair] = len(groups)  # with an empty term, so that a source without terms is known
                held.append(pa.table({"group": [groups[pair]], "term": pa.array([b""], pa.large_binary()), "n": [0], "docs": [0]}))
        held += _counted(batch.column(2), np.array([groups[p] for p in pairs], np.int64))
        if sum(map(len, held)) > HELD_ROWS:
            held = [_merged(held)]
            if len(held[0]) > HELD_ROWS // 2:
                yield from _by_term(held.pop(), list(groups))
    if held:
        yield from _by_term(_merged(held), list(groups))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, total, leads): occurrences of the kept terms; the empty term stands for a source as such.

    ``leads`` marks one row of each kept term.  One shuffle, on (lang, term), of rows that the tasks have counted.
    """
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    entries = rows.mapInArrow(_count_task, "lang string, term string, counts array<struct<source: string, n: bigint, docs: bigint>>")
    flat = entries.repartition("lang", "term").select("lang", "term", F.inline("counts"))
    summed = flat.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    leads = (F.row_number().over(whole.orderBy("source")) == 1) & (F.col("term") != "")
    known = summed.select(
        "lang", "term", "source", "n", F.sum("n").over(whole).alias("total"), F.sum("docs").over(whole).alias("_docs"), leads.alias("leads")
    )
    return known.where((F.col("_docs") >= least_docs) | (F.col("term") == "")).drop("_docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + SCALE * (n + 1) div (total + terms), exact for any counts."""
    wide = "decimal(20,0)"
    return F.lit(1).cast("bigint") + whole_div((n + 1).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (total + terms).cast(wide)).cast("bigint")


def gap(p: Column, q: Column) -> Column:
    return whole_div((p - q) * (p - q), q)


def sources_of(counts: DataFrame) -> DataFrame:
    """(lang, source, no, terms, held, lang_held, p0): sources numbered from the largest, p0 null without terms."""
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"), F.sum(F.col("leads").cast("bigint")).alias("_terms"))
    by_lang = Window.partitionBy("lang")
    return held.select(
        "lang", "source", "held", F.sum("held").over(by_lang).alias("lang_held"), F.sum("_terms").over(by_lang).alias("terms"),
        F.row_number().over(by_lang.orderBy(F.desc("held"), "source")).alias("no"),
    ).withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(0), F.col("held"), F.col("terms"))))


class Tree:
    """Frequent-pattern tree of sorted rows: each row a list of (source number, p, p0), with a multiplicity."""

    def __init__(self, lang: np.ndarray, lists: pa.ListArray, times: np.ndarray):
        items = lists.flatten()
        self.no, self.p, self.p0 = (items.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        self.lang, self.sizes, self.times = lang, sizes, times
        self.begins = np.cumsum(sizes) - sizes
        self.shared = np.zeros(len(sizes), np.int64)  # items that a row shares with the row before it
        alive = np.flatnonzero(np.concatenate(([False], lang[1:] == lang[:-1]))) if len(sizes) else np.zeros(0, np.int64)
        depth = 0
        while len(alive):
            alive = alive[(sizes[alive] > depth) & (sizes[alive - 1] > depth)]
            here, above = self.begins[alive] + depth, self.begins[alive - 1] + depth
            alive = alive[(self.no[here] == self.no[above]) & (self.p[here] == self.p[above])]
            depth += 1
            self.shared[alive] = depth

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, rows, multiplicities): the first rows of the nodes at each depth."""
        for depth in range(int(self.sizes.max(initial=0))):
            starts = np.flatnonzero(self.shared <= depth)
            times = np.add.reduceat(self.times, starts)
            there = self.sizes[starts] > depth
            yield depth, starts[there], times[there]

    def corrections(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(lang, group, item, value): one row per node, ancestor and direction, some nodes at a time."""
        for depth, rows, times in self.nodes():
            step = max(1, TREE_ITEMS // max(1, depth))
            for k in range(0, len(rows) if depth else 0, step):
                row, m = np.repeat(rows[k : k + step], depth), np.repeat(times[k : k + step], depth)
                node = self.begins[row] + depth
                above = self.begins[row] + np.tile(np.arange(depth), len(row) // depth)
                for x, y in ((node, above), (above, node)):
                    p, p0, q, q0 = self.p[x], self.p0[x], self.p[y], self.p0[y]
                    value = (p - q) ** 2 // q - (p - q0) ** 2 // q0 - (p0 - q) ** 2 // q + (p0 - q0) ** 2 // q0
                    yield self.lang[row], self.no[x], self.no[y], m * value


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the sorted rows of a task, and their corrections summed per pair of sources."""

    def summed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        lang = table.column("lang").combine_chunks().dictionary_encode()
        tree = Tree(lang.indices.to_numpy().astype(np.int64), table.column("path").combine_chunks(), table.column("times").to_numpy())
        found: list[pa.Table] = []
        for own, group, item, value in tree.corrections():
            found.append(pa.table({"lang": own, "group_no": group, "item_no": item, "value": value}).group_by(PAIRS).aggregate([("value", "sum")]))
        if found:
            rows = pa.concat_tables(found).group_by(PAIRS).aggregate([("value_sum", "sum")])
            names = lang.dictionary.take(rows.column("lang").combine_chunks())
            columns = [names, *[rows.column(c).combine_chunks().cast(pa.int32()) for c in PAIRS[1:]], rows.column("value_sum_sum").combine_chunks()]
            yield from pa.table(columns, names=[*PAIRS, "value"]).to_batches(10_000)

    held: list[pa.RecordBatch] = []
    items = 0
    for batch in batches:
        held.append(batch)
        items += len(batch.column(1).flatten())
        if items > TREE_ITEMS:
            yield from summed(held)
            held, items = [], 0
    if held:
        yield from summed(held)


def tree_corrections(shares: DataFrame) -> DataFrame:
    """(lang, group_no, item_no, value) from (lang, term, no, p, p0), by trees over ranges of sorted rows."""
    items = F.sort_array(F.collect_list(F.struct("no", "p", "p0")))
    rows = shares.groupBy("lang", "term").agg(items.alias("path")).where(F.size("path") > 1)
    once = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    ranged = once.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ranged.mapInArrow(_grow, "lang string, group_no int, item_no int, value bigint")


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank): sources by divergence, and each source's most typical terms."""
    spark = docs.sparkSession
    path, side = staging_path(spark, "divergence-counts"), staging_path(spark, "divergence-sources")
    term_counts(docs, lang, source, text, least_docs).write.parquet(path)
    counts = spark.read.parquet(path)
    sources_of(counts).write.parquet(side)
    sources = spark.read.parquet(side)
    n = sources.count()
    known = dimension_lookup(counts.where((F.col("term") != "") & (F.col("n") > 0)), sources, ["lang", "source"], n)
    shares = known.select("lang", "source", "term", "no", "p0", share(F.col("n"), F.col("held"), F.col("terms")).alias("p"), share(F.col("total"), F.col("lang_held"), F.col("terms")).alias("q"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    typical = (
        shares.where(F.col("p") > F.col("q"))
        .select("lang", "source", "term", gap(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )

    # Each source beside all sources of its language: the rows of the result, not of the texts.
    beside = sources.groupBy("lang").agg(F.collect_list(F.struct(F.col("source").alias("item"), F.col("no").alias("item_no"), F.col("p0").alias("q0"))).alias("_items"))

    def with_items(df: DataFrame) -> DataFrame:
        return dimension_lookup(df, beside, ["lang"], n if n <= BROADCAST_ROWS else None).select(*df.columns, F.inline("_items")).where(F.col("no") != F.col("item_no"))

    p, p0, q0, m = F.col("p"), F.col("p0"), F.col("q0"), F.col("m")
    pairs = with_items(sources.select("lang", "source", "no", "terms", "p0"))
    alone = with_items(shares.groupBy("lang", "no", "p0", "p").agg(F.count(F.lit(1)).alias("m")))
    as_group = alone.select("lang", F.col("no").alias("group_no"), "item_no", (m * (gap(p, q0) - gap(p0, q0))).alias("value"))
    as_item = alone.select("lang", F.col("item_no").alias("group_no"), F.col("no").alias("item_no"), (m * (gap(q0, p) - gap(q0, p0))).alias("value"))
    parts = as_group.unionByName(as_item).unionByName(tree_corrections(shares))
    summed = parts.groupBy(*PAIRS).agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("_sum"))
    base = F.when(F.col("terms") > 0, F.col("terms").cast("decimal(20,0)") * gap(p0, q0).cast("decimal(18,0)"))
    both = pairs.withColumn("group_no", F.col("no")).join(summed, PAIRS, "left")
    value = (F.coalesce(base, F.lit(0)) + F.coalesce(F.col("_sum"), F.lit(0))).cast("bigint")
    near = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    compared = both.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(near))
    return compared.unionByName(typical)


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_UPPER, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP13_SQL = rf"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER_CASE}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
t AS MATERIALIZED (SELECT row_no, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row_no) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS terms, sum(n) AS held FROM kept GROUP BY lang),
c AS MATERIALIZED (SELECT t.lang, t.source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
    SELECT s.lang, s.source, coalesce(h.n, 0) AS held
    FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) h USING (lang, source)),
shares AS MATERIALIZED (
    SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
           (1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (g.held + v.terms))::BIGINT AS p,
           (1 + {SCALE}::HUGEINT * (kept.n + 1) // (v.held + v.terms))::BIGINT AS q
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
compared AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN compared ON compared.lang = a.lang AND compared.source = a.source AND compared.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
