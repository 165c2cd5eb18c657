"""Benchmark decontamination: a broadcast set of test n-grams, scanned over every text.

A benchmark item gives a window for each run of ``n`` normalised words; an item of fewer words is
one window.  The windows are broadcast as a hash set, the words of each text are hashed in a
rolling way, and every hash hit is verified on the words themselves.  Texts are never shuffled.

The set is broadcast in blocks of about ``max_windows`` windows at most, counted once for each item they stand in and
dealt by item and window, so a window that many items share is spread as well.  A larger benchmark is scanned block by
block, and the hits of a text are put together by a key of the text, so no size is refused.

Defined results: a null text has no words; a null item text gives no window; an item without id
marks words but is not listed; repeated rows of a text or an item change nothing; an empty
benchmark leaves every text clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.words import ALNUM_BYTES, chunks, code_points_before

N = 10
MAX_WINDOWS = 200_000
_BITS = 20
_WINDOW = "item string, size int, window string"
_HIT = "struct<word:int,start:int,end:int>"
_SCAN = f"struct<n_words:bigint,hits:array<{_HIT}>,items:array<string>>"
_SCAN_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """Distinct (item, size, window): the runs of ``n`` words of each item, joined by a blank."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, size, window = [], [], []
            for chunk in chunks(batch.column(1)):
                words = chunk.words(lower=True, table=ALNUM_BYTES)
                for d in range(len(chunk)):
                    a, b = words.first[d], words.first[d + 1]
                    own = [words.data[words.start[k] : words.end[k]].tobytes().decode() for k in range(a, b)]
                    length = min(n, len(own))
                    runs = [" ".join(own[k : k + length]) for k in range(len(own) - length + 1)] if own else []
                    item += [batch.column(0)[chunk.first_row + d].as_py()] * len(runs)
                    size += [length] * len(runs)
                    window += runs
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(size, pa.int32()), pa.array(window, pa.string())], ["item", "size", "window"])

    return benchmark.select(F.col(item_id).cast("string"), F.col(text)).mapInArrow(cut, _WINDOW).distinct()


class WindowSet:
    """Windows by their hash, per size; a bit table answers most look-ups."""

    def __init__(self, rows: list[tuple[str | None, int, str]]):
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, dict[int, list[tuple[bytes, str | None]]]]] = {}
        for size in sorted({r[1] for r in rows}):
            own = [r for r in rows if r[1] == size]
            known: dict[int, list[tuple[bytes, str | None]]] = {}
            for chunk in chunks(pa.array([r[2] for r in own], pa.string())):
                words = chunk.words(table=ALNUM_BYTES)
                _, found = words.runs(words.hashes(), size)
                for (item, _, window), h in zip(own[chunk.first_row : chunk.first_row + len(chunk)], found.tolist()):
                    known.setdefault(h, []).append((window.encode(), item))
            hashes = np.sort(np.array(list(known), np.uint64))
            bits = np.zeros(1 << _BITS, bool)
            bits[hashes >> np.uint64(64 - _BITS)] = True
            self.sizes[size] = (bits, hashes, known)

    def scan(self, column: pa.Array) -> pa.Array:
        """Per text: number of words, hit words with their place in code points, items found."""
        n_words, hits, items = [], [], []
        for chunk in chunks(column):
            words = chunk.words(lower=True, table=ALNUM_BYTES)
            n_words += words.counts.tolist()
            hit = np.zeros(len(words), bool)
            found: list[set[str]] = [set() for _ in range(len(chunk))]
            hashes = words.hashes() if self.sizes else None
            for size, (bits, known_hashes, known) in self.sizes.items():
                first, runs = words.runs(hashes, size)
                maybe = np.flatnonzero(bits[runs >> np.uint64(64 - _BITS)])
                at = np.searchsorted(known_hashes, runs[maybe])
                maybe = maybe[known_hashes[np.minimum(at, len(known_hashes) - 1)] == runs[maybe]]
                texts = np.searchsorted(words.first, first[maybe], side="right") - 1
                for k, h, d in zip(first[maybe].tolist(), runs[maybe].tolist(), texts.tolist()):
                    own = b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[k : k + size], words.end[k : k + size]))
                    same = [item for window, item in known[h] if window == own]
                    if same:
                        hit[k : k + size] = True
                        found[d].update(i for i in same if i is not None)
            items += [sorted(x) for x in found]
            if not hit.any():
                hits += [[]] * len(chunk)
                continue
            before = code_points_before(words.data)
            for d in range(len(chunk)):
                a, b = words.first[d], words.first[d + 1]
                own = np.flatnonzero(hit[a:b]) + a
                zero = before[chunk.offsets[d]]
                hits.append(
                    [
                        {"word": k - a, "start": s, "end": e}
                        for k, s, e in zip(own.tolist(), (before[words.start[own]] - zero).tolist(), (before[words.end[own]] - zero).tolist())
                    ]
                )
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(hits, _SCAN_TYPE[1].type), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "hits", "items"],
        )


def _scanner(rows: DataFrame):
    """A column function for the windows in ``rows``, which the caller has counted."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast([(r.item, r.size, r.window) for r in rows.collect()])
    built: list[WindowSet] = []

    def scan(text: pa.Array) -> pa.Array:
        if not built:
            built.append(WindowSet(shared.value))
        return built[0].scan(text)

    return F.arrow_udf(scan, _SCAN).asNondeterministic()


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    n: int = N, max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """Adds ``contamination``: struct of n_words, hits (word, start, end; code points) and items.

    A column of that name is replaced; the other columns stay as they are, whatever their names.
    """
    windows = benchmark_windows(benchmark, item_id, item_text, n)
    blocks = max(1, -(-windows.count() // max_windows))
    if blocks == 1:
        return docs.withColumn("contamination", _scanner(windows)(F.col(text)))
    key = [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), F.col(text)).alias("_k2")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "contamination"]).alias("_row")
    keyed = docs.select(row, F.col(text).alias("_text"), *key)
    parts = None
    for block in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == block)
        part = keyed.select("_k1", "_k2", _scanner(own)(F.col("_text")).alias("_c"))
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("_k1", "_k2").agg(
        F.struct(
            F.max("_c.n_words").alias("n_words"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("_c.hits")))).alias("hits"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("_c.items")))).alias("items"),
        ).alias("contamination")
    )
    return keyed.join(merged, ["_k1", "_k2"]).select("_row.*", "contamination")


def is_contaminated() -> Column:
    return F.size("contamination.hits") > 0


def drop_contaminated(scanned: DataFrame) -> DataFrame:
    """The texts without a hit, as they came."""
    return scanned.where(~is_contaminated()).drop("contamination")


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """Cuts the hit words out of the texts, with what lies between neighbouring hit words."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for value, marks in zip(texts.to_pylist(), hits.to_pylist()):
            kept, at = [], 0
            for k, mark in enumerate(marks or []):
                joined = k > 0 and marks[k - 1]["word"] + 1 == mark["word"]
                if not joined:
                    kept.append(value[at : mark["start"]])
                at = mark["end"]
            out.append(value if not marks else "".join(kept) + value[at:])
        return pa.array(out, pa.string())

    changed = F.when(is_contaminated(), cut(F.col(text), F.col("contamination.hits"))).otherwise(F.col(text))
    return scanned.withColumn(text, changed).drop("contamination")


def digest_of(items: Column) -> Column:
    """SHA-256 of the sorted, comma-joined items."""
    return F.sha2(F.array_join(F.sort_array(items), ","), 256)


def report(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    c = "contamination"
    return scanned.select(
        doc_id,
        F.col(f"{c}.n_words").alias("n_words"),
        F.size(f"{c}.hits").cast("bigint").alias("n_hit"),
        F.size(f"{c}.items").cast("bigint").alias("n_items"),
        digest_of(F.col(f"{c}.items")).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return report(scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


_UPPER, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER_CASE}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP1_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id::VARCHAR AS item, {_WORDS_SQL} AS w FROM benchmark),
bs AS (SELECT item, w, least(len(w), {N}) AS n FROM b WHERE len(w) > 0),
bw AS MATERIALIZED (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
dn AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
hits AS MATERIALIZED (
    SELECT DISTINCT doc_id, i, h.n, item
    FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM dn) h JOIN bw ON h.n = bw.n AND h.win = bw.win),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
