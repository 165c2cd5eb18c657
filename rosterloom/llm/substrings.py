"""Repeated passages: anchors at difference-cover positions, extended to whole windows.

A window is ``length`` consecutive words.  Every word is removed that lies in a window whose
words also start anywhere else.  Hashing every window of a corpus would shuffle a row per word, so:

1. Only positions whose place modulo a period p lies in a difference cover D carry an *anchor* of
   w = length - p + 1 words.  For any two places of an equal window there is an offset below p at which both
   are in D, so they share an anchor, wherever the two texts begin.
2. Anchors found in more than one place are extended: only windows around them are hashed in full
   (96 bits), and those found in more than one place are removed.

Rows are dealt out over groups by a hash of id and text, so copies do not meet in one task.  A group sends
each anchor or window once, however often it holds it, packed as arrays per receiving task; the
answer is a list of word positions.  A very frequent passage thus costs one entry per group.
Of a row repeated very often (same id and text) a few copies are dealt, at least two, as more find no other
repeats; each answers for a bounded number of rows.  A group is a partition of its own, and so is a receiving task.
The texts are shuffled once; Spark reuses that exchange in each of the three passes.

Defined results: a null text has no words; repeated rows are repeats of one another; ids may be null or tied.
Columns of ``docs`` other than id and text are not carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.skew import COPIES_AT_ONCE, HOT_PART, one_of_each, repeated_rows, row_keys
from rosterloom.llm.words import Words, plain, run_hashes, SPACE_BYTES

LENGTH = 35
#: Bytes of text per group; a task that compares entries serves ``GROUPS_SERVED`` groups' worth of them.
GROUP_BYTES = 4 << 20
GROUPS_SERVED, LEAST_BUCKETS = 8, 64
#: Perfect difference sets: every difference modulo the period occurs.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_PACKED = "bucket int, g int, entries binary"
_ANSWER = "g int, places binary"


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors at least two fifths as long as a window."""
    period = max(p for p in COVERS if length - p + 1 >= 0.4 * length)
    return period, COVERS[period]


class Group:
    """The texts of one group in an order that depends on nothing but the rows."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, sort_keys=[("k1", "ascending"), ("k2", "ascending")])
        self.table = table.take(order)
        column = plain(self.table.column("text"))
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.words = Words(data[offsets[0] : offsets[-1]], offsets - offsets[0], SPACE_BYTES)
        self.hashes = self.words.hashes()

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the anchors."""
        period, cover = cover_for(length)
        starts = self.words.run_starts(length - period + 1)
        own = starts - np.repeat(self.words.first[:-1], self.words.counts)[starts]
        at = starts[np.isin(np.arange(period), cover)[own % period]]
        return at, run_hashes(self.hashes, length - period + 1)[at] if len(at) else np.empty(0, np.uint64)

    def windows(self, length: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows at the positions, as records of two numbers."""
        out = np.empty(len(at), [("a", np.uint64), ("b", np.uint32)])
        if len(at):
            out["a"] = run_hashes(self.hashes, length)[at]
            out["b"] = (run_hashes(self.words.hashes(1), length, 1)[at] >> np.uint64(32)).astype(np.uint32)
        return out

    def near_anchors(self, length: int, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors."""
        period, _ = cover_for(length)
        steps = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(steps, np.maximum(anchors - period + 1, 0), 1)
        np.add.at(steps, anchors + 1, -1)
        near = np.cumsum(steps[:-1]) > 0
        starts = self.words.run_starts(length)
        return starts[near[starts]]  # a window across two texts is none; one too many changes nothing


def _alike(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of its distinct value for each entry, index of one entry of each distinct value)."""
    lanes = [values[f] for f in reversed(values.dtype.names)] if values.dtype.names else [values]
    order = np.lexsort(lanes)
    new = np.zeros(len(values), bool)
    new[:1] = True
    for lane in lanes:
        ranked = lane[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _found_again(values: np.ndarray, at: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which values occur twice here, or are those at the answered places (elsewhere too)."""
    number, one = _alike(values)
    again = np.bincount(number, minlength=len(one)) > 1
    again[number[np.searchsorted(at, places)]] = True
    return again[number]


def _packed(g: int, buckets: int, values: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: the values (one of each) and their positions."""
    _, one = _alike(values)
    values, at = values[one], at[one]
    lead = values if values.dtype.names is None else values["a"]
    bucket = ((lead >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # grows with the value
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else np.array([0])
    rows = [values[a:b].tobytes() + at[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]] if len(bucket) else [], pa.int32()), pa.array([g] * len(rows), pa.int32()), pa.array(rows, pa.binary())],
        ["bucket", "g", "entries"],
    )


def _repeats(kind: np.dtype):
    """Per receiving task: the positions of entries that another group has too, by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, places, groups = [], [], []
        for batch in batches:
            for g, entries in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = entries.as_buffer()
                n = raw.size // (kind.itemsize + 4)
                values.append(np.frombuffer(raw, kind, n))
                places.append(np.frombuffer(raw, np.uint32, n, n * kind.itemsize))
                groups.append(np.full(n, g, np.int32))
        if not values:
            return
        number, one = _alike(np.concatenate(values))
        again = (np.bincount(number, minlength=len(one)) > 1)[number]
        place, group = np.concatenate(places)[again], np.concatenate(groups)[again]
        order = np.lexsort((place, group))
        place, group = place[order], group[order]
        cuts = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)])) if len(group) else np.array([0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(group[cuts[:-1]] if len(group) else [], pa.int32()), pa.array([place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
            ["g", "places"],
        )

    return run


def _places(answers: pa.Table) -> np.ndarray:
    found = [np.frombuffer(x.as_buffer(), np.uint32) for x in answers.column("places").combine_chunks()] if answers.num_rows else []
    return np.sort(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64)


_ANCHOR, _WINDOW = np.dtype(np.uint64), np.dtype([("a", np.uint64), ("b", np.uint32)])


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, group_bytes: int = GROUP_BYTES, hot_part: int = HOT_PART
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words left of each text, joined by one blank."""
    total, n_rows = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    n = max(1, -(-(total or 0) // group_bytes))
    buckets = max(min(n, LEAST_BUCKETS), n // GROUPS_SERVED)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    keyed = own.select("doc_id", "text", *row_keys("doc_id", "text"))
    hot = F.broadcast(repeated_rows(keyed.select("k1", "k2"), ["k1", "k2"], "rows", n_rows, hot_part))
    place, share = F.col("k1").alias("place"), F.lit(1).cast("bigint").alias("rows")
    single = keyed.join(hot, ["k1", "k2"], "left_anti").select("doc_id", "text", "k1", "k2", place, share)
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("rows") + COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE).cast("bigint"))
    place, share = F.xxhash64("k1", "begin").alias("place"), F.greatest(F.lit(0), F.least(F.lit(COPIES_AT_ONCE), F.col("rows") - F.col("begin")))
    few = one_of_each(keyed.join(hot, ["k1", "k2"]), ["k1", "k2"]).withColumn("begin", F.explode(begins))
    parts = single.unionByName(few.select("doc_id", "text", "k1", "k2", place, share.cast("bigint").alias("rows")))
    dealt = parts.select(F.pmod("place", F.lit(n)).cast("int").alias("g"), "doc_id", "text", "k1", "k2", "rows").repartitionById(n, F.col("g"))
    id_type = dealt.schema["doc_id"].dataType.simpleString()

    def number(key: tuple[pa.Scalar, ...]) -> int:
        return key[0].as_py()

    def send_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = Group(table)
        at, values = group.anchors(length)
        return pa.Table.from_batches([_packed(number(key), buckets, values, at)])

    def send_windows(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table)
        at, values = group.anchors(length)
        near = group.near_anchors(length, at[_found_again(values, at, _places(answers))]) if len(at) else at
        return pa.Table.from_batches([_packed(number(key), buckets, group.windows(length, near), near)])

    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table)
        words = group.words
        starts = words.run_starts(length)
        values = group.windows(length, starts)
        covered = np.zeros(len(words) + 1, np.int64)
        if len(starts):
            hit = starts[_found_again(values, starts, _places(answers))]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + length, -1)
        gone = np.cumsum(covered[:-1]) > 0
        removed = np.concatenate(([0], np.cumsum(gone)))[words.first]
        kept = []
        for d in range(len(words.counts)):
            left = words.data[words.offsets[d] : words.offsets[d + 1]].tobytes().split()
            if removed[d] != removed[d + 1]:
                left = [w for w, x in zip(left, gone[words.first[d] : words.first[d + 1]].tolist()) if not x]
            kept.append(b" ".join(left))
        return pa.table(
            {
                "doc_id": group.table.column("doc_id"),
                "n_words": pa.array(words.counts, pa.int64()),
                "n_removed": pa.array(np.diff(removed), pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "rows": group.table.column("rows"),
            }
        )

    def answered(sent: DataFrame, kind: np.dtype) -> DataFrame:
        return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_repeats(kind), _ANSWER).repartitionById(n, F.col("g"))

    texts = dealt.groupBy("g")
    shared_anchors = answered(texts.applyInArrow(send_anchors, _PACKED), _ANCHOR)
    shared_windows = answered(texts.cogroup(shared_anchors.groupBy("g")).applyInArrow(send_windows, _PACKED), _WINDOW)
    schema = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string, rows bigint"
    found = texts.cogroup(shared_windows.groupBy("g")).applyInArrow(remove, schema)
    return found.select("doc_id", "n_words", "n_removed", "kept", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("_row")).drop("_row")


def op9_substrings(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS MATERIALIZED (SELECT r, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS h
    FROM (SELECT r, w, unnest(range(1, len(w) - {LENGTH} + 2)) AS i FROM d WHERE len(w) >= {LENGTH})),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
cov AS (SELECT DISTINCT r, unnest(range(i, i + {LENGTH})) AS k FROM win SEMI JOIN rep USING (h)),
gone AS (SELECT r, list(k) AS ks FROM cov GROUP BY r),
left_over AS (SELECT doc_id, len(w) AS n, coalesce(len(ks), 0) AS g,
        CASE WHEN ks IS NULL THEN w ELSE list_filter(list_transform(range(1, len(w) + 1), lambda k: CASE WHEN list_contains(ks, k) THEN NULL ELSE w[k] END), lambda x: x IS NOT NULL) END AS kept
    FROM d LEFT JOIN gone USING (r))
SELECT doc_id, n::BIGINT AS n_words, g::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over
"""
