"""SimHash near-duplicates: candidates thinned by pivot distance tables, then verified.

A fingerprint has 64 bits.  Two of them link at ``max_distance`` or fewer differing bits.  Copies share a
fingerprint, so all work is done on distinct fingerprints:

* Cut into k pieces, two linked fingerprints agree on at least k - max_distance whole pieces.  Each
  fingerprint goes to one bucket per choice of such pieces; k grows with the number of fingerprints,
  so that chance neighbours in a bucket stay few at any size.  No link can be missed.
* In a bucket, the distances of every fingerprint to many reference fingerprints form a table.  By the triangle
  inequality a pair whose coordinates differ by more than ``max_distance`` anywhere is no link.
  What survives is verified bit by bit.
* A bucket yields the links of a spanning forest, never all pairs of a group.  A bucket
  above ``bucket_limit`` is dealt out over pairs of parts, which together still compare everything.

Defined results: a text without words has fingerprint zero, linked like any other; a null id never is the
smallest of a component, which is null if it has no other; repeated rows share a component.  Other columns are carried along if named, by names that the result has not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.components import components
from rosterloom.llm.skew import HOT_PART, join_counted
from rosterloom.llm.words import chunks
from rosterloom.sources.staging import materialize

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
N_PIVOTS = 16
BUCKET_LIMIT = 4096
#: Chance neighbours that a bucket may have on average.
NEIGHBOURS = 4


def fingerprint(shingle: int = SHINGLE):
    """Column function: the 64-bit SimHash of a text's word shingles, as BIGINT."""

    def of_texts(texts: pa.Array) -> pa.Array:
        out: list[int] = []
        digest = xxhash.xxh64_intdigest
        for chunk in chunks(texts):
            words = chunk.words(lower=True)
            sizes = words.end - words.start
            for d in range(len(chunk)):
                a, b = words.first[d], words.first[d + 1]
                if a == b:
                    out.append(0)
                    continue
                own = words.data[chunk.offsets[d] : chunk.offsets[d + 1]].tobytes()
                joined = b" ".join(own.split())
                begins = np.zeros(b - a, np.int64)
                np.cumsum(sizes[a : b - 1] + 1, out=begins[1:])
                last = min(shingle, b - a) - 1
                ends = (begins + sizes[a:b])[last:]
                hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(begins.tolist(), ends.tolist())], np.uint64)
                ones = np.zeros(64, np.int64)
                for k in range(0, len(hashes), 1 << 16):
                    ones += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                out.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0]))
        return pa.array(out, pa.int64())

    return F.arrow_udf(of_texts, "bigint").asNondeterministic()


def piece_masks(n: int, max_distance: int = MAX_DISTANCE) -> list[int]:
    """Bit masks of all choices of pieces that two linked fingerprints may agree on.

    The number of pieces is the least that leaves few chance neighbours among n fingerprints.
    """
    k = max_distance + 1
    while k < 16 and n >> ((k - max_distance) * 64 // k) > NEIGHBOURS:
        k += 1
    cuts = [64 * i // k for i in range(k + 1)]
    pieces = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(k)]
    return [sum(chosen) for chosen in combinations(pieces, k - max_distance)]


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints, spread by chance over all of them."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], np.uint64)


def _forest(fps: np.ndarray, table: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Links (as indexes) that connect what is linked in one bucket, without listing all pairs."""
    order = np.argsort(table[:, 0], kind="stable")
    rest = order
    while len(rest) > 1:
        root, rest = int(rest[0]), rest[1:]
        frontier = [root]
        while frontier and len(rest):
            x = frontier.pop()
            first = table[rest, 0]
            lo, hi = np.searchsorted(first, [table[x, 0] - limit, table[x, 0] + limit + 1])
            near = np.arange(lo, hi)
            for p in range(1, table.shape[1]):  # the largest coordinate difference decides
                near = near[np.abs(table[rest[near], p] - table[x, p]) <= limit]
                if len(near) < 16:
                    near = near[(np.abs(table[rest[near]] - table[x]).max(axis=1, initial=0)) <= limit]
                    break
            near = near[np.bitwise_count(fps[rest[near]] ^ fps[x]) <= limit]
            if len(near):
                found = rest[near]
                for y in found.tolist():
                    yield root, y
                frontier += found.tolist()
                rest = np.delete(rest, near)


def _bucket_links(limit: int):
    marks = pivots()

    def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket number, fingerprint) of complete buckets, in step with the sorted input."""
        left: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            if left is not None:
                keys, fps = np.concatenate([left[0], keys]), np.concatenate([left[1], fps])
            if not len(keys):
                continue
            edge = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            cut = edge[-1] + 1 if len(edge) else 0
            left = keys[cut:], fps[cut:]
            if cut:
                yield keys[:cut], fps[:cut]
        if left is not None and len(left[0]):
            yield left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in whole_buckets(batches):
            begins = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            sizes = np.diff(begins)
            two = begins[:-1][sizes == 2]
            keep = np.ones(len(two), bool)
            for p in marks:  # pairs alone in their bucket, all at once
                keep &= np.abs(np.bitwise_count(fps[two] ^ p).astype(np.int8) - np.bitwise_count(fps[two + 1] ^ p).astype(np.int8)) <= limit
            two = two[keep]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= limit]
            u, v = [fps[two]], [fps[two + 1]]
            for a, n in zip(begins[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                own = fps[a : a + n]
                table = np.bitwise_count(own[:, None] ^ marks[None, :]).astype(np.int8)
                links = np.array(list(_forest(own, table, limit)), np.int64).reshape(-1, 2)
                u.append(own[links[:, 0]])
                v.append(own[links[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], ["u", "v"])

    return run


def links(distinct: DataFrame, n: int, max_distance: int = MAX_DISTANCE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (u, v) between the ``n`` distinct fingerprints ``fp``, enough to connect all that are linked."""
    masks = piece_masks(n, max_distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "piece"))
    crowded = keyed.groupBy("choice", "piece").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit)
    parts = F.coalesce(F.ceil(F.col("n") * F.lit(2) / bucket_limit), F.lit(1)).cast("int")
    dealt = keyed.join(crowded, ["choice", "piece"], "left").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("part"))
    pair = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.transform(others, lambda x: F.least(x, F.col("part")) * F.col("parts").cast("bigint") + F.greatest(x, F.col("part")))
    )
    buckets = dealt.select("choice", "piece", F.explode(pair).alias("pair"), "fp")
    spread = buckets.repartition("choice", "piece", "pair").sortWithinPartitions("choice", "piece", "pair")
    return spread.mapInArrow(_bucket_links(max_distance), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE, bucket_limit: int = BUCKET_LIMIT, carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, fp, component_id, component, and the columns ``carry``) per row.

    ``component`` is a fingerprint of the component, never null.  Fingerprints are computed at once and checkpointed.
    """
    marked = materialize(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(shingle)(F.col(text)).alias("fp"), *carry))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    found = components(links(distinct.select("fp"), distinct.count(), max_distance, bucket_limit))
    named = found.join(distinct, found["node"] == distinct["fp"]).select("fp", "root", "low")
    lowest = named.groupBy("root").agg(F.min("low").alias("lowest"))
    linked = named.join(lowest, "root").select("fp", "root", "lowest")
    labels = distinct.join(linked, "fp", "left").select("fp", "n", F.coalesce("lowest", "low").alias("component_id"), F.coalesce("root", "fp").alias("component"))
    return join_counted(marked, labels, ["fp"], "n", marked.count()).select("doc_id", "fp", "component_id", "component", *carry)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_part: int = HOT_PART) -> DataFrame:
    """One row of each component: that with the smallest (id, fingerprint, hash of the row), rows without id last.

    Rows are told apart by 128 bits of hash over all their columns but maps, so equal ids may have different
    texts; of rows equal in all columns one stays.  Rows repeated very often are not shuffled as such: their keys,
    fewer than ``hot_part``, are broadcast, and copies meet after each task has dropped its own.
    """
    used = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    keys = ["_key_1", "_key_2"]
    # A null leaves a hash as it is, so places of nulls are hashed as well.
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in used])
    keyed = docs.select("*", F.xxhash64(nulls, *used).alias(keys[0]), F.xxhash64(F.lit(1), nulls, *used).alias(keys[1]))
    rows = near_duplicates(keyed, doc_id, text, carry=keys)
    known = materialize(rows.groupBy("component", "doc_id", "fp", *keys).agg(F.count(F.lit(1)).alias("_n")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", *keys, "_n")).alias("_first")
    stay = known.groupBy("component").agg(first).select(*[f"_first.{c}" for c in (*keys, "_n")])
    limit = max(1, (known.agg(F.sum("_n")).first()[0] or 0) // hot_part)
    hot = F.broadcast(known.where(F.col("_n") > limit).select(*keys))
    rest = keyed.join(hot, keys, "left_anti").join(stay.where(F.col("_n") <= limit), keys, "left_semi")
    repeated = keyed.join(F.broadcast(stay.where(F.col("_n") > limit)), keys, "left_semi")
    return rest.dropDuplicates(keys).unionByName(repeated.dropDuplicates(keys)).drop(*keys)
