"""Line deduplication through sharded minimal perfect hashes.

A line's key is the line without white space at its ends, A-Z lower-cased.  A key of at least ``min_chars`` code points
that several documents hold loses all its lines except in the document with the smallest id.

1. Keys are hashed to 128 bits; partial sums give each key's smallest and largest document, so a frequent
   line is pre-aggregated.  Only keys of several documents go on.
2. Each shard of these keys becomes a minimal perfect hash (levels of bits; a key's place is the rank
   of its bit) that indexes three compact arrays: a 64-bit fingerprint, the count, and the owner.
3. Documents probe the arrays.  If all of them take at most ``broadcast_bytes`` (counted first) they are broadcast
   and no text is shuffled.  Otherwise the line hashes are sent to the shards, a shard with many lines
   being repeated over salts, and the answers come back by a key of the row.

Defined results: a null or empty text is one empty line; rows without id count as one document that owns nothing
another one holds; repeated rows are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.words import mix, plain
from rosterloom.sources.staging import materialize

MIN_CHARS = 10
BROADCAST_BYTES = 64 << 20
SHARD_KEYS = 1 << 16
#: Lines that one probing task gets from a shard.
PROBES = 1 << 20
ENTRY_BYTES = 21
_LEVELS, _ROOM = 48, 2


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough."""
    for number, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            yield number, key


def _texts(column: pa.Array) -> list[bytes]:
    return plain(column).cast(pa.large_binary()).to_pylist()


def hashed_lines(texts: list[bytes], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, first hash, second hash) of all long enough lines."""
    row, number, digests = [], [], bytearray()
    for k, text in enumerate(texts):
        for n, key in line_keys(text, min_chars):
            row.append(k)
            number.append(n)
            digests += xxhash.xxh3_128_digest(key)
    both = np.frombuffer(bytes(digests), ">u8").astype(np.uint64).reshape(-1, 2)
    return np.array(row, np.int64), np.array(number, np.int64), both[:, 0], both[:, 1]


class PerfectHash:
    """Places 0..n-1 for n distinct keys of two 64-bit numbers; a foreign key gets some place or -1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits  # bits: one byte each, levels one after another
        self.ranks = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))[:-1]

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], np.arange(len(first))
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys are not distinct")
            size = _ROOM * len(left)
            at = cls._slot(first[left], second[left], len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            sizes.append(size)
            levels.append(bits)
            left = left[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool))

    @staticmethod
    def _slot(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
        return (mix(mix(first + step) + second) % np.uint64(size)).astype(np.int64)

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out, waiting, base = np.full(len(first), -1, np.int64), np.arange(len(first)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + self._slot(first[waiting], second[waiting], level, size)
            hit = self.bits[at]
            out[waiting[hit]] = self.ranks[at[hit]]
            waiting, base = waiting[~hit], base + size
        return out


class Shard:
    """A perfect hash with its arrays, from a row of :func:`shards`."""

    def __init__(self, sizes: bytes, bits: bytes, fingerprints: bytes, owners: pa.Array):
        n = np.frombuffer(sizes, np.int64)
        self.hash = PerfectHash(n, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n.sum())).astype(bool))
        self.fingerprints, self.owners = np.frombuffer(fingerprints, np.uint64), owners

    def others(self, first: np.ndarray, second: np.ndarray, ids: pa.Array) -> np.ndarray:
        """Which lines are known here and owned by another document than the given one."""
        place = self.hash.places(first, second)
        known = np.flatnonzero(place >= 0)
        known = known[self.fingerprints[place[known]] == second[known]]
        owner = self.owners.take(pa.array(place[known]))
        own = pc.fill_null(pc.equal(owner, ids.take(pa.array(known))), False).to_numpy(zero_copy_only=False)
        out = np.zeros(len(first), bool)
        out[known] = ~own
        return out


def repeated_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, n, owner): the keys that several documents hold, with their number of lines."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, _, first, second = hashed_lines(_texts(batch.column(1)), min_chars)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), batch.column(0).take(pa.array(row))], ["h1", "h2", "doc"]
            )

    lines = docs.select(doc_id, text).mapInArrow(cut, f"h1 bigint, h2 bigint, doc {id_type}")
    counted = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc").alias("owner"), F.max("doc").alias("last"), F.max(F.col("doc").isNull()).alias("nameless")
    )
    several = (F.col("owner") < F.col("last")) | (F.col("nameless") & F.col("owner").isNotNull())
    return counted.where(several).select("h1", "h2", "n", "owner")


def shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: shard, lines (their number), and the arrays as binary columns."""
    id_type = keys.schema["owner"].dataType.simpleString()

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        first = table.column("h1").to_numpy().view(np.uint64)
        second = table.column("h2").to_numpy().view(np.uint64)
        hashed = PerfectHash.of(first, second)
        order = np.argsort(hashed.places(first, second))
        counts = np.minimum(table.column("n").to_numpy(), 2**32 - 1).astype(np.uint32)
        owners = table.column("owner").combine_chunks().take(pa.array(order))
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()),
                "lines": pa.array([int(counts.sum(dtype=np.int64))], pa.int64()),
                "sizes": pa.array([hashed.sizes.tobytes()], pa.binary()),
                "bits": pa.array([np.packbits(hashed.bits).tobytes()], pa.binary()),
                "fingerprints": pa.array([second[order].tobytes()], pa.binary()),
                "counts": pa.array([counts[order].tobytes()], pa.binary()),
                "owners": pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners),
            }
        )

    schema = f"shard int, lines bigint, sizes binary, bits binary, fingerprints binary, counts binary, owners array<{id_type}>"
    return keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int")).groupBy("shard").applyInArrow(build, schema)


def _load(table: pa.Table) -> dict[int, Shard]:
    columns = [table.column(c).to_pylist() for c in ("shard", "sizes", "bits", "fingerprints")]
    owners = table.column("owners").combine_chunks()
    return {s: Shard(a, b, f, owners[k].values) for k, (s, a, b, f) in enumerate(zip(*columns))}


def _cut_texts(texts: list[bytes], row: np.ndarray, number: np.ndarray, gone: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(n_lines, n_dropped, kept) when the marked lines go."""
    dropped: dict[int, list[int]] = {}
    for k, n in zip(row[gone].tolist(), number[gone].tolist()):
        dropped.setdefault(k, []).append(n)
    kept = list(texts)
    for k, numbers in dropped.items():
        out = set(numbers)
        kept[k] = b"\n".join(line for n, line in enumerate(texts[k].split(b"\n")) if n not in out)
    return (
        pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
        pa.array([len(dropped.get(k, ())) for k in range(len(texts))], pa.int64()),
        pa.array(kept, pa.binary()).cast(pa.string()),
    )


_RESULT = "struct<n_lines:bigint,n_dropped:bigint,kept:string>"


def _as_struct(arrays: tuple[pa.Array, pa.Array, pa.Array]) -> pa.Array:
    return pa.StructArray.from_arrays(list(arrays), ["n_lines", "n_dropped", "kept"])


def _probe_broadcast(docs: DataFrame, doc_id: str, text: str, built: DataFrame, n_shards: int, min_chars: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(built.toArrow())
    loaded: list[dict[int, Shard]] = []

    def probe(ids: pa.Array, texts: pa.Array) -> pa.Array:
        if not loaded:
            loaded.append(_load(shared.value))
        own = _texts(texts)
        row, number, first, second = hashed_lines(own, min_chars)
        shard = first.view(np.int64) % n_shards
        order = np.argsort(shard, kind="stable")
        gone = np.zeros(len(row), bool)
        cuts = np.searchsorted(shard[order], np.arange(n_shards + 1))
        for s, known in loaded[0].items():
            at = order[cuts[s] : cuts[s + 1]]
            gone[at] = known.others(first[at], second[at], ids.take(pa.array(row[at])))
        return _as_struct(_cut_texts(own, row, number, gone))

    return docs.withColumn("lines", F.arrow_udf(probe, _RESULT).asNondeterministic()(F.col(doc_id), F.col(text)))


def _probe_routed(docs: DataFrame, doc_id: str, text: str, built: DataFrame, n_shards: int, min_chars: int, probes: int) -> DataFrame:
    id_type = docs.schema[doc_id].dataType.simpleString()
    crowded = {r.shard: -(-r.lines // probes) for r in built.where(F.col("lines") > probes).select("shard", "lines").collect()}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "lines"]).alias("_row")
    key = [F.xxhash64(doc_id, text).alias("_k1"), F.xxhash64(F.lit(1), doc_id, text).alias("_k2")]
    keyed = docs.select(row, F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), *key)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, _, first, second = hashed_lines(_texts(batch.column(3)), min_chars)
            shard = (first.view(np.int64) % n_shards).astype(np.int32)
            salts = np.ones(n_shards, np.int64)
            for s, n in crowded.items():
                salts[s] = n
            at = pa.array(row)
            salt = (batch.column(0).take(at).to_numpy() % salts[shard]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(salt), *[batch.column(i).take(at) for i in range(3)], pa.array(first.view(np.int64)), pa.array(second.view(np.int64))],
                ["shard", "salt", "_k1", "_k2", "doc", "h1", "h2"],
            )

    sent = keyed.select("_k1", "_k2", F.col("_doc").alias("doc"), "_text").mapInArrow(
        send, f"shard int, salt int, _k1 bigint, _k2 bigint, doc {id_type}, h1 bigint, h2 bigint"
    )
    limits = F.greatest(F.ceil(F.col("lines") / F.lit(probes)), F.lit(1)).cast("int")
    repeated = built.withColumn("salt", F.explode(F.sequence(F.lit(0), limits - 1)))

    def answer(key: tuple[pa.Scalar, ...], lines: pa.Table, arrays: pa.Table) -> pa.Table:
        if not arrays.num_rows or not lines.num_rows:
            return lines.slice(0, 0).select(["_k1", "_k2", "h1", "h2"])
        (known,) = _load(arrays).values()
        first, second = (lines.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        gone = known.others(first, second, lines.column("doc").combine_chunks())
        return lines.filter(pa.array(gone)).select(["_k1", "_k2", "h1", "h2"])

    answers = sent.groupBy("shard", "salt").cogroup(repeated.groupBy("shard", "salt")).applyInArrow(answer, "_k1 bigint, _k2 bigint, h1 bigint, h2 bigint")
    gone = answers.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("h1", "h2")).alias("_gone"))  # at most the lines of a text

    def cut(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        own = _texts(texts)
        row, number, first, second = hashed_lines(own, min_chars)
        out = [{(x["h1"], x["h2"]) for x in found or ()} for found in hashes.to_pylist()]
        pairs = zip(row.tolist(), first.view(np.int64).tolist(), second.view(np.int64).tolist())
        return _as_struct(_cut_texts(own, row, number, np.array([(a, b) in out[k] for k, a, b in pairs], bool)))

    answered = keyed.join(gone, ["_k1", "_k2"], "left")
    done = answered.withColumn("lines", F.arrow_udf(cut, _RESULT).asNondeterministic()(F.col("_text"), F.col("_gone")))
    return done.select("_row.*", "lines")


def dedupe_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = SHARD_KEYS, probes: int = PROBES,
) -> DataFrame:
    """Adds ``lines``: struct of n_lines, n_dropped and kept (the text that is left).

    A column of that name is replaced; the other columns stay as they are, whatever their names.
    The repeated keys are found, and their arrays built, at once.
    """
    keys = materialize(repeated_keys(docs, doc_id, text, min_chars))
    n = keys.count()
    n_shards = max(1, -(-n // shard_keys))
    built = shards(keys, n_shards)
    if n * ENTRY_BYTES <= broadcast_bytes:
        return _probe_broadcast(docs, doc_id, text, built, n_shards, min_chars)
    return _probe_routed(docs, doc_id, text, materialize(built), n_shards, min_chars, probes)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedupe_lines(docs).select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


OP8_SQL = """
WITH l AS MATERIALIZED (
    SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
rep AS (SELECT key, min(doc_id) AS low FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT l.*, coalesce(low <> doc_id, false) AS gone FROM l LEFT JOIN rep USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
