"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

A tokenizes a blank and the text, B the text (its vocabulary puts the blank in front itself), so the tokens of both
cover the same bytes.  Row i of an incidence matrix holds the bytes of token i.  Matrices are compressed rows (CSR)
built by hand; all texts of a chunk lie on one byte axis, as the products never leave a text:

* A·Bᵀ, row by row (Gustavson: row i is the sum of the rows k of Bᵀ over the bytes k of token i), holds for every
  pair of tokens the number of bytes they share: the *overlap* links.  Those whose ranges end together are *end* links.
* Bytes where tokens of both end cut the tokens into groups.  With token-by-group matrices the same product gives the
  *group* links; its size is known before it is computed, and it is computed in blocks of rows.

Where both tokenizers surely begin a token, texts are cut, and each distinct stretch of a batch is aligned once; a bounded
number of them is remembered (:class:`Stretches`).  Texts are never cut off.

How often a pair of ids is linked corpus-wide is counted per task in one array and added up.  Tokens that end
together are such that the bytes of one end with the bytes of the other, so the two vocabularies alone bound the number of
pairs by their total length (:func:`possible_pairs`, about 324,000 here); only that table reaches the driver and the workers.
Per-text results are written once to the shared folder, as counts need all texts before any text gets its sums.

Defined results: texts that are null, empty or whose tokens do not give back their bytes (those with U+2581, which B
reads as a blank) have no tokens: all numbers are 0 and the hash is ''.  Repeated rows count each.  Columns
of ``docs`` other than id and text are not carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.packing import PieceTokenizer, vocabulary_path
from rosterloom.llm.sentencepieces import BYTE, NORMAL, agenda_of, gathered, model_path
from rosterloom.llm.words import chunks, plain
from rosterloom.sources.staging import staging_path

CHUNK_BYTES = 2 << 20
BLOCK = 1 << 20
CACHED_STRETCHES, CACHED_BYTES, LEARNED_STRETCHES = 1 << 19, 1 << 25, 1 << 15


class Sparse(NamedTuple):
    """Compressed rows: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row i, ``data`` their values."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Sparse:
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.columns)
        return Sparse(np.concatenate(([0], np.cumsum(counts))), self.rows()[order], self.data[order], len(self.indptr) - 1)


def spans(ends: np.ndarray) -> Sparse:
    """Token by byte: token i covers the bytes from the end of the token before it to its own."""
    total = int(ends[-1]) if len(ends) else 0
    return Sparse(np.concatenate(([0], ends)), np.arange(total), np.ones(total, np.int64), total)


def members(group: np.ndarray, groups: int) -> Sparse:
    """Token by group: every token is in one."""
    return Sparse(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


def product_size(left: Sparse, right: Sparse) -> int:
    """Multiplications of ``left`` times ``right``: the number of entries where no sum has two terms."""
    return int(np.diff(right.indptr)[left.indices].sum())


def product(left: Sparse, right: Sparse, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of ``left`` times ``right``, in row order, some whole rows at a time."""
    width = np.diff(right.indptr)
    upto = np.concatenate(([0], np.cumsum(width[left.indices])))[left.indptr]  # multiplications before each row
    a = 0
    while a < len(left.indptr) - 1:
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + block, side="right")) - 1)
        own = slice(left.indptr[a], left.indptr[b])
        inner = left.indices[own]
        counts = width[inner]
        row = np.repeat(np.repeat(np.arange(a, b), np.diff(left.indptr[a : b + 1])), counts)
        column = gathered(right.indices, right.indptr[inner], counts)
        value = np.repeat(left.data[own], counts) * gathered(right.data, right.indptr[inner], counts)
        key = row * right.columns + column
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            row, column, value, key = row[order], column[order], value[order], key[order]
        if len(key):
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            yield row[first], column[first], np.add.reduceat(value, first)
        a = b


class Sides:
    """Both tokenizers, the bytes of their tokens, and the pairs of ids that can end together."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = PieceTokenizer(a_path), agenda_of(b_path)
        shown = [self.a.model.decode_single_token_bytes(i) if n else b"" for i, n in enumerate(self.a.token_bytes.tolist())]
        self.a_bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.a_begins = np.cumsum(self.a.token_bytes) - self.a.token_bytes
        self.pairs = possible_pairs(dict(enumerate(shown)), self.b_tokens())
        self.digits, self.digit_sizes = decimal_table(max(len(shown), len(self.b.sizes)))
        self.digit_begins = np.cumsum(self.digit_sizes) - self.digit_sizes

    def b_tokens(self) -> dict[int, bytes]:
        data = self.b.shown.tobytes()
        usual = np.flatnonzero((self.b.kinds == NORMAL) | (self.b.kinds == BYTE)).tolist()
        return {i: data[self.b.begins[i] : self.b.begins[i] + self.b.sizes[i]] for i in usual}


def possible_pairs(a: dict[int, bytes], b: dict[int, bytes]) -> np.ndarray:
    """Sorted a << 32 | b of all ids of which one token ends with the other's bytes."""
    by_bytes = defaultdict(list), defaultdict(list)
    for side, tokens in zip(by_bytes, (a, b)):
        for i, token in tokens.items():
            if token:
                side[token].append(i)
    found = set()
    for token, own in by_bytes[0].items():
        for k in range(len(token)):
            found.update(i << 32 | j for j in by_bytes[1].get(token[k:], ()) for i in own)
    for token, own in by_bytes[1].items():
        for k in range(len(token)):
            found.update(i << 32 | j for i in by_bytes[0].get(token[k:], ()) for j in own)
    return np.array(sorted(found), np.int64)


def decimal_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, each with a byte behind it for a separator."""
    shown = [b"%d," % i for i in range(n)]
    return np.frombuffer(b"".join(shown), np.uint8), np.array([len(x) for x in shown], np.int64)


class Aligned:
    """Tokens of some texts: ids and ends (on one byte axis) of A and B, and each text's first token of both.

    ``rows`` are the bytes the tokens should give back; a text whose tokens do not has none.
    """

    def __init__(self, sides: Sides, rows: list[bytes], a_lists: list[np.ndarray], b_ids: np.ndarray, b_first: np.ndarray):
        b_sizes = sides.b.sizes[b_ids]
        a_all, a_upto = np.concatenate([np.zeros(0, np.int64), *a_lists]).astype(np.int64), np.cumsum([0, *map(len, a_lists)])
        a_sizes = sides.a.token_bytes[a_all]
        a_data, a_bytes = gathered(sides.a_bytes, sides.a_begins[a_all], a_sizes).tobytes(), np.concatenate(([0], np.cumsum(a_sizes)))[a_upto].tolist()
        b_data, b_bytes = gathered(sides.b.shown, sides.b.begins[b_ids], b_sizes).tobytes(), np.concatenate(([0], np.cumsum(b_sizes)))[b_first].tolist()
        used = [bool(w) and w == a_data[s:e] and w == b_data[t:f] for w, s, e, t, f in zip(rows, a_bytes, a_bytes[1:], b_bytes, b_bytes[1:])]
        self.used = np.array(used, bool)
        self.a_ids, self.b_ids = a_all[np.repeat(self.used, np.diff(a_upto))], b_ids[np.repeat(self.used, np.diff(b_first))].astype(np.int64)
        self.a_first, self.b_first = (np.concatenate(([0], np.cumsum(np.where(self.used, np.diff(n), 0)))) for n in (a_upto, b_first))
        self.a_ends, self.b_ends = np.cumsum(sides.a.token_bytes[self.a_ids]), np.cumsum(sides.b.sizes[self.b_ids])

    @classmethod
    def of_texts(cls, sides: Sides, texts: pa.Array) -> Aligned:
        whole = with_blank(texts)
        return cls(sides, [t.encode() for t in whole.to_pylist()], [x[:-1] for x in sides.a.encode(whole)], *sides.b.encode(texts))

    @classmethod
    def of_stretches(cls, sides: Sides, stretches: list[bytes]) -> Aligned:
        encode, lists = sides.a.model.encode_ordinary, [sides.b.stretch_ids(s) for s in stretches]
        b_ids = np.array([i for own in lists for i in own], np.int64)
        return cls(sides, stretches, [np.array(encode(s.decode()), np.int64) for s in stretches], b_ids, np.cumsum([0, *map(len, lists)]))

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes) of the overlap links."""
        return product(spans(self.a_ends), spans(self.b_ends).transposed())

    def end_links(self) -> tuple[np.ndarray, np.ndarray, int]:
        """A and B tokens of the links that end together, and the number of all overlap links."""
        a, b, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for i, j, _ in self.overlaps():
            together = self.a_ends[i] == self.b_ends[j]
            a.append(i[together])
            b.append(j[together])
            n += len(i)
        return np.concatenate(a), np.concatenate(b), n

    def grouped(self, a_links: np.ndarray) -> tuple[Sparse, Sparse]:
        """Token-by-group matrices of A and B; the end links' A tokens are the last of their groups."""
        ends = self.a_ends[a_links]
        return tuple(members(np.searchsorted(ends, own), len(ends)) for own in (self.a_ends, self.b_ends))

    def group_text(self, sides: Sides, a: Sparse, b: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ``a1,a2|b1;a3|b2,b3;`` and where each text's part begins in them."""
        a_rows, b_rows = a.transposed().indptr, b.transposed().indptr  # groups as rows
        ids, marks = np.empty(len(self.a_ids) + len(self.b_ids), np.int64), np.full(len(self.a_ids) + len(self.b_ids), 0x2C, np.uint8)
        ids[np.arange(len(self.a_ids)) + b_rows[a.indices]] = self.a_ids
        ids[np.arange(len(self.b_ids)) + a_rows[b.indices + 1]] = self.b_ids
        marks[a_rows[1:] + b_rows[:-1] - 1] = 0x7C
        marks[a_rows[1:] + b_rows[1:] - 1] = 0x3B
        sizes = sides.digit_sizes[ids]
        text, ends = gathered(sides.digits, sides.digit_begins[ids], sizes), np.concatenate(([0], np.cumsum(sizes)))
        text[ends[1:] - 1] = marks
        return text, ends[self.a_first + self.b_first]


_sides: dict[tuple[str, str], Sides] = {}


def sides_of(a_path: str, b_path: str) -> Sides:
    """Both vocabularies, read once per process."""
    if (a_path, b_path) not in _sides:
        _sides[a_path, b_path] = Sides(a_path, b_path)
    return _sides[a_path, b_path]


SUMMARY = "struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, n_overlaps: bigint, n_shared: bigint, groups_sha256: string, pairs: array<int>>"
SUMMARY_TYPE = pa.struct(
    [*[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared")], ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32()))]
)


class Stretches:
    """What is known of the stretches met so far; both tokenizers surely begin a token where a stretch begins.

    So a stretch holds whole groups, and a text's groups and links are those of its stretches in a row.
    """

    def __init__(self, sides: Sides):
        self.sides = sides
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        #: Per stretch: tokens of A and B, end links, group links, bytes of its group text, and 1 if it has no alignment.
        self.numbers = np.zeros((0, 6), np.int64)
        self.text_starts, self.pair_starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.text, self.pairs = np.zeros(0, np.uint8), np.zeros(0, np.int32)

    def _learn(self, new: list[bytes]) -> None:
        own = Aligned.of_stretches(self.sides, new)
        a_links, b_links, _ = own.end_links()
        a, b = own.grouped(a_links)
        text, begins = own.group_text(self.sides, a, b)
        links = np.searchsorted(a_links, own.a_first)  # links before each stretch; its groups end with its links
        shared = np.concatenate(([0], np.cumsum(np.diff(b.transposed().indptr)[a.indices])))[own.a_first]
        pairs = np.searchsorted(self.sides.pairs, own.a_ids[a_links] << 32 | own.b_ids[b_links])
        columns = [*map(np.diff, (own.a_first, own.b_first, links, shared, begins)), ~own.used]
        self.text_starts = np.concatenate([self.text_starts, len(self.text) + begins[:-1]])
        self.pair_starts = np.concatenate([self.pair_starts, len(self.pairs) + links[:-1]])
        self.text, self.pairs = np.concatenate([self.text, text]), np.concatenate([self.pairs, pairs.astype(np.int32)])
        self.numbers = np.concatenate([self.numbers, np.stack(columns, axis=1).astype(np.int64)])
        for k, s in enumerate(new, len(self.known)):
            self.known[s] = k

    def places(self, stretches: list[bytes]) -> np.ndarray:
        found = [*map(self.known.get, stretches)]
        if None in found:
            new = [s for s, k in zip(stretches, found) if k is None]
            if self.known and (len(self.known) + len(new) > CACHED_STRETCHES or len(self.text) > CACHED_BYTES):
                self._forget()
                new = stretches
            for k in range(0, len(new), LEARNED_STRETCHES):
                self._learn(new[k : k + LEARNED_STRETCHES])
            found = [*map(self.known.get, stretches)]
        return np.array(found, np.int64)

    def summary(self, texts: pa.Array) -> pa.Array:
        """The struct of SUMMARY for some whole texts."""
        out = []
        for chunk in chunks(with_blank(texts), CHUNK_BYTES):
            data, offsets = chunk.data, chunk.offsets
            cut = self.sides.a.cuts(data, offsets) & self.sides.b.cuts(data, offsets)
            bounds = np.flatnonzero(cut) if len(data) else np.zeros(1, np.int64)
            coded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
            ).dictionary_encode()
            places = self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            first = np.searchsorted(bounds, offsets)
            wrong = np.concatenate(([0], np.cumsum(self.numbers[places, 5])))[first]
            used = (np.diff(first) > 0) & (np.diff(wrong) == 0)
            places = places[np.repeat(used, np.diff(first))]
            first = np.concatenate(([0], np.cumsum(np.where(used, np.diff(first), 0))))
            upto = np.concatenate((np.zeros((1, 6), np.int64), np.cumsum(self.numbers[places], axis=0)))[first]
            n_a, n_b, n_links, n_shared = np.diff(upto[:, :4], axis=0).T
            text = gathered(self.text, self.text_starts[places], self.numbers[places, 4]).tobytes()
            ends = upto[:, 4].tolist()
            hashes = [hashlib.sha256(text[s : e - 1]).hexdigest() if u else "" for u, s, e in zip(used.tolist(), ends, ends[1:])]
            pairs = gathered(self.pairs, self.pair_starts[places], self.numbers[places, 2])
            lists = pa.ListArray.from_arrays(pa.array(upto[:, 2], pa.int32()), pa.array(pairs, pa.int32()))
            # Tokens cover the bytes of a text without a gap, so each end of A's or B's begins the next overlap.
            numbers = [pa.array(np.ascontiguousarray(x)) for x in (n_a, n_b, n_links, n_links, n_a + n_b - n_links, n_shared)]
            out.append(pa.StructArray.from_arrays([*numbers, pa.array(hashes, pa.string()), lists], fields=list(SUMMARY_TYPE)))
        return pa.concat_arrays(out) if out else pa.array([], SUMMARY_TYPE)


def with_blank(texts: pa.Array) -> pa.Array:
    """A blank before each text; null and empty texts stay empty."""
    own = plain(texts)
    blank, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    return pc.if_else(pc.equal(own, none), own, pc.binary_join_element_wise(blank, own, none))


_stretches: dict[tuple[str, str], Stretches] = {}


def _summary(a_path: str, b_path: str, texts: pa.Array) -> pa.Array:
    if (a_path, b_path) not in _stretches:
        _stretches[a_path, b_path] = Stretches(sides_of(a_path, b_path))
    return _stretches[a_path, b_path].summary(texts)


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id and, per text, numbers of tokens, groups and links, the hash of its groups, and ``pairs``.

    ``pairs`` holds for each end link the place of its two ids in :func:`possible_pairs`.
    """
    a_path, b_path = a_path or vocabulary_path(), b_path or model_path()

    def run(texts: pa.Array) -> pa.Array:
        return _summary(a_path, b_path, texts)

    column = F.arrow_udf(run, SUMMARY).asNondeterministic()(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), column.alias("_found")).select("doc_id", "_found.*")


def token_links(
    docs: DataFrame, kind: str = "overlap", doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """(doc_id, a, b, a_id, b_id, weight): places in the text and ids of the linked tokens.

    ``kind`` is overlap (weight: shared bytes), end (the same, ends together) or group (weight 1).
    """
    if kind not in ("overlap", "end", "group"):
        raise ValueError("kind is overlap, end or group")
    a_path, b_path = a_path or vocabulary_path(), b_path or model_path()
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(a_path, b_path)
        for batch in batches:
            done = 0
            for chunk in chunks(batch.column(1)):
                part = batch.column(1).slice(chunk.first_row, len(chunk))
                own = Aligned.of_texts(sides, part)
                links = own.overlaps()
                if kind == "group":
                    a, b = own.grouped(own.end_links()[0])
                    links = product(a, b.transposed())
                for i, j, weight in links:
                    if kind == "end":
                        together = own.a_ends[i] == own.b_ends[j]
                        i, j, weight = i[together], j[together], weight[together]
                    doc = np.searchsorted(own.a_first, i, side="right") - 1
                    columns = [i - own.a_first[doc], j - own.b_first[doc], own.a_ids[i], own.b_ids[j], weight]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(doc + done)), *[pa.array(x, pa.int64()) for x in columns]], ["doc_id", "a", "b", "a_id", "b_id", "weight"]
                    )
                done += len(part)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, a bigint, b bigint, a_id bigint, b_id bigint, weight bigint")


def pair_counts(aligned: DataFrame, n_pairs: int) -> DataFrame:
    """(pair, n): how many links of the whole table hold each pair; at most ``n_pairs`` rows per task are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_pairs)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def best_partners(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether no other A id is linked with the pair's B id more often; ties are all best."""
    b = pairs & 0xFFFFFFFF
    most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, b, counts)
    return (counts == most[b]) & (counts > 0)


def with_corpus_counts(aligned: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Adds n_best and count_sum; ``aligned`` is a stored table, as it is read twice."""
    pairs = sides_of(a_path or vocabulary_path(), b_path or model_path()).pairs
    counts = np.zeros(len(pairs), np.int64)
    found = pair_counts(aligned, len(pairs)).toArrow()
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    best = best_partners(pairs, counts)

    def sums(lists: pa.Array) -> pa.Array:
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        own = lists.flatten().to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        totals = [np.diff(np.concatenate(([0], np.cumsum(x[own], dtype=np.int64)))[upto]) for x in (best, counts)]
        return pa.StructArray.from_arrays([pa.array(x) for x in totals], ["n_best", "count_sum"])

    column = F.arrow_udf(sums, "struct<n_best: bigint, count_sum: bigint>").asNondeterministic()(F.col("pairs"))
    return aligned.withColumn("_sums", column).select(*aligned.columns, "_sums.*")


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of both vocabularies over all documents, with corpus-wide counts of linked ids."""
    path = staging_path(spark, "alignment")
    align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).write.parquet(path)
    counted = with_corpus_counts(spark.read.parquet(path))
    return counted.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared"
    )
