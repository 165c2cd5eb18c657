"""Cost-balanced packing of token ids into sequences of bounded length.

Attention over a piece of L tokens costs about ``linear`` * L + ``quadratic`` * L^2, so two full sequences can
differ much in cost.  Documents go, longest first, to the cheapest sequence with room for them.
Documents longer than a sequence fill whole sequences first; what fits nowhere whole is cut where the
most room is left.  The number of sequences is the least possible, so a shard pads less than one.

A shard is a group of documents chosen by a hash of id and text, of about ``shard_bytes`` of text, so shards are
even whatever the sources or copies look like, and the same rows always give the same sequences.
A row repeated very often (same id and text) is tokenized once and its numbered copies are dealt one by one.
Token ids are shuffled once, two bytes each; a shard is a partition of its own.

Tokens are found piece by piece: texts are cut where a token surely begins (see :func:`safe_cuts`), and
each distinct piece of a batch is tokenized once.  The vocabulary file is that of the library's byte-level BPE.
The added tokens of its JSON form (``<|endoftext|>``) get their own ids wherever they stand in a text, and
what lies between them is tokenized by itself, as ``tokenizers`` does.

Defined results: a null text has no token but the end id; repeated rows are packed like any others; ids may be null.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.skew import HOT_PART, copies, one_of_each, repeated_rows, row_keys
from rosterloom.llm.words import chunks

LENGTH = 1024
END_ID = 0
SHARD_BYTES = 16 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
CACHED_PIECES = 150_000
#: Bytes that surely begin a visible character: ASCII, and lead bytes of blocks without white space.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE0] = _VISIBLE[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK[0x30:0x3A] = _MARK[0x41:0x5B] = _MARK[0x61:0x7B] = False


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """Tokens beside the merges that the library's byte-level BPE recognises inside a text."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        own = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in own):
        raise ValueError("added tokens that look at what stands around them are not supported")
    return {t["content"]: t["id"] for t in own}


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """For each byte and the end, whether a token surely begins there, whatever stands around.

    True before a blank that a visible character follows, between a letter and a punctuation mark, and
    around a line end between two visible characters.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data) < 2:
        return cut
    here, after = data[:-1], data[1:]
    letter = _LETTER[here]
    letter[1:] |= (data[:-2] == 0xC3) & (here[1:] != 0x97) & (here[1:] != 0xB7)  # the Latin letters with accents
    cut[:-2] = (here == 0x20) & _VISIBLE[after]
    lone = (letter | _MARK[here]) & (after == 0x0A)  # before a line end that no white space precedes
    cut[1:-1] |= (letter & _MARK[after]) | lone
    cut[2:-1] |= lone[:-1] & _VISIBLE[data[2:]]
    return cut


class PieceTokenizer:
    """Ids of many texts; remembers the ids of pieces it has met, up to a bound.

    ``added`` are strings with an id of their own; without them every string is ordinary text.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = {token.encode(): number for token, number in (added or {}).items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, longest_first))) if self.added else None
        self.top = max([*ranks.values(), *self.added.values()])
        self.token_bytes = np.zeros(self.top + 1, np.int64)
        for token, rank in ranks.items():
            self.token_bytes[rank] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes = np.zeros(1 << 16, np.int32)
        self.flat, self.starts, self.filled = np.zeros(1 << 18, np.uint16 if self.top < 1 << 16 else np.uint32), np.zeros(1 << 16, np.int32), 0

    def _learn(self, new: list[bytes]) -> None:
        """Tokenizes pieces; those that begin with a blank in one go, as a token surely begins there."""
        joined = [p for p in new if len(p) > 1 and p[0] == 0x20 and _VISIBLE[p[1]]]
        alone = [p for p in new if not (len(p) > 1 and p[0] == 0x20 and _VISIBLE[p[1]])]
        ids = [np.array(self.model.encode_ordinary(b"".join(joined).decode()), np.uint32)]
        ends = np.cumsum(np.array([len(p) for p in joined], np.int64))
        reach = np.cumsum(self.token_bytes[ids[0]])
        sizes = [np.diff(np.searchsorted(reach, ends, side="right"), prepend=0)]
        for p in alone:
            own = self.added.get(p)
            ids.append(np.array(self.model.encode_ordinary(p.decode()) if own is None else [own], np.uint32))
            sizes.append(np.array([len(ids[-1])]))
        found, counts = np.concatenate(ids), np.concatenate(sizes)
        first, n = len(self.known), len(self.known) + len(new)
        while n > len(self.sizes):
            self.sizes, self.starts = np.concatenate([self.sizes, self.sizes]), np.concatenate([self.starts, self.starts])
        while self.filled + len(found) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.sizes[first:n] = counts
        self.starts[first:n] = self.filled + np.cumsum(counts) - counts
        self.flat[self.filled : self.filled + len(found)] = found
        self.filled += len(found)
        for k, p in enumerate(joined + alone, first):
            self.known[p] = k

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        get = self.known.get
        numbers = [get(p, -1) for p in pieces]
        new = [p for p, k in zip(pieces, numbers) if k < 0]
        if new:
            if len(self.known) + len(new) > CACHED_PIECES:
                self._forget()
                new = pieces
            self._learn(new)
            get = self.known.get
            numbers = [get(p) for p in pieces]
        return np.array(numbers, np.int64)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Safe cuts, with texts and added tokens cut off from what stands around them."""
        cut = safe_cuts(data)
        edges = [offsets]
        if self.find_added and self.find_added.search(data):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                for m in self.find_added.finditer(data, a, b):
                    cut[m.start() : m.end()] = False
                    edges.append(np.array(m.span()))
        edge = np.concatenate(edges)
        last = edge[edge > 0] - 1
        cut[last[data[last] == 0x20]] = False  # no visible character follows this blank in its own stretch
        cut[edge] = True
        return cut

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, with the end id."""
        out: list[np.ndarray] = []
        for chunk in chunks(texts):
            data, offsets = chunk.data, chunk.offsets
            bounds = np.flatnonzero(self.cuts(data, offsets))
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            coded = pieces.dictionary_encode()
            numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            counts = self.sizes[numbers]
            ends = np.cumsum(counts, dtype=np.int64)
            tokens = self.flat[np.repeat(self.starts[numbers] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
            upto = np.concatenate(([0], ends))[np.searchsorted(bounds, offsets)]
            for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
                out.append(np.append(tokens[a:b], tokens.dtype.type(END_ID)))
        return out


def tokenize(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, id_bytes: int = 2, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, k1, k2, ids, and the columns ``carry``): ids packed as little-endian numbers of ``id_bytes`` bytes.

    Added tokens are those of the library's own vocabulary; another vocabulary file has none.
    """
    added = {} if path else added_tokens()
    path = path or vocabulary_path()
    made: list[PieceTokenizer] = []
    kind = f"<u{id_bytes}"

    def encode(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(PieceTokenizer(path, added))
            if made[0].top >> 8 * id_bytes:
                raise ValueError("the vocabulary needs more bytes per id")
        return pa.array([ids.astype(kind).tobytes() for ids in made[0].encode(texts)], pa.binary())

    ids = F.arrow_udf(encode, "binary").asNondeterministic()(F.col(text)).alias("ids")
    return docs.select(F.col(doc_id).alias("doc_id"), *row_keys(doc_id, text), ids, *carry)


def assign(lengths: list[int], length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, size, sequence, offset) for documents of the given lengths."""
    pieces: list[tuple[int, int, int, int, int]] = []
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
    used = 0
    for doc, size in enumerate(lengths):
        for start in range(0, size - size % length, length):
            pieces.append((doc, start, length, used, 0))
            used += 1
        if size % length:
            waiting[size % length].append((doc, size - size % length))
    total = sum(n * len(own) for n, own in enumerate(waiting))
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(length + 1)]
    heaps[length] = [(0.0, used + i) for i in range(-(-total // length))]
    cheapest = np.full(length + 1, np.inf)  # by room left
    if heaps[length]:
        cheapest[length] = 0.0

    def place(doc: int, start: int, size: int, room: int) -> None:
        cost, sequence = heapq.heappop(heaps[room])
        cheapest[room] = heaps[room][0][0] if heaps[room] else np.inf
        pieces.append((doc, start, size, sequence, length - room))
        left = room - size
        if left:
            heapq.heappush(heaps[left], (cost + linear * size + quadratic * size * size, sequence))
            cheapest[left] = heaps[left][0][0]

    for size in range(length - 1, 0, -1):
        for doc, start in waiting[size]:
            room = size + int(np.argmin(cheapest[size:]))
            if cheapest[room] < np.inf:
                place(doc, start, size, room)
            else:
                room = int(np.flatnonzero(cheapest[:size] < np.inf)[-1])
                place(doc, start, room, room)
                waiting[size - room].append((doc, start + room))
    return pieces


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, linear: float = LINEAR,
    quadratic: float = QUADRATIC, shard_bytes: int = SHARD_BYTES, path: str | None = None, id_bytes: int = 2,
    hot_part: int = HOT_PART,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (binary, four bytes each), doc_tokens, sequence_id, offset.

    Other columns of ``docs`` are not carried along, whatever their names.
    """
    key = row_keys(doc_id, text)
    total, rows = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    n = max(1, -(-(total or 0) // shard_bytes))
    hot = F.broadcast(repeated_rows(docs.select(*key), ["k1", "k2"], "n", rows, hot_part))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *key)
    single = tokenize(own.join(hot, ["k1", "k2"], "left_anti"), path=path, id_bytes=id_bytes)
    one_each = one_of_each(own.join(hot, ["k1", "k2"]), ["k1", "k2"])
    repeated = copies(tokenize(one_each, path=path, id_bytes=id_bytes, carry=["n"]), "n", "copy", ["k1"])
    coded = single.withColumn("copy", F.lit(0).cast("bigint")).unionByName(repeated)
    id_type = coded.schema["doc_id"].dataType.simpleString()
    place = F.when(F.col("copy") == 0, F.col("k1")).otherwise(F.xxhash64("k1", "copy"))
    dealt = coded.select(F.pmod(place, F.lit(n)).cast("int").alias("shard"), "*").repartitionById(n, F.col("shard"))

    def fill(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[("k1", "ascending"), ("k2", "ascending")]))
        rows = [x.as_buffer() for x in table.column("ids")]
        ids = [np.frombuffer(x, f"<u{id_bytes}") for x in rows]
        sizes = [len(x) for x in ids]
        pieces = assign(sizes, length, linear, quadratic)
        doc, start, size, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(pa.array(doc)),
                "start": start,
                "length": size,
                "ids": pa.array([ids[d][s : s + k].astype("<u4").tobytes() for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist())], pa.binary()),
                "doc_tokens": np.array(sizes, np.int64)[doc],
                "sequence_id": sequence + (key[0].as_py() << 32),
                "offset": offset,
            }
        )

    schema = f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("shard").applyInArrow(fill, schema)


def report(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return report(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))
