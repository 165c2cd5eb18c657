"""Encoding and decoding with merge-type SentencePiece vocabularies, checked against the library.

A text's characters are symbols.  An agenda (a heap) holds the adjacent pairs whose join is a piece; the
pair of the highest score is joined first, of equal scores the leftmost, and the pairs of the new symbol with its
neighbours are added.  What is left are the pieces; a symbol that is none is spelled in byte pieces.

Two characters that stand beside each other in no piece are never joined, so texts are first cut between such
characters (see :class:`PieceAgenda`), and each distinct stretch of a batch is worked through once.  The stretches
are short (a word with the blanks before it), a cache of them is bounded, and a text is never cut off.

Every batch is compared with ``sentencepiece`` itself, both ways: the stretches that are new in it (``check="stretches"``; they
are joined with characters that no piece joins to anything, so the library sees each as it stands in a text), or
all whole texts (``check="texts"``), which about doubles the time.

Defined results: a null or empty text has no ids and decodes to the empty text; the character U+2581 is the same as
a blank; repeated rows are encoded like any others; the column ``pieces`` replaces one of that name, others stay.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.words import chunks, plain

BLANK = "▁"
CACHED_STRETCHES = 1 << 19
CACHED_TOKENS = 1 << 22
CHUNK_BYTES = 4 << 20
#: Texts that the library is given at a time.
CHECKED_TEXTS = 64
CHECKED_STRETCHES = 4096
#: Kinds of pieces in a model file (fixed values of the file format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches ``starts``, ``counts`` of ``flat``, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


class PieceAgenda:
    """Ids of texts and texts of ids under one model file."""

    def __init__(self, path: str, check: bool = False):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
            raise ValueError("a merge-type vocabulary with byte pieces is needed")
        if rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only the identity normalizer with a blank put in front is supported")
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.byte_ids = [0] * 256
        shown: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = i
                shown.append(bytes([int(p.piece[3:-1], 16)]))
            else:
                shown.append({CONTROL: "", UNKNOWN: trained.unk_surface}.get(p.type, p.piece).replace(BLANK, " ").encode())
        self.kinds = np.array(kinds, np.uint8)
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.sizes = np.array([len(x) for x in shown], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        #: Byte pairs that stand inside some piece; between others that are not inside a character, texts are cut.
        self.joins = np.zeros((256, 256), bool)
        self.joins[:, 0x80:0xC0] = True
        for piece in self.scores:
            own = np.frombuffer(piece.replace(BLANK, " ").encode(), np.uint8)
            self.joins[own[:-1], own[1:]] = True
        self.library = SentencePieceProcessor(model_file=path) if check else None
        lone = [i for i in range(128) if not self.joins[i, :0x80].any() and not self.joins[:, i].any() and not self.joins[i, 0xC0:].any()]
        self.gap = bytes(lone[:1])
        if check and not lone:
            raise ValueError("every character stands beside another one in some piece")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.filled = np.zeros(1 << 16, np.int32), 0
        self.starts, self.counts = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.wrong = np.zeros(0, bool)

    def _compare(self, stretches: list[bytes], ids: list[list[int]]) -> list[bool]:
        """Whether the library gives other ids, or another text of them, for each of the stretches."""
        def differ(some: list[bytes], own: list[list[int]]) -> bool:
            gap = self.stretch_ids(self.gap)
            expected = [*self.stretch_ids(b" "), *(i for x in own for i in (*gap, *x))]
            theirs = self.library.encode((self.gap + self.gap.join(some)).decode(), add_bos=False, add_eos=False, enable_sampling=False)
            shown = self.decode(np.array(theirs, np.int64), np.array([0, len(theirs)]))[0].as_py()
            return theirs != expected or self.library.decode(theirs) != shown

        out: list[bool] = []
        for k in range(0, len(stretches), CHECKED_STRETCHES):
            some, own = stretches[k : k + CHECKED_STRETCHES], ids[k : k + CHECKED_STRETCHES]
            out += [differ([s], [x]) for s, x in zip(some, own)] if differ(some, own) else [False] * len(some)
        return out

    def pieces(self, stretch: str) -> list[str]:
        """The symbols of ``stretch`` (blanks as U+2581) once no pair on the agenda is left."""
        symbols, score_of = list(stretch), self.scores.get
        last = len(symbols)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        agenda: list[tuple[float, int, int, int]] = []
        for i in range(last - 1):
            score = score_of(stretch[i : i + 2])
            if score is not None:
                agenda.append((-score, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            joined = symbols[left] + symbols[right]
            if not symbols[right] or not symbols[left] or len(joined) != size:
                continue  # one of the two has been joined with something else meanwhile
            symbols[left], symbols[right] = joined, ""
            following, leading = after[right], before[left]
            after[left] = following
            if following < last:
                before[following] = left
                score = score_of(joined + symbols[following])
                if score is not None:
                    heapq.heappush(agenda, (-score, left, following, size + len(symbols[following])))
            if leading >= 0:
                score = score_of(symbols[leading] + joined)
                if score is not None:
                    heapq.heappush(agenda, (-score, leading, left, len(symbols[leading]) + size))
        return [s for s in symbols if s]

    def stretch_ids(self, stretch: bytes) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(stretch.decode().replace(" ", BLANK)):
            own = self.ids.get(piece)
            out += [own] if own is not None else [self.byte_ids[b] for b in piece.encode()]
        return out

    def _numbers(self, stretches: list[bytes]) -> np.ndarray:
        """Places in the cache; new stretches are worked through, and the cache starts anew beyond its bounds."""
        numbers = [*map(self.known.get, stretches)]
        if None not in numbers:
            return np.array(numbers, np.int64)
        new = [s for s, k in zip(stretches, numbers) if k is None]
        if self.known and (len(self.known) + len(new) > CACHED_STRETCHES or self.filled > CACHED_TOKENS):
            self._forget()
            new = stretches
        while len(self.known) + len(new) > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        found = [self.stretch_ids(s) for s in new]
        self.wrong = np.concatenate([self.wrong, np.array(self._compare(new, found) if self.library else [False] * len(new), bool)])
        for s, own in zip(new, found):
            k = len(self.known)
            while self.filled + len(own) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.filled : self.filled + len(own)] = own
            self.starts[k], self.counts[k] = self.filled, len(own)
            self.filled += len(own)
            self.known[s] = k
        return np.array([*map(self.known.get, stretches)], np.int64)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each byte and the end, whether a piece surely begins there; always where a text does."""
        cut = np.ones(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = ~self.joins[data[:-1], data[1:]]
        cut[offsets] = True
        return cut

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text in them)."""
        return self.encode_checked(texts)[:2]

    def encode_checked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, and whether the library agrees on all stretches of each text (true where nothing is checked)."""
        texts = pc.replace_substring(plain(texts), BLANK, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        ids, upto, agrees, done = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], [np.zeros(0, bool)], 0
        for chunk in chunks(texts, CHUNK_BYTES):
            data, offsets = chunk.data, chunk.offsets
            bounds = np.flatnonzero(self.cuts(data, offsets)) if len(data) else np.zeros(1, np.int64)
            coded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
            ).dictionary_encode()
            numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            counts = self.counts[numbers]
            ids.append(gathered(self.flat, self.starts[numbers], counts))
            first = np.searchsorted(bounds, offsets)
            ends = np.concatenate(([0], np.cumsum(counts)))[first]
            upto.append(done + ends[1:])
            agrees.append(np.diff(np.concatenate(([0], np.cumsum(self.wrong[numbers])))[first]) == 0)
            done += int(ends[-1])
        return np.concatenate(ids), np.concatenate(upto), np.concatenate(agrees)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text of each run of ids, as the library's decode() gives it."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise IndexError("an id that the model does not have")
        spread = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        data = gathered(self.shown, self.begins[ids], self.sizes[ids])
        others = (self.kinds[ids] != NORMAL) & (self.kinds[ids] != BYTE)
        out: list[str] = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if a == b:
                out.append("")
                continue
            own = data[spread[a] : spread[b]].tobytes()
            usual = self.kinds[ids[a]] == NORMAL and not others[a:b].any()
            try:  # pieces are whole characters, so bytes are right as a whole or one run of byte pieces is wrong
                text = own.decode() if usual else None
            except UnicodeDecodeError:
                text = None
            out.append(self._decode_slowly(ids[a:b].tolist()) if text is None else text[1:] if text[0] == " " else text)
        return pa.array(out, pa.string())

    def _decode_slowly(self, ids: Sequence[int]) -> str:
        """Piece by piece: control pieces before the first blank, and bytes that make no character."""
        text, run, at_start = [], bytearray(), True
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                run += self.shown[self.begins[i] : self.begins[i] + 1].tobytes()
                continue
            if run:
                text.append(replaced(bytes(run)))
                run, at_start = bytearray(), False
            if i >= 0:
                own = self.shown[self.begins[i] : self.begins[i] + self.sizes[i]].tobytes().decode()
                stripped = at_start and self.kinds[i] == NORMAL and own.startswith(" ")
                at_start = at_start and not stripped and not own
                text.append(own[1:] if stripped else own)
        return "".join(text)


def replaced(run: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that is part of no character."""
    out, k = [], 0
    while k < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[k : k + size].decode())
                k += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


_made: dict[tuple[str, bool], PieceAgenda] = {}
_libraries: dict[str, object] = {}


def agenda_of(path: str, check: bool = False) -> PieceAgenda:
    """The model, read once per Python worker."""
    if (path, check) not in _made:
        _made[path, check] = PieceAgenda(path, check)
    return _made[path, check]


def library_agrees(path: str, texts: pa.Array, ids: np.ndarray, offsets: np.ndarray, decoded: pa.Array) -> pa.Array:
    """Whether ``sentencepiece`` gives the same ids and the same text, for each of a batch of whole texts."""
    import sentencepiece

    if path not in _libraries:
        _libraries[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    library = _libraries[path]
    same: list[bool] = []
    for a in range(0, len(texts), CHECKED_TEXTS):
        own = plain(texts.slice(a, CHECKED_TEXTS)).to_pylist()
        theirs = library.encode(own, add_bos=False, add_eos=False, enable_sampling=False, num_threads=1)
        shown = library.decode(theirs, num_threads=1)
        for k, text in enumerate(decoded.slice(a, CHECKED_TEXTS).to_pylist()):
            same.append(theirs[k] == ids[offsets[a + k] : offsets[a + k + 1]].tolist() and shown[k] == text)
    return pa.array(same, pa.bool_())


def encode_texts(docs: DataFrame, text: str = "text", path: str | None = None, check: str | None = "stretches") -> DataFrame:
    """Adds ``pieces``: a struct of ids, the decoded text and, with ``check``, whether the library agrees (else null)."""
    if check not in (None, "stretches", "texts"):
        raise ValueError("check is stretches, texts or None")
    path = path or model_path()

    def run(texts: pa.Array) -> pa.Array:
        model = agenda_of(path, check == "stretches")
        ids, offsets, same = model.encode_checked(texts)
        decoded = model.decode(ids, offsets)
        agrees = pa.array(same) if check == "stretches" else pa.nulls(len(texts), pa.bool_())
        if check == "texts":
            agrees = library_agrees(path, texts, ids, offsets, decoded)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.StructArray.from_arrays([lists, decoded, agrees], ["ids", "decoded", "agrees"])

    kind = "struct<ids: array<int>, decoded: string, agrees: boolean>"
    return docs.withColumn("pieces", F.arrow_udf(run, kind).asNondeterministic()(F.col(text)))


def decode_ids(ids: Column | str, path: str | None = None) -> Column:
    """The text of a column of arrays of ids; null arrays give null, null ids in an array are left out."""
    path = path or model_path()

    def run(column: pa.Array) -> pa.Array:
        rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        lists = [np.array([i for i in own if i is not None] if own else [], np.int64) for own in rows.to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
        found = agenda_of(path).decode(np.concatenate([np.zeros(0, np.int64), *lists]), offsets)
        return pc.if_else(pc.is_valid(rows), found, pa.scalar(None, pa.string()))

    return F.arrow_udf(run, "string")(ids)


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents; every stretch is compared with the library."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_texts(docs)
    return coded.select(
        "doc_id",
        F.size("pieces.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("pieces.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
        F.col("pieces.agrees").alias("agrees"),
    )
