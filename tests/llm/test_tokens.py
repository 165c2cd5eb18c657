"""Operators on tokens: SentencePiece agenda, alignment of two tokenizers, divergence of sources."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import alignment, divergence, sentencepieces

PARTS = [
    "a", "e", "the", " ", "  ", "\n", "\t", "1", "23", "é", "ß", "中", "国", "😀", "▁", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", ".", ",",
    "\x00", "ing", " t", "‍", "À", "हि", " ", "\r", "█", "Ġ", "'s", "n't", "!!",
]
EDGES = [None, "", " ", "   ", "▁", " ▁ ", "\n", "a" * 5000, "=" * 3000, " " * 999, "x " * 4000]


def noise(n, seed, most=30):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS[: r.choice([8, 14, len(PARTS)])]) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.model_path())


def test_agenda_gives_the_librarys_ids(library):
    model = sentencepieces.agenda_of(sentencepieces.model_path())
    texts = noise(3000, 1) + EDGES
    ids, offsets = model.encode(pa.array(texts))
    decoded = model.decode(ids, offsets).to_pylist()
    for k, text in enumerate(texts):
        theirs = library.encode(text or "")
        assert ids[offsets[k] : offsets[k + 1]].tolist() == theirs, repr(text)[:80]
        assert decoded[k] == library.decode(theirs)


def test_agenda_survives_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "CACHED_STRETCHES", 20)
    model = sentencepieces.PieceAgenda(sentencepieces.model_path())
    for text in noise(200, 2):
        assert model.encode(pa.array([text]))[0].tolist() == library.encode(text)
    assert len(model.known) <= 200


def test_check_of_stretches_finds_what_differs(monkeypatch):
    """One stretch with a wrong id: only the texts that hold it disagree."""
    model = sentencepieces.PieceAgenda(sentencepieces.model_path(), check=True)
    right = model.stretch_ids
    monkeypatch.setattr(model, "stretch_ids", lambda s: [5, 6] if s == b" wrong" else right(s))
    texts = ["all is well", "this is wrong", None, "well", "wrong", "wrongly so", *noise(50, 9)]
    assert model.encode_checked(pa.array(texts))[2].tolist() == [t is None or "wrong" not in t.split(" ") for t in texts]
    assert model.encode_checked(pa.array(texts[:3]))[2].tolist() == [True, False, True]


def test_decode_of_any_ids(library):
    """Control ids, unknown ids, byte pieces that make no character, blanks at the start."""
    model, r = sentencepieces.agenda_of(sentencepieces.model_path()), random.Random(3)
    blank = library.piece_to_id("▁")
    for _ in range(5000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3), blank]) for _ in range(r.randint(0, 8))]
        assert model.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py() == library.decode(ids), ids
    with pytest.raises(IndexError):
        model.decode(np.array([32000]), np.array([0, 1]))


def test_encode_texts_on_a_table(spark, library):
    texts = noise(300, 4) + EDGES
    docs = spark.createDataFrame([(k, t, "own") for k, t in enumerate(texts)], "doc_id bigint, text string, pieces string").repartition(5)
    rows = sentencepieces.encode_texts(docs).withColumn("again", sentencepieces.decode_ids("pieces.ids")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.pieces.agrees and row.pieces.ids == library.encode(texts[row.doc_id] or "")
        assert row.pieces.decoded == row.again == library.decode(row.pieces.ids)
    assert sentencepieces.encode_texts(docs.limit(0)).count() == 0
    for check, agrees in ((None, None), ("texts", True)):
        assert [r.agrees for r in sentencepieces.encode_texts(docs, check=check).select("pieces.agrees").distinct().collect()] == [agrees]
    with pytest.raises(ValueError):
        sentencepieces.encode_texts(docs, check="some")
    lists = spark.createDataFrame([(None,), ([],), ([None, 306],)], "ids array<int>")
    assert [r.t for r in lists.select(sentencepieces.decode_ids("ids").alias("t")).collect()] == [None, "", library.decode([306])]


def test_op11_on_the_test_table(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = sentencepieces.op11_sentencepiece(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "")
        assert (row.n_tokens, row.agrees) == (len(ids), True)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# -- alignment ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def both(library):
    """Per text: A ids, B ids, their end offsets; None where the bytes are not given back."""
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True  # the contract wants special strings as plain text here
    a_bytes = alignment.sides_of(alignment.vocabulary_path(), sentencepieces.model_path()).a.model.decode_single_token_bytes

    def tokens(text):
        a, b = model.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
        pieces = [library.id_to_piece(i) for i in b]
        shown = [bytes([int(p[3:-1], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        own, whole = [a_bytes(i) for i in a], (" " + text).encode()
        if b"".join(own) != whole or b"".join(shown) != whole:
            return None
        return a, b, np.cumsum([len(x) for x in own]).tolist(), np.cumsum([len(x) for x in shown]).tolist()

    return lambda text: tokens(text) if text else None


def brute_groups(found):
    a, b, a_ends, b_ends = found
    out, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        ni, nj = a_ends.index(end) + 1, b_ends.index(end) + 1
        out.append((a[i:ni], b[j:nj]))
        i, j = ni, nj
    return out


def brute_alignment(texts, both):
    found = {k: both(t) for k, t in texts.items()}
    links = {k: [(g[0][-1], g[1][-1]) for g in brute_groups(f)] if f else [] for k, f in found.items()}
    counts = Counter(p for own in links.values() for p in own)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    rows = {}
    for k, f in found.items():
        if f is None:
            rows[k] = (0, 0, 0, 0, 0, 0, "")
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute_groups(f))
        n_best = sum(counts[p] == most[p[1]] for p in links[k])
        rows[k] = (len(f[0]), len(f[1]), len(links[k]), len(links[k]), n_best, sum(counts[p] for p in links[k]), hashlib.sha256(text.encode()).hexdigest())
    return rows


def as_rows(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_sparse_product():
    r = np.random.default_rng(5)
    for n, k, m in ((1, 1, 1), (4, 7, 3), (30, 20, 25), (0, 3, 2)):
        x, y = r.integers(0, 3, (n, k)), r.integers(0, 3, (k, m))

        def rows(dense):
            at = np.nonzero(dense)
            return alignment.Sparse(np.concatenate(([0], np.cumsum(np.bincount(at[0], minlength=len(dense))))).astype(np.int64), at[1], dense[at], dense.shape[1])

        for block in (1, 5, 1 << 20):
            out = np.zeros((n, m), np.int64)
            for i, j, v in alignment.product(rows(x), rows(y), block):
                out[i, j] += v
            assert (out == x @ y).all()
        assert (rows(x).transposed().indptr == rows(x.T).indptr).all() and (rows(x).transposed().indices == rows(x.T).indices).all()


def test_alignment_against_brute_force(spark, both, tmp_path):
    texts = dict(enumerate(noise(400, 6) + EDGES + ["the same text"] * 3))
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id bigint, text string, n_a int").repartition(4)
    path = str(tmp_path / "aligned")
    alignment.align_documents(docs).write.parquet(path)
    assert as_rows(alignment.with_corpus_counts(spark.read.parquet(path))) == brute_alignment(texts, both)
    empty = str(tmp_path / "empty")
    alignment.align_documents(docs.limit(0)).write.parquet(empty)
    assert alignment.with_corpus_counts(spark.read.parquet(empty)).count() == 0


def test_links_of_each_kind(spark, both):
    texts = {k: t for k, t in enumerate(noise(60, 7, 12) + [None, "", "▁"])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    expected = {"overlap": set(), "end": set(), "group": set()}
    for k, text in texts.items():
        found = both(text)
        if not found:
            continue
        a, b, a_ends, b_ends = found
        a_starts, b_starts = [0, *a_ends[:-1]], [0, *b_ends[:-1]]
        cuts = sorted(set(a_ends) & set(b_ends))
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                shared = min(a_ends[i], b_ends[j]) - max(a_starts[i], b_starts[j])
                if shared > 0:
                    expected["overlap"].add((k, i, j, x, y, shared))
                    if a_ends[i] == b_ends[j]:
                        expected["end"].add((k, i, j, x, y, shared))
                if sum(c < a_ends[i] for c in cuts) == sum(c < b_ends[j] for c in cuts):
                    expected["group"].add((k, i, j, x, y, 1))
    for kind, rows in expected.items():
        got = [tuple(r) for r in alignment.token_links(docs, kind).collect()]
        assert len(got) == len(set(got)) and set(got) == rows
    numbers = alignment.align_documents(docs).agg(F.sum("n_overlaps"), F.sum("n_shared"), F.sum("n_links")).first()
    assert tuple(numbers) == (len(expected["overlap"]), len(expected["group"]), len(expected["end"]))
    with pytest.raises(ValueError):
        alignment.token_links(docs, "other")


def test_op12_on_the_test_table(spark, sf_dir, both):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert as_rows(alignment.op12_alignment(spark, sf_dir)) == brute_alignment(texts, both)


# -- divergence of sources --------------------------------------------------------------


def sql_audit(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(divergence.OP13_SQL).fetchall())


def audited(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def random_rows(n, seed):
    r = random.Random(seed)
    words = ["the", "The", "THE", "naïve", "NAÏVE", "a", "b1c", "x-y", "é", "É", "中文", "tok"] + [f"w{chr(97 + i)}" for i in range(20)]
    sources = ["src0"] * 6 + ["src1", "src2", "", None, "Ünder", "src10"]
    return [(k % 50, " ".join(r.choice(words) for _ in range(r.randint(0, 30))), r.choice(["en", "en", "de", None]), r.choice(sources)) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_sql(spark, seed):
    rows = random_rows(250, seed) + [(1, None, "en", "silent"), (2, "", "xx", "s1"), (3, "lonely words", "xx", "s2"), (4, None, None, None)] + [(9, "copy of text", "en", "src1")] * 5
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id bigint, text string, lang string, source string, value int, term int")
    for parts in (1, 7):
        assert audited(divergence.audit(docs.repartition(parts))) == sql_audit(rows)


def test_audit_with_small_trees_and_many_hands(spark, monkeypatch):
    """Counts handed on in pieces and trees cut off in between give the same rows."""
    rows = random_rows(150, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    expected = sql_audit(rows)
    shares = [tuple(r) for r in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(shares) == expected
    assert audited(divergence.audit(docs.limit(0))) == sql_audit([])


def test_tree_counts_shared_paths_once():
    kind = pa.list_(pa.struct([("no", pa.int32()), ("p", pa.int64()), ("p0", pa.int64())]))
    paths = [[(1, 5, 2), (2, 7, 3)], [(1, 5, 2), (2, 7, 3), (4, 9, 1)], [(1, 5, 2), (3, 7, 3)], [(1, 6, 2), (2, 7, 3)], [(1, 6, 2), (2, 7, 3)]]
    lang, times = np.array([0, 0, 0, 0, 1]), np.array([3, 1, 2, 5, 1])
    lists = pa.array([[dict(zip(("no", "p", "p0"), x)) for x in path] for path in paths], kind)
    tree = divergence.Tree(lang, lists, times)
    nodes = [(depth, row, m) for depth, rows, ms in tree.nodes() for row, m in zip(rows.tolist(), ms.tolist())]
    assert nodes == [(0, 0, 6), (0, 3, 5), (0, 4, 1), (1, 0, 4), (1, 2, 2), (1, 3, 5), (1, 4, 1), (2, 1, 1)]
    sums, brute = Counter(), Counter()
    for own, group, item, value in tree.corrections():
        for key in zip(own.tolist(), group.tolist(), item.tolist(), value.tolist()):
            sums[key[:3]] += key[3]
    for own, path, m in zip(lang.tolist(), paths, times.tolist()):
        for x, p, p0 in path:
            for y, q, q0 in path:
                if x != y:
                    gap = [(u - v) ** 2 // v for u, v in ((p, q), (p, q0), (p0, q), (p0, q0))]
                    brute[own, x, y] += m * (gap[0] - gap[1] - gap[2] + gap[3])
    assert sums == brute


def test_counts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 5)
    rows = random_rows(60, 4)
    batches = [
        pa.RecordBatch.from_pydict({"lang": [r[2] or "" for r in rows[k : k + 9]], "source": [r[3] or "" for r in rows[k : k + 9]], "text": pa.array([r[1] for r in rows[k : k + 9]], pa.string())})
        for k in range(0, 60, 9)
    ]
    found = Counter()
    for batch in divergence._count_task(iter(batches)):
        for row in batch.to_pylist():
            for e in row["counts"]:
                found[row["lang"], e["source"], row["term"]] += e["n"]
    expected = Counter()
    con = duckdb.connect()
    for _, text, lang, source in rows:
        expected[lang or "", source or "", ""] += 0
        for word in con.execute(r"SELECT regexp_extract_all(translate(?, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')", [text]).fetchone()[0]:
            expected[lang or "", source or "", word] += 1
    assert found == expected and set(found) == set(expected)
