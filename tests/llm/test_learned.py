"""Operators that learn, tokenize or follow rules: held-out quality, round trips and hand-made cases."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterloom.llm import html_text, licenses, packing, quality

# -- 5: decision list --------------------------------------------------------------


def test_rules_separate_what_labels_separate():
    rng = np.random.default_rng(3)
    n = 3000
    values = {"symbol_share": rng.random(n) * 0.02, "mark_share": rng.random(n) * 0.02, "digit_share": rng.random(n)}
    bad = np.zeros(n, bool)
    bad[:300], bad[300:450] = True, True
    values["symbol_share"][:300] += 0.1
    values["mark_share"][300:450] += 0.2
    order = rng.permutation(n)
    rules = quality.learn(values, bad, order)
    hit = np.zeros(n, bool)
    for rule in rules:
        hit |= quality._covers(rule, values, n)
    assert (hit == bad).mean() > 0.995
    assert {c.name for rule in rules for c in rule} == {"symbol_share", "mark_share"}


def test_nothing_to_learn_from_noise():
    rng = np.random.default_rng(4)
    values = {"symbol_share": rng.random(2000), "mark_share": rng.random(2000)}
    assert quality.learn(values, rng.random(2000) < 0.1, rng.permutation(2000)) == []


def test_list_is_ordered_and_applied(spark):
    docs = spark.createDataFrame([(1, "word " * 60 + "### " * 30), (2, "so many different words " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))), (3, None)], "doc_id int, text string")
    rules = [(quality.Condition("symbol_share", True, 0.1),), (quality.Condition("digit_share", True, 0.5), quality.Condition("symbol_share", False, 0.2))]
    found = {r.doc_id: (r.rule, r.base_failed, r.kept) for r in quality.judge(docs, rules).collect()}
    assert found == {1: (1, True, False), 2: (None, False, True), 3: (None, True, False)}
    assert "CASE WHEN" in quality.rejects(rules)._jc.toString()


def test_fit_on_the_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.unionByName(spark.createDataFrame([(None, 0, 0), (-5, 0, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int"))
    rules = quality.fit(docs, odd)
    judged = quality.judge(docs, rules).join(labels, "doc_id").where("not base_failed")
    assert judged.where("quality = 1 and not kept").count() <= 0.02 * judged.where("quality = 1").count()


def test_fit_takes_one_row_of_each_id(spark, monkeypatch):
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)) + end for end in ("", " ###", " $$$ 12")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id bigint, quality int")
    seen, collected = [], []
    monkeypatch.setattr(quality, "learn", lambda values, bad, order: seen.append({k: v.tolist() for k, v in values.items()}) or [])
    kind = type(labels)
    to_pandas = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: collected.append(to_pandas(self)) or collected[-1])
    for own in (texts, texts[::-1]):
        docs = spark.createDataFrame([(k, t) for k in range(4) for t in own * 5], "doc_id bigint, text string").coalesce(1)
        quality.fit(docs, labels)
    assert seen[0] == seen[1] and [len(c) for c in collected] == [4, 4]


# -- 6: main text ------------------------------------------------------------------

LONG = "This is the {} of the paragraphs in the article and it is long enough to be decided by the rule."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html,want",
    [
        (None, ""),
        ("", ""),
        ("<div></div>", ""),
        (page(f"<nav><a href=1>Home</a></nav><article><h1>Title</h1><p>Be.</p><p>{LONG.format('first')}</p></article><footer>&copy; x</footer>"), f"Title\nBe.\n{LONG.format('first')}"),
        (page("<div class='ad'>Buy</div><article><h1>A &amp; B</h1><p>Tiny&nbsp; <b>bo</b>ld<br>line</p></article><footer>f"), "A & B\nTiny bold line"),
        (page(f"<div id='content'><p>{LONG.format('only')}</p><div class='comments'><p>{LONG.format('comment')}</p></div><aside>{LONG.format('side')}</aside></div>"), LONG.format("only")),
        (page(f"<div><a href=1>one</a> <a href=2>two</a></div><p>{LONG.format('x')}</p><p>Yes.</p><form><p>{LONG.format('form')}</p></form>"), f"{LONG.format('x')}\nYes."),
        (page(f"<div class='cookie-notice'><p>{LONG.format('notice')}</p></div><main><p>{LONG.format('m')}<p>open<ul><li>item</ul></main>"), f"{LONG.format('m')}\nopen\nitem"),
        (page(f"<article><h2>T</h2><p>{LONG.format('a')}</p><h3>Comments</h3><p>{LONG.format('c')}</p></article>"), f"T\n{LONG.format('a')}"),
        (f"<article><p>{LONG.format('cut')}</p><p>and then it en", f"{LONG.format('cut')}\nand then it en"),
    ],
)
def test_main_text(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize("size", [10, 5000, 1_000_000])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_attribute_values_are_skipped_whole(size, quote):
    inside = "x > y </article><nav class=ad hidden>leak " * (size // 40 + 1)
    first, second = LONG.format("first"), LONG.format("second")
    html = page(f"<article data-a={quote}{inside}{quote}><p>{first}</p><svg data-b={quote}{inside}{quote}>pic</svg><p title={quote}{inside}{quote}>{second}</p></article>")
    assert html_text.main_text(html) == f"{first}\n{second}"


@pytest.mark.parametrize("depth", [3, 600, 20_000])
def test_nesting_of_any_depth(depth):
    first, second = LONG.format("first"), LONG.format("second")
    deep = "<div>" * depth + f"<nav><div><p>{LONG.format('menu')}</p></div></nav><p>{first}</p>" + "</div>" * depth
    html = page(f"<div><article>{deep}<p>{second}</p></article></div><p>{LONG.format('outside')}</p>")
    assert html_text.main_text(html) == f"{first}\n{second}"


def test_quotes_outside_of_values_open_nothing():
    first, second = LONG.format("first"), LONG.format("second")
    html = page(f"<article><p title=it's>{first}</p><p x'y>{second}</p>" + f"<p>{first}</p>" * 200 + "<p title='end>last</p></article>")
    assert html_text.main_text(html).startswith(f"{first}\n{second}\n{first}") and html_text.main_text(html).endswith(f"{first}\nlast")


@pytest.mark.parametrize("broken", ['<a href="' * 20000, "<div>" * 30000 + "x", "<script>" * 20000, "<!--" * 30000, "</b>" * 20000 + "<i>" * 20000 + "</b>" * 20000])
def test_broken_markup_takes_bounded_work(broken):
    html_text.main_text(broken)


def test_pages_keep_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", None, "mine"), (1, "u", None, "mine")], "page_id int, url string, html string, text string")
    assert [tuple(r) for r in html_text.extract(pages).collect()] == [(1, "u", None, "", 0)] * 2


# -- 7: packing --------------------------------------------------------------------


def reference_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return model


def test_pieces_tokenize_like_the_library():
    rng = random.Random(3)
    letters = " \n\t.,'!sétvm AbZ09  ×÷é-_<|>\r«€漢 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += ["The quick brown fox's tail.\n\nAnd 12 more words,  spaced\n out <|endoftext|> ", "", "x" * 5000]
    model, own = reference_tokenizer(), packing.PieceTokenizer(packing.vocabulary_path())
    want = [e.ids + [0] for e in model.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(pa.array(texts))] == want
    own._forget()
    assert [x.tolist() for x in own.encode(pa.array(texts[:50]))] == want[:50]


def test_added_tokens_have_their_own_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "\n\n", "a", "it's", " word", "é", "!", "12"]
    texts = ["a<|endoftext|>b", "<|endoftext|>", "ends in <|endof", "text|> begins", "x  <|endoftext|>  y", None, ""]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # as it comes
    want = [e.ids + [0] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert want[0] == [64, 50256, 65, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.tokenize(docs).collect()}
    assert [found[k] for k in range(len(texts))] == want


def check_pieces(pieces, lengths, length):
    """pieces: (document, start, size, sequence, offset)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, size, sequence, offset in pieces:
        by_doc[doc].append((start, size))
        by_sequence[sequence].append((offset, size))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_doc[doc]):
            assert start == at and size > 0
            at += size
        assert at == n
    for own in by_sequence.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    return by_sequence


def test_assignment_is_tight_and_balanced():
    rng = random.Random(1)
    lengths = [rng.choice([1, 3, 50, 200, 700, 1024, 1500, 5000]) + rng.randint(0, 40) for _ in range(2000)]
    sequences = check_pieces(packing.assign(lengths), lengths, 1024)
    assert len(sequences) == -(-sum(lengths) // 1024) or len(sequences) <= sum(n // 1024 for n in lengths) + -(-sum(n % 1024 for n in lengths) // 1024)
    mixed = [n % 1024 for n in lengths if n % 1024]
    pieces = packing.assign(mixed)
    costs = [sum(s + s * s / 1024 for _, s in own) for own in check_pieces(pieces, mixed, 1024).values()]
    order = packing.assign(mixed, linear=0.0, quadratic=0.0)  # no costs to balance
    plain = [sum(s + s * s / 1024 for _, s in own) for own in check_pieces(order, mixed, 1024).values()]
    assert np.std(costs) < np.std(plain)


def test_packed_documents(spark):
    texts = [(1, "one two three " * 700), (2, None), (2, None), (None, "four five"), (3, ""), (4, "four five")] + [(k, f"text {k} " * (k % 90)) for k in range(5, 200)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    for size in (packing.SHARD_BYTES, 2000):
        packed = packing.pack(docs, shard_bytes=size)
        found = [r.asDict() for r in packed.withColumn("crc", F.crc32("ids")).collect()]
        model = reference_tokenizer()
        own = defaultdict(list)
        for r in found:
            own[r["doc_id"]].append(r)
            assert zlib.crc32(r["ids"]) == r["crc"] and len(r["ids"]) == 4 * r["length"]
        for doc, text in texts:
            want = model.encode(text or "", add_special_tokens=False).ids + [0]
            copies = sum(1 for d, _ in texts if d == doc)
            ids = [i for r in sorted(own[doc], key=lambda r: r["start"]) for i in np.frombuffer(r["ids"], "<u4").tolist()]
            assert sorted(ids) == sorted(want * copies) if copies > 1 else ids == want
            assert {r["doc_tokens"] for r in own[doc]} == {len(want)}
        places = defaultdict(list)
        for r in found:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        for own_places in places.values():
            at = 0
            for offset, n in sorted(own_places):
                assert offset == at
                at += n
            assert at <= packing.LENGTH


# -- 10: licences --------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return licenses.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_held_out_lines(model):
    assert model.held_out["accuracy"] >= 0.98 and model.held_out["false_alarms"] == 0 and model.held_out["lines"] > 200


def test_notices_are_found_and_others_left(spark, model):
    texts = [
        (1, "Some words.\nÉtoile.\nReleased under the MIT License.\nMore words."),
        (2, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-SA 4.0."),
        (3, "The driver showed a license to the guard, who granted permission to enter.\nThis copy is free."),
        (4, None), (5, ""), (5, ""), (6, "\n\n"),
        (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ]
    found = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame(texts, "doc_id int, text string"), model).collect()}
    spans = {k: [(s.family, dict(texts)[k][s.start : s.end]) for s in v.spans] for k, v in found.items()}
    assert spans[1] == [("MIT", "Released under the MIT License.")]
    assert [f for f, _ in spans[2]] == ["CC-BY-NC", "CC-BY-SA"]
    assert spans[3] == [] and spans[4] == spans[5] == spans[6] == []
    assert [f for f, _ in spans[7]] == ["GPL"]
    assert [found[k].n_paragraphs for k in (1, 2, 3, 4, 5, 6)] == [4, 2, 2, 0, 0, 0]


def test_every_notice_of_the_table(spark, sf_dir, model):
    known = {t for sentences in licenses.TEMPLATES.values() for t in sentences}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in licenses.scan(docs, model).select("text", "licences.spans").collect():
        there = [line for line in r.text.split("\n") if line in known]
        assert [r.text[s.start : s.end] for s in r.spans] == there


# -- the pipeline ------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir, tmp_path):
    """Each stage against a plain version of its decision, on awkward columns."""
    from tests.llm import test_exact as plain

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("counts", F.lit(1)).withColumn("_row", F.lit("x")).withColumn("kept", F.lit(False))
    columns = docs.columns
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns
        after = docs.collect()
        kept = {r.doc_id: r for r in after}
        assert len(kept) == len(after)
        if name == "quality_rules":
            failed = {r.doc_id for r in before for c in [plain.counts_of(r.text)] if c[0] < 50 or 100 * c[4] > 50 * c[0]}
            good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
            ids = {r.doc_id for r in before}
            assert not failed & set(kept) and len((good & ids) - failed - set(kept)) <= 0.02 * len(good)
        elif name == "line_dedup":
            want = {d: t for d, _, _, t in plain.deduped([(r.doc_id, r.text) for r in before])}
            assert {d: r.text for d, r in kept.items()} == want
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "near_duplicates":
            marks = [(r.doc_id, plain.fingerprint(r.text)) for r in before]
            assert set(kept) == set(plain.classes(marks))
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(kept) == {r[0] for r in plain.contamination([(r.doc_id, r.text) for r in before], items) if not r[5]}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in before}


# -- 6: what decides a block ------------------------------------------------------------

LONG = "the house by the river was old and it had been empty for so many years that no one in the town would go there"
BARE = "granite basalt quartzite limestone sandstone dolomite gneiss marble slate shale chert obsidian pumice schist tuff diorite"
ABLATION_PAGE = (
    f"<body><div><p>{LONG}</p><p>Short one.</p><p>{BARE}</p><p>{LONG}</p></div><div><a href=1>{LONG}</a></div><div><a href=2>{BARE}</a></div>"
    f"<p>Tiny</p><p>{BARE}</p><p>{BARE} {BARE}</p><p>Last</p></body>"
)


def test_each_feature_and_the_second_pass_decide(monkeypatch):
    """A page without telling names: each rule that is left out changes what is taken."""
    whole = html_text.main_text(ABLATION_PAGE)
    assert whole.split("\n") == [LONG, "Short one.", BARE, LONG]
    seen = []
    for feature in ("length", "stop", "links"):
        monkeypatch.setitem(html_text.WEIGHTS, feature, 0)
        seen.append(html_text.main_text(ABLATION_PAGE))
        monkeypatch.setitem(html_text.WEIGHTS, feature, 1)
    monkeypatch.setattr(html_text, "second_pass", lambda page: None)
    seen.append(html_text.main_text(ABLATION_PAGE))
    assert len(seen) == 4 and whole not in seen


def test_names_are_one_feature(monkeypatch):
    page = f"<body><article><p>{LONG}</p><div class=promo>{LONG}</div><p>{LONG}</p></article></body>"
    assert html_text.main_text(page) == f"{LONG}\n{LONG}"
    monkeypatch.setitem(html_text.WEIGHTS, "container", 0)
    assert html_text.main_text(page) == f"{LONG}\n{LONG}\n{LONG}"


def test_short_blocks_follow_bad_neighbours_inside_articles():
    """Between two bad blocks a short one is left out; between a good and a bad one it stays."""
    bad = "<div class=share>Share this</div>"
    page = f"<article><p>{LONG}</p><p>kept</p>{bad}<p>lost</p>{bad}<p>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG}\nkept\n{LONG}"


def test_second_pass_against_all_distances():
    r = random.Random(11)
    for _ in range(500):
        page = [html_text.Block("p", r.choice([0, 1, 2]), False, text=r.choice([LONG, BARE, "x"]), good=r.choice([None, None, True, False])) for _ in range(r.randint(1, 12))]
        before = [(b.region, b.good, b.text) for b in page]
        html_text.second_pass(page)
        for k, block in enumerate(page):
            region, good, _ = before[k]
            own = [(at, g, t) for at, (rg, g, t) in enumerate(before) if rg == region]
            place = next(i for i, x in enumerate(own) if x[0] == k)
            decided = [(abs(i - place), not g) for i, (_, g, _) in enumerate(own) if g is not None]
            if good is not None:
                assert block.good == good
            elif decided and (not region or any(g for _, g, _ in own)):
                assert block.good == (not min(decided)[1])
            else:  # judged together
                text = " ".join(t for _, g, t in own if g is None)
                assert block.good == (html_text.points(len(text), html_text._stop_share(text), 0, region, False, False) >= 1)


def test_second_pass_and_length_change_the_test_pages(spark, sf_dir, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet").select("html").collect()]
    whole = [html_text.main_text(p) for p in pages]
    monkeypatch.setitem(html_text.WEIGHTS, "length", 0)
    assert any(html_text.main_text(p) != w for p, w in zip(pages, whole))
    monkeypatch.setitem(html_text.WEIGHTS, "length", 1)
    monkeypatch.setattr(html_text, "second_pass", lambda page: None)
    assert sum(html_text.main_text(p) != w for p, w in zip(pages, whole)) > 0.9 * len(pages)
