"""The ten operators against plain versions, the tokenizers' own libraries, and on odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from llm import brute
from llm.conftest import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobweave.llm import components, decontamination, hilbert_sharding, html_density, jaccard_join, line_crf, ppm_language, suffix_dedup, token_counts, warc_derivatives, word_bpe
from jobweave.llm.common import slices
from jobweave.llm.components import connected_components

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def by_id(frame):
    return {r["doc_id"]: tuple(r)[1:] for r in frame.collect()}


# 1 suffix-array dedup


def test_removed_bytes(docs, texts):
    assert by_id(suffix_dedup.removal_report(suffix_dedup.suffix_dedup(docs))) == brute.removed_bytes(texts)


def test_removed_bytes_of_frequent_grams(docs, texts, monkeypatch):
    cut = suffix_dedup.marked_spans

    def all_frequent(source, places, splitters, frequent, buckets):
        grams, _ = suffix_dedup.sampled_grams(source, 1, 1)
        hot = suffix_dedup.np.sort(suffix_dedup.np.array(grams, dtype=f"S{suffix_dedup.GRAM}"))
        return cut(source, places, splitters, hot, buckets)

    monkeypatch.setattr(suffix_dedup, "marked_spans", all_frequent)
    assert by_id(suffix_dedup.removal_report(suffix_dedup.suffix_dedup(docs))) == brute.removed_bytes(texts)


def test_every_frequent_gram_is_found(spark):
    """A passage that half of the documents hold: all of its chosen grams are cut into stretches, not a hashed eighth of them."""
    rng = random.Random(31)
    passage = prose(rng, 40).replace("\n", " ")
    rows = [(i, prose(rng, 30) + (" " + passage + " " if i % 2 else " ") + prose(rng, 10)) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = suffix_dedup.keyed(frame, "doc_id", "text")
    thin, often = suffix_dedup.sampled_grams(keyed, 60, sum(len(t) for _, t in rows))
    inside = [g for g in often if g in passage.encode()]
    assert len(inside) >= len(passage) // 61 - 1 and len(thin) < len(inside) * 60
    assert by_id(suffix_dedup.removal_report(suffix_dedup.suffix_dedup(frame))) == brute.removed_bytes(rows)


def test_windows_choose_alike_in_slices_of_every_size():
    np = suffix_dedup.np
    rng = random.Random(33)
    window = prose(rng, 60).encode()[:300]
    chosen = []
    for size in (0, 5_000, 3_000_000):
        data = np.frombuffer(b"x" * 200 + bytes(rng.choices(range(97, 122), k=size)) + window, np.uint8)
        place, _, first, last = suffix_dedup.chosen_grams(data, np.array([0, len(data)]))
        base = len(data) - len(window)
        inside = first >= base
        chosen.append(sorted(zip((place[inside] - base).tolist(), (last[inside] - base).tolist(), strict=True)))
    assert chosen[0] == chosen[1] == chosen[2] and len(chosen[0]) > 3


def test_removal_keeps_whole_characters(docs):
    kept = suffix_dedup.suffix_dedup(docs, whole_characters=True).collect()
    assert all(bytes(r["kept"]).decode("utf-8") is not None for r in kept)


def test_removal_on_odd_rows(odd_docs, no_docs):
    rows = suffix_dedup.removal_report(suffix_dedup.suffix_dedup(odd_docs)).collect()
    removed = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in rows)
    size = max(r["n_bytes"] for r in rows if r["doc_id"] == 1)
    assert [r[3] for r in removed] == [size, size, size, 0, 0]
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


def test_removal_of_texts_that_share_an_id(spark):
    a, b, c = (prose(random.Random(n), 60) for n in (101, 102, 103))
    rows = [(None, a), (None, b), (None, None), (1, c), (1, a + " " + c), (1, b), (2, c)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, brute.sha(r[1] or "")))
    want = brute.removed_bytes([(n, t) for n, (_, t) in enumerate(order)])
    got = [tuple(r) for r in suffix_dedup.removal_report(suffix_dedup.suffix_dedup(frame)).collect()]
    assert sorted(got, key=str) == sorted(((order[n][0], *w) for n, w in want.items()), key=str)


# 2 token counts


def test_token_counts(docs, texts):
    library = Tokenizer.from_file(BYTE_BPE)
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts}
    got = by_id(token_counts.token_counts(docs, BYTE_BPE))
    assert {i: r[:2] for i, r in got.items()} == want
    assert all(r[2] == (r[1] > 1024) for r in got.values())


def test_token_counts_on_mixed_text():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\r\n", "'", "'s", "'re", "'l", "don't", "a", "bc", "12", "³", "é", "中文", "😀", "!!", "<|endoftext|>", "　", "\x1c", "the", " tion"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(3000)] + ["a" * 3000, " " * 700, "'" * 300]
    machine = token_counts.PieceTransducer(BYTE_BPE)
    got = token_counts.count_texts(texts, machine, token_counts.class_table(), *token_counts.compile_pieces())
    assert got.tolist() == [len(e.ids) for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_on_odd_rows(odd_docs, no_docs):
    assert token_counts.token_counts(odd_docs, BYTE_BPE).count() == 5
    assert token_counts.token_counts(no_docs, BYTE_BPE).count() == 0


# 3 language identification


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = ppm_language.fit(docs)
    rows = ppm_language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_bits(counts, raw):
    """Code length of a text, byte by byte, from counts of (context, byte)."""
    import math

    padded, bits = bytes([255] * 3) + raw, 0.0
    for at in range(3, len(padded)):
        for size in (3, 2, 1, 0):
            own = counts.get(padded[at - size : at])
            if own is None:
                continue
            total, distinct = sum(own.values()), len(own)
            if padded[at] in own:
                bits += math.log2((total + distinct) / own[padded[at]])
                break
            bits += math.log2((total + distinct) / distinct)
        else:
            bits += 8.0
    return bits


def test_code_lengths_equal_a_plain_tree(spark, monkeypatch):
    """Three scripts and a rare language; every context and byte of the training texts counts."""
    rng = random.Random(21)
    scripts = {"la": "abcdeghilmnorstu", "el": "αβγδεηικλμνορστυ", "zh": "的一是不了人我在有他这为之大来以", "rare": "žščřďťňáíéabou"}
    made = lambda name: " ".join("".join(rng.choices(scripts[name][:12], k=rng.randint(1, 7))) for _ in range(rng.randint(5, 60)))
    rows = [(i, made(name), name) for i, name in enumerate(["la"] * 60 + ["el"] * 60 + ["zh"] * 60 + ["rare"] * 6)]
    docs = spark.createDataFrame([*rows, (900, None, "la"), (901, "x", None)], "doc_id long, text string, lang string").repartition(4)
    counts = {}
    for i, text, name in rows:
        if zlib.crc32(str(i).encode()) % 5:
            padded = bytes([255] * 3) + text.encode()
            for at in range(3, len(padded)):
                for size in range(4):
                    own = counts.setdefault(name, {}).setdefault(padded[at - size : at], {})
                    own[padded[at]] = own.get(padded[at], 0) + 1
    monkeypatch.setattr(ppm_language, "SCORED_BYTES", 500)
    model = ppm_language.fit(docs)
    assert model.languages == sorted(counts)
    asked = [(i, t) for i, t, _ in rows[::7]] + [(1000, "αβ mixed 的一 text! " * 3), (1001, "Ж новое"), (1002, "a")]
    found = by_id(ppm_language.identify(spark.createDataFrame(asked, "doc_id long, text string"), model))
    for i, text in asked:
        bits = {name: plain_bits(own, text.encode()) for name, own in counts.items()}
        best = min(sorted(bits), key=bits.get)
        assert found[i][1] == best and found[i][3] * len(text.encode()) == pytest.approx(bits[best], abs=1e-6)
        assert found[i][2] == pytest.approx(1 / sum(2.0 ** (bits[best] - b) for b in bits.values()), abs=1e-6)
    held = [(r["lang"], r["lang_pred"]) for r in ppm_language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()]
    for name in scripts:
        assert all(pred == lang for lang, pred in held if lang == name), name


def test_language_on_odd_rows(docs, odd_docs, no_docs, texts):
    model = ppm_language.fit(docs)
    got = by_id(ppm_language.identify(docs, model))
    for i, t in texts:
        held, pred, score, _ = got[i]
        assert held == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert (pred == "und") == (not any(map(str.isalpha, t or ""))) and 0 <= score <= 1
    assert ppm_language.identify(odd_docs, model).count() == 5
    assert ppm_language.identify(no_docs, model).count() == 0
    assert {r["lang_pred"] for r in ppm_language.identify(docs, ppm_language.fit(no_docs)).collect()} == {"und"}


# 4 sharding


def test_curve_visits_neighbours(spark):
    cells = spark.range(512).select(*[F.expr(f"cast(shiftright(id, {3 * d}) & 7 as int)").alias(f"x{d}") for d in range(3)])
    placed = cells.withColumn("h", hilbert_sharding.hilbert_index([F.col(f"x{d}") for d in range(3)], 3)).orderBy("h").collect()
    assert [r["h"] for r in placed] == list(range(512))
    steps = [sum(abs(a[d] - b[d]) for d in range(3)) for a, b in zip(placed[:-1], placed[1:], strict=True)]
    assert set(steps) == {1}


def test_shards(docs, odd_docs, no_docs, texts):
    rows = hilbert_sharding.document_shards(docs).collect()
    sizes = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == sizes
    check_shards(rows)
    check_shards(hilbert_sharding.document_shards(odd_docs).collect())
    assert hilbert_sharding.document_shards(no_docs).count() == 0


def check_shards(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(n, [])) for n in range(16)]
    assert max(counts) - min(counts) <= 1


def test_size_cuts_come_from_all_rows(spark):
    """Exact quantiles of far more rows than a sample of them would hold."""
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") * F.col("id")).alias("size"))
    want = np.percentile(np.arange(40_000, dtype=float) ** 2, [100 * n / 32 for n in range(1, 32)])
    assert hilbert_sharding.size_cuts(rows, "size", ["doc_id"], 5) == pytest.approx(list(want))


def test_shards_follow_the_curve_and_prune_files(spark, new_dir):
    """A plain sort by curve index gives the same order, and a filter on language and size meets few of the written files."""
    import pyarrow.dataset as ds

    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    rows = hilbert_sharding.document_metadata(docs)
    cuts = hilbert_sharding.size_cuts(rows, "size", ["doc_id"], 5)
    assert len(cuts) == 31
    levels = [r["n"] for r in rows.groupBy(hilbert_sharding.ranged_level(F.col("size"), cuts).alias("level")).agg(F.count("*").alias("n")).collect()]
    assert len(levels) == 32 and max(levels) < 0.06 * sum(levels)
    coordinates = [hilbert_sharding.hashed_level(F.col("lang"), 5), hilbert_sharding.hashed_level(F.col("source"), 5), hilbert_sharding.ranged_level(F.col("size"), cuts)]
    placed = hilbert_sharding.hilbert_shards(rows, coordinates, 5, 16, ["doc_id"], ["doc_id", "size", "lang", "source"])
    order = [r["curve_index"] for r in placed.orderBy("shard", "slot").collect()]
    assert order == sorted(order)
    hilbert_sharding.write_shards(placed, new_dir + "/shards", 16)
    longest = sorted(r["size"] for r in rows.collect())[-100]
    met = 0
    for f in ds.dataset(new_dir + "/shards").get_fragments():
        s = [g.statistics for g in f.row_groups]
        met += any(g["size"]["max"] >= longest and g["lang"]["min"] <= "de" <= g["lang"]["max"] for g in s)
    assert 0 < met <= 8
    found = spark.read.parquet(new_dir + "/shards")
    assert found.where(f"lang = 'de' and size >= {longest}").count() == rows.where(f"lang = 'de' and size >= {longest}").count() and found.count() == rows.count()


# 5 BPE


def test_bpe_round_trip(docs, texts, odd_docs, no_docs):
    library = Tokenizer.from_file(WORD_BPE)
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in word_bpe.bpe_round_trip(docs, WORD_BPE).collect()}
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False))
    assert word_bpe.bpe_round_trip(odd_docs, WORD_BPE).count() == 5
    assert word_bpe.bpe_round_trip(no_docs, WORD_BPE).count() == 0


def test_bpe_words_of_mixed_text():
    rng = random.Random(6)
    library, own = Tokenizer.from_file(WORD_BPE), word_bpe.WordTokenizer(WORD_BPE)
    bits = [" ", "\n", "a", "É", "İ", "Σ", "ΟΔΟΣ", "'s", "'LL", "12", "<|endoftext|>", "<|STARTOFTEXT|>", "\x1c", "\x85", "\xa0", "中", "😀", "ﬁ", "x̧", "Å"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 20)))
        assert [i for e in own.encode(own.words(text)) for i in e] == library.encode(text, add_special_tokens=False).ids


# 6 HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav class="top"><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav>
<div id="cookie-notice">We use cookies, accept all of them now please.</div><!-- <p>gone</p> -->
<div class="page"><article><header><h1>The  title</h1></header><p>First paragraph &amp; more text of some length, with a <a href="/l">link</a> in it.
<p><b>Second</b> paragraph<br>that goes on for a while and ends here.</p><ul><li>an item of a list in the text<li>another item of it</ul>
<form><input><p>Sign up</p></form><aside>Read this too</aside><p>Short.</p><div class="comments"><p>I do not agree with this text at all.</p></div></article></div>
<div class="sideBar"><p>Other things that you might like to read today.</p></div><footer>&copy; someone</footer></body></html>"""


def test_article_of_a_page():
    assert html_density.main_text(PAGE).split("\n") == [
        "The title", "First paragraph & more text of some length, with a link in it.", "Second paragraph that goes on for a while and ends here.",
        "an item of a list in the text", "another item of it", "Short.",
    ]


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "<p>", "</p>", "<a href='x>y</a>", "<script>never ends", "<!-- never ends", "<b><i></b>text</i>", "&#0; &bogus; &lt;"])
def test_broken_pages(page):
    assert isinstance(html_density.main_text(page), str)


ARTICLE = "<h1>A title</h1><p>First paragraph of some length, with nothing else in it.</p><p>Second paragraph that goes on for a while.</p>"
HEADS = ["<head><title>T</title><meta charset=utf-8><body>", "<head><title>T</title><link rel='a'>", "<head><script>x()</script><noscript><img></noscript><title>T</title></head><body>"]


@pytest.mark.parametrize("head", HEADS)
def test_head_ends_where_the_body_begins(head):
    page = f"<!DOCTYPE html><html>{head}<div>{ARTICLE}</div></html>"
    want = ["A title", "First paragraph of some length, with nothing else in it.", "Second paragraph that goes on for a while."]
    assert html_density.main_text(page).split("\n") == want
    assert warc_derivatives.visible_text(page).split("\n") == want


@pytest.mark.parametrize("wrap", ["<div class='content-sidebar-wrap'>{}</div>", "<div class='has-sidebar'><article>{}</article></div>", "<main><div id='comments-open'>{}</div></main>", "<div class='comments-open'><main>{}</main></div>"])
def test_wrapper_of_the_article_is_kept(wrap):
    rest = "<div class='sidebar'><p>Other things to read.</p></div><div class='related'><article><p>A card.</p></article></div>"
    page = f"<html><head><title>T</title></head><body>{wrap.format(ARTICLE)}{rest}</body></html>"
    assert html_density.main_text(page).split("\n") == ["A title", "First paragraph of some length, with nothing else in it.", "Second paragraph that goes on for a while."]


COMMENT = "<p>I have read all of this and I do not agree with a single word of it, as I have said before.</p>"
ARTICLE_LINES = ["A title", "First paragraph of some length, with nothing else in it.", "Second paragraph that goes on for a while."]


@pytest.mark.parametrize("times", [1, 3, 10])
@pytest.mark.parametrize("page", [
    "<div id=content>{article}</div><div class='comments'>{comments}</div>",
    "<article>{article}<section class='comments'>{comments}</section></article>",
    "<article>{article}</article><section class='comments'><article>{comments}</article><article>{comments}</article></section>",
    "<article>{article}</article><article class='comment'>{comments}</article><article class='comment even'>{comments}</article>",
    "<article>{article}<article>{comments}</article><article>{comments}</article></article>",
    "<div class='comments-open has-sidebar'><div id=content>{article}</div><ol class='commentlist'><li>{comments}</ol></div>",
    "<main>{article}<div id='post-comments'>{comments}</div><div class='comments-area'>{comments}</div><div class='comment-content'>{comments}</div></main>",
    "<div id=content>{article}</div><div class='cookie-notice-open'>{comments}</div><div class='advert-wrap'>{comments}</div><div class='no-comments'>{comments}</div>",
])
def test_comments_never_come_in_place_of_the_article(page, times):
    size = len(ARTICLE) // len(COMMENT) * times + 1
    body = page.format(article=ARTICLE, comments=COMMENT * size)
    assert html_density.main_text(f"<html><head><title>T</title></head><body>{body}</body></html>").split("\n") == ARTICLE_LINES


def test_pages_table(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y"), (3, "w", "<div>" * 3000 + "deep", "z")], "page_id long, url string, html string, text string")
    got = html_density.extract_pages(rows).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["n_chars"] for r in got if r["page_id"] != 1} == {None: 0, 2: 0, 3: 4}
    assert html_density.extract_pages(rows.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    markup = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_density.extract_pages(pages).collect():
        article = markup[r["page_id"]].split("<article>")[1].split("<footer>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:h1|p|article)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


# 7 quality rules


def test_word_statistics(docs, texts, odd_docs, no_docs):
    chain = line_crf.Chain(line_crf.np.zeros(line_crf.FEATURES), line_crf.np.zeros((2, 2)), line_crf.np.zeros(2))
    got = by_id(line_crf.judge(docs, chain))
    for i, t in texts:
        assert got[i][:6] == brute.word_statistics(t)
        assert got[i][6] == (not got[i][5])
    assert line_crf.judge(odd_docs, chain).count() == 5 and line_crf.judge(no_docs, chain).count() == 0


def test_viterbi_is_the_best_of_all_paths():
    from itertools import product

    np = line_crf.np
    rng = np.random.default_rng(4)
    chain = line_crf.Chain(rng.normal(size=line_crf.FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2))
    doc = np.repeat([0, 1, 2], [6, 1, 4])
    features = rng.integers(0, line_crf.FEATURES, (11, 3))
    node = line_crf.scores(chain, features)
    got = line_crf.viterbi(chain, features, doc)
    for n in range(3):
        rows = np.flatnonzero(doc == n)
        value = lambda path: chain.first[path[0]] + sum(node[r, x] for r, x in zip(rows, path, strict=True)) + sum(chain.moves[a, b] for a, b in zip(path[:-1], path[1:], strict=True))  # noqa: E731, B023
        assert value(got[rows]) == pytest.approx(max(value(p) for p in product([0, 1], repeat=len(rows))))


def test_quality_verdicts(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    chain = line_crf.fit(docs, labels)
    rows = line_crf.judge(docs, chain).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)
    line_crf.judge(docs, line_crf.fit(docs, labels.limit(0))).count()


# 8 decontamination


def test_contamination(spark, docs, texts, odd_docs, no_docs):
    words = " ".join(brute.benchmark_words(texts[8][1] + " " + texts[11][1]))
    items = [(1, words[:150]), (10, " ".join(words.split()[3:8])), (2, texts[9][1]), (3, texts[9][1]), (4, None), (5, "!!"), (6, "nowhere to be found"), (7, "one")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute.contamination(texts, items)
    for block in (50_000, 7):
        report = decontamination.contamination_report(decontamination.decontaminate(docs, table, block=block))
        assert {i: r[:4] for i, r in by_id(report).items()} == want
    assert any(v[1] for v in want.values()) and not all(v[1] for v in want.values())
    assert decontamination.decontaminate(odd_docs, table).count() == 5
    assert decontamination.decontaminate(no_docs, table).count() == 0
    assert decontamination.decontaminate(docs, table.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("block", [1, 50_000])
def test_contamination_of_texts_that_share_an_id(spark, block):
    """Every row keeps the hits and items of its own text, in the same way at every size of the benchmark."""
    one, two, other = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "un deux trois quatre cinq", "nothing of the kind in here")
    rows = [(1, f"so {one} end"), (1, f"{two} et {two}"), (1, other), (None, f"{one} {two}"), (None, None), (2, one), (2, one), (3, f"{one} lambda")]
    items = [(10, one), (20, two), (30, f"{one} lambda mu"), (None, "of the kind")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block=block).collect()
    got = sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["item_ids"])) for r in found], key=str)
    want = brute.contamination(list(enumerate(t for _, t in rows)), items)
    plain = [(rows[n][0], w[0], w[1]) for n, w in want.items()]
    assert sorted([r[:3] for r in got], key=str) == sorted(plain, key=str)
    assert got == sorted([(1, 12, 10, ["10", "30"]), (1, 11, 10, ["20"]), (1, 6, 3, []), (None, 15, 15, ["10", "20", "30"]), (None, 0, 0, []), (2, 10, 10, ["10", "30"]), (2, 10, 10, ["10", "30"]), (3, 11, 11, ["10", "30"])], key=str)


def test_contamination_with_full_bitmaps(docs, texts, spark, monkeypatch):
    """Where the bitmaps let everything through, the join alone decides."""
    items = [(1, texts[8][1]), (2, texts[9][1]), (3, "one")]
    monkeypatch.setattr(decontamination, "bitmap", lambda hashes: decontamination.np.full(4096, 255, decontamination.np.uint8))
    got = decontamination.contamination_report(decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")))
    assert {i: r[:4] for i, r in by_id(got).items()} == brute.contamination(texts, items)


# 9 Jaccard join


def test_components(docs, texts, odd_docs, no_docs):
    assert by_id(jaccard_join.jaccard_components(docs)) == brute.components(texts)
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(odd_docs).collect()]
    assert sorted(rows, key=str) == sorted([(None, 0, None), (None, 78, None), (1, 78, None), (1, 78, None), (2, 79, None)], key=str)
    assert jaccard_join.jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("part", [1, 1 << 30])
def test_shared_shingles_of_many_ranges_and_parts(spark, monkeypatch, part):
    """Rows of one id add up, whatever part they are in, and however many ranges there are for a part."""
    monkeypatch.setattr(jaccard_join, "PART", part)
    monkeypatch.setattr(jaccard_join, "slices", lambda batch, column: slices(batch, column, 2000))
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([0, 1, 30, 200])) for _ in range(60)]
    rows = [(n % 70, t) for n, t in enumerate([*texts, *texts[:20], "odd one out"])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = [(i, brute.shingles(t)) for i, t in rows]
    times = Counter(s for _, own in held for s in own)
    want = Counter()
    for i, own in held:
        want[i] += sum(times[s] > 1 for s in own)
    got = {r["doc_id"]: r["n_shared"] for r in jaccard_join.shared_shingles(frame, 97).collect()}
    assert got == {i: n for i, n in want.items() if n}


def test_components_over_tiles(docs, texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 900)
    assert by_id(jaccard_join.jaccard_components(docs)) == brute.components(texts)


def test_components_of_small_and_bordering_sets(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for size in (3, 8, 9, 10, 11, 12, 13, 20, 21, 60, 120):
        base = rng.sample(words, size)
        for n in range(6):
            copy = list(base)
            for _ in range(n % 3):
                copy[rng.choice([0, -1])] = rng.choice(words)
            rows.append((len(rows), " ".join(copy + rng.sample(words, n // 3))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(jaccard_join.jaccard_components(frame)) == brute.components(rows)


def test_rtree_finds_every_pair_that_can_be_similar():
    np = jaccard_join.np
    rng = np.random.default_rng(8)
    points = np.repeat(rng.poisson(3, (60, 16)), 3, axis=0) + (rng.random((180, 16)) < 0.03)
    sizes = points.sum(axis=1)
    find, unite = jaccard_join.forest(len(points))
    for i in range(len(points)):
        for j in range(i):
            if 190 * np.minimum(points[i], points[j]).sum() >= 90 * (sizes[i] + sizes[j]) and 100 * min(sizes[i], sizes[j]) >= 90 * max(sizes[i], sizes[j]):
                unite(i, j)
    find_own, unite_own = jaccard_join.forest(len(points))
    for i, j in jaccard_join.rtree_links(points, sizes, None):
        unite_own(i, j)
    assert [find(i) for i in range(len(points))] == [find_own(i) for i in range(len(points))]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 5), (7, 3), (3, 7), (9, 7), (50, 51)] + [(200, i) for i in range(201, 230)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {3: 3, 7: 3, 9: 3, 50: 50, 51: 50} | {i: 200 for i in range(200, 230)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_seal_of_many_edges(spark):
    edges = spark.range(0, 1 << 25, 1, 8).select(F.col("id").alias("a"), F.lit(-1).cast("long").alias("b"))
    assert components._seal(edges)[0] == 1 << 25 and components._seal(edges) != components._seal(edges.withColumn("b", F.lit(-2).cast("long")))


# 10 WARC derivatives


def test_derivatives(spark):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-A: 1\r\n\r\n"
    payload = "<html><head><title>no</title></head><body><p>Café &amp; bar</p><script>x()</script><div>two  words</div>".encode("latin-1")
    block = http + payload
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:STATED\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    raw = head + block + b"\r\n\r\n"
    made = {r["record_type"]: r for r in warc_derivatives.derive(raw)}
    text, about = made["conversion"], made["metadata"]
    assert text["record"].split(b"\r\n\r\n", 1)[1] == "Café & bar\ntwo words".encode() + b"\r\n\r\n"
    for record in (text, about):
        assert record["refers_to"] == "<urn:uuid:1>" and record["target_uri"] == "http://a/" and record["payload_digest"] == "sha1:STATED"
        lines, body = record["record"].split(b"\r\n\r\n", 1)
        assert b"WARC-Refers-To: <urn:uuid:1>" in lines and f"Content-Length: {record['content_length']}".encode() in lines
        assert warc_derivatives.digest(body[:-4]) == record["block_digest"] and len(body) - 4 == record["content_length"]
    assert b"payload-digest-valid: false" in about["record"] and b"http-x-a: 1" in about["record"]
    assert text["record_id"].encode() in about["record"] and f"WARC-Concurrent-To: {about['record_id']}".encode() in text["record"]
    rows = spark.createDataFrame([(1, bytearray(raw)), (1, bytearray(raw)), (None, None), (2, bytearray(b"")), (3, bytearray(b"junk")), (4, bytearray(raw.replace(b"Type: response", b"Type: request")))], "refers_to long, record binary")
    assert warc_derivatives.build_derivatives(rows.withColumnRenamed("refers_to", "n"), columns=("n",)).groupBy("n").count().collect() == [(1, 4)]
    assert warc_derivatives.build_derivatives(rows.limit(0)).count() == 0


def test_charset_anywhere_in_the_head():
    filler = b"<script>" + b"x();" * 2000 + b"</script>"
    for meta, name in ((b"<meta charset=iso-8859-1>", "iso-8859-1"), (b"<META http-equiv='Content-Type' content='text/html; Charset=windows-1252'>", "windows-1252"), (b"", "utf-8")):
        payload = b"<html><head>" + filler + meta + b"</head><body><p>charset=latin-1 caf\xe9</p>"
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + payload
        made = {r["record_type"]: r for r in warc_derivatives.derive(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\n\r\n" + block)}
        assert f"charset: {name}\r\n".encode() in made["metadata"]["record"]
        assert made["conversion"]["record"].endswith(("charset=latin-1 café" if meta else "charset=latin-1 caf\ufffd").encode() + b"\r\n\r\n")


def test_every_record_of_the_given_pages_parses_back(spark):
    """A plain reader of the WARC format gets every derived record of every page, linked and with true lengths and digests."""
    import base64
    import hashlib

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = warc_derivatives.build_derivatives(warc_derivatives.page_responses(pages), columns=("page_id", "url")).collect()
    markup = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == 2 * len(markup)
    ids = {}
    for r in rows:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = rest[:size]
        assert first == "WARC/1.1" and rest[size:] == b"\r\n\r\n" and fields["WARC-Type"] == r["record_type"] and fields["WARC-Target-URI"] == r["url"]
        assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() == r["block_digest"]
        ids.setdefault(r["page_id"], {})[r["record_type"]] = fields
        if r["record_type"] == "conversion":
            assert block.decode() == warc_derivatives.visible_text(markup[r["page_id"]])
        else:
            assert f"payload-length: {len(markup[r['page_id']].encode())}\r\n".encode() in block
    for own in ids.values():
        assert own["metadata"]["WARC-Refers-To"] == own["conversion"]["WARC-Refers-To"] and own["conversion"]["WARC-Concurrent-To"] == own["metadata"]["WARC-Record-ID"]
    assert len({f["WARC-Record-ID"] for own in ids.values() for f in own.values()}) == len(rows)


def test_derivatives_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>", "r"), (None, None, None, "s")], "page_id long, url string, html string, record string")
    rows = warc_derivatives.build_derivatives(warc_derivatives.page_responses(pages), columns=("page_id",)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["content_length"] > 0) for r in rows) == [("1", "conversion", True), ("1", "metadata", True), ("None", "conversion", False), ("None", "metadata", True)]
    ids = {(r["page_id"], r["refers_to"]) for r in rows}
    assert len(ids) == 2
