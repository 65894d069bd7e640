"""Byte-level BPE, quality ranking, HTML extraction and URL rules."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm import bpe, common, html_crf, quality, url_filter
from tabloom.llm.html_blocks import blocks

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType())])


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.public_vocabulary()


@pytest.fixture(scope="module")
def reference(vocabulary):
    data, pattern = vocabulary
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})


ODD_TEXTS = ["", " ", "a" * 5000, "  \n\t x", "it's 'LL we'll", "日本語テキスト", "é" * 90, "😀😀 x", "<|endoftext|>", "\x00\x1c\x85\xa0 ²½ª", "ab cd " * 30_000]


def test_bpe_equals_tiktoken(vocabulary, reference):
    codec = bpe.codec(*vocabulary)
    rng = random.Random(4)
    letters = "ab etion'sß日é\n\t 12.-!😀\x1f²"
    texts = ODD_TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for text in texts:
        ids = list(codec.encode(text))
        assert ",".join(ids) == ",".join(map(str, reference.encode_ordinary(text))), text[:40]
        assert "".join(codec.decode(ids)) == text


def test_bpe_states_may_be_dropped(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 40)
    transducer = bpe.Transducer(bpe.parse_ranks(vocabulary[0]))
    rng = random.Random(1)
    for _ in range(60):
        word = "".join(rng.choice("abetion th") for _ in range(rng.randint(1, 60))).encode()
        assert transducer.encode(word) == ([transducer.ranks[word]] if word in transducer.ranks else transducer.merge(word))


def test_frequent_words_stay_however_many_rare_ones_pass(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 16)
    codec, met = bpe.Codec(bpe.parse_ranks(vocabulary[0]), vocabulary[1]), []
    encode = codec.transducer.encode
    monkeypatch.setattr(codec.words, "encode", lambda data: met.append(data) or encode(data))
    text = "".join(f" hotzqx rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100))
    assert "".join(codec.decode(codec.encode(text))) == text
    assert met.count(b" hotzqx") == 1 and len(set(met)) == 101 and len(codec.words) + len(codec.words.older) <= 16


def test_utf8_machine_cut_anywhere():
    data = "aé日😀\ufffdz".encode() + b"\xe2\x82"
    for cut in range(len(data)):
        machine = bpe.Utf8Machine()
        assert machine.feed(data[:cut]) + machine.feed(data[cut:]) + machine.end() == data.decode("utf-8", "replace")
    bad = b"\xc0\x80a\xed\xa0\x80b\xf5"
    machine = bpe.Utf8Machine()
    assert "".join(machine.feed(bad[i : i + 1]) for i in range(len(bad))).count("a") == 1


def test_bpe_query_rows(spark, vocabulary, reference):
    rows = [(1, "two words", "x"), (1, "two words", "x"), (2, None, None), (None, "", None), (3, "ab cd " * 40_000, "x")]
    found = {(r.doc_id, r.n_tokens): r for r in bpe.round_trip(spark.createDataFrame(rows, DOCS), *vocabulary).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert found[(2, 0)].ids_sha256 == found[(2, 0)].decoded_sha256 == found[(None, 0)].ids_sha256 == empty
    ids = reference.encode_ordinary(rows[4][1])
    assert found[(3, len(ids))].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found[(3, len(ids))].decoded_sha256 == hashlib.sha256(rows[4][1].encode()).hexdigest()
    assert bpe.round_trip(spark.createDataFrame([], DOCS), *vocabulary).count() == 0


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality.op2_bradley_terry(spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    held = [(rows[i].predicted, q) for i, q in labels if rows[i].held_out]
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "word", "k")], DOCS)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == 3 and all(abs(r.score - 0.3) < 1e-9 for r in rows)
    assert quality.quality_scores(spark.createDataFrame([], DOCS), labels).count() == 0


def test_pair_ranker_orders_and_cuts():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (500, len(quality.FEATURES))), rng.normal(0, 1, (80, len(quality.FEATURES)))
    bad[:, 0] += 5
    ranker = quality.fit_pairs(good, bad)
    assert ranker.weights[0] < 0
    assert (ranker.strength(good) >= ranker.cut).mean() > 0.97 and (ranker.strength(bad) < ranker.cut).mean() > 0.97


@pytest.fixture(scope="module")
def model(spark):
    return html_crf.Crf.fit([html_crf.from_marked(p) for p in html_crf.training_pages(html_crf.table(spark, FOLDER, "pages"), 150)])


def test_html_blocks():
    page = "<div>a &lt;b&gt;<br>c<script>x('</p>')</script><p><b>one <i>two</b><p title='>'>three<!-- no --><ul><li>x<li>y</ul> 1 < 2<style>p{}"
    assert [b.text for b in blocks(page)] == ["a <b> c", "one two", "three", "x", "y", "1 < 2"]
    assert blocks("") == [] and blocks("<script>never closed") == [] and blocks('<p class="a') == []
    assert [b.text for b in blocks("<b>" * 50_000 + "deep")] == ["deep"]


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("<p>a<svg class=menu><path d=x/>b<p>c<div>d</div>", ["a b", "c", "d"]),
        ("<p>a <svg><g/> <p>b <svg><svg><text>no</text></svg></svg> c", ["a", "b c"]),
        ("<p>a <math><mi>x</mi><p>b", ["a x", "b"]),
        ("<p>a <object data=x><param name=y>b<p>c", ["a b", "c"]),
        ("<p>a <canvas>b<p>c", ["a b", "c"]),
        ("<p>a <noscript>b<p>c", ["a b", "c"]),
        ("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p>", ["let x=1 be"]),
        ("<p>a <object><param>in <b>it</b></object> b <canvas>c</canvas> d</p>", ["a in it b c d"]),
        ("<p>a <script>no</script>b<iframe>no</iframe>c <svg/>d <noscript>no</noscript>e<style>no</style>f</p>", ["a b c d ef"]),
        ("<p>a<select><option>no<input>b<p>c", ["a b", "c"]),
        *[(f"<p>a<{tag}>no<p>no", ["a"]) for tag in ("script", "style", "textarea", "title", "iframe", "template", "select")],
        ("<noscript>" * 20_000 + "<svg>" * 20_000 + "<p>a", ["a"]),
    ],
)
def test_html_blocks_with_raw_elements(page, wanted):
    assert [b.text for b in blocks(page)] == wanted


def test_marks_of_an_unclosed_svg_end_with_it():
    assert [b.marks for b in blocks("<svg class=menu><p>a")] == [0]


def test_crf_accuracy_on_other_words(model):
    layouts = html_crf.Layouts(["Unseen words stand here, in a sentence of some length."], ["Other link"], seed=77)
    pages = [html_crf.from_marked(layouts.page()) for _ in range(100)]
    right = sum(a == b for f, y in pages for a, b in zip(model.decode(f), y))
    assert right / sum(len(y) for _, y in pages) > 0.96


def test_crf_viterbi_is_the_best_path(model):
    from itertools import product

    features = html_crf.from_marked(html_crf.Layouts([], []).page())[0][:8]

    def score(path):
        emitted = sum(sum(model.weights.get(n, 0) for n in f) for f, y in zip(features, path) if y)
        return emitted + sum(model.steps[a, b] for a, b in zip(path, path[1:]))

    best = max(product((0, 1), repeat=len(features)), key=score)
    assert score(model.decode(features)) == pytest.approx(score(best))


def test_extract_rows(spark, model):
    schema = "page_id bigint, url string, html string, text string"
    page = "<body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>A first sentence, with words  in it.</p></article><footer>&copy; x</footer>"
    rows = [(1, "u", page, "clash"), (1, "u", page, "clash"), (2, None, None, None), (None, "u", "", None), (3, "u", "<article>" + "<p>Some words, in a row of them.</p>" * 5000, None)]
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_crf.extract(spark.createDataFrame(rows, schema), model).collect())
    assert found[0] == (0, "", 0) and found[1] == found[2] == (1, "Title\nA first sentence, with words in it.", 41) and found[3] == (2, "", 0)
    assert found[4][1].count("\n") == 4999
    assert html_crf.extract(spark.createDataFrame([], schema), model).count() == 0


def test_url_rules():
    trie = url_filter.RuleTrie([*url_filter.RULES, ("a.org", "/x", "block"), ("a.org", "/x/y/", "allow"), ("", "/bad/", "block"), ("com", "/", "block")])
    cases = {
        "http://EXAMPLE.com/en/1": ("example.com/en/", "block"),
        "http://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://m.www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("com/", "block"),
        "http://example.com": None,
        "http://q.net/es/": ("net/es/", "block"),
        "http://q.net/esp": None,
        "http://a.org/xyz": ("a.org/x", "block"),
        "http://b.a.org/x/y/z?x": ("a.org/x/y/", "allow"),
        "x://h/bad/1": ("/bad/", "block"),
    }
    for url, wanted in cases.items():
        assert trie.find(*url_filter.split_url(url)) == wanted, url
    assert url_filter.split_url("a://B.c?x") == ("b.c", "") and url_filter.split_url(None) == url_filter.split_url("no") == ("", "")
    with pytest.raises(ValueError):
        url_filter.RuleTrie(url_filter.RULES, most=2)


def test_url_rows(spark):
    schema = "page_id bigint, url string, rule string, host string"
    rows = [(1, None, "r", "h"), (1, None, "r", "h"), (None, "http://a.net/fr/" + "x" * 100_000, None, None)]
    found = url_filter.judge_urls(spark.createDataFrame(rows, schema), url_filter.RULES).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in found) == [(0, "net/fr/", "block"), (1, None, "allow"), (1, None, "allow")]
    assert url_filter.judge_urls(spark.createDataFrame([], schema), url_filter.RULES).count() == 0


@pytest.mark.parametrize("rows", [10, 40, 250, 2_000])
def test_hash_prefix_keeps_the_first_rows_of_the_hash_order(spark, rows):
    order = F.xxhash64("id", F.lit(5))
    df = spark.range(1_000)
    first = common.hash_prefix(df, 1_000, rows, order)
    assert first.orderBy(order).limit(rows).collect() == df.orderBy(order).limit(rows).collect()
    assert first.count() <= 8 * rows
    empty = df.limit(0)
    assert common.hash_prefix(empty, 0, rows, order).count() == 0
