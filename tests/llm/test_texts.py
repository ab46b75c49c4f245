"""Quality rules, main text, token counts and BPE against plain definitions and the libraries."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re
import struct
import time

import public_tokenizers
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellmeter.llm import encoding, html_text, quality, token_counts
from cellmeter.llm.bpe import PieceTokenizer, WordEndTokenizer

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD_TEXTS = [
    "", " ", "  ", "   a", "a  b   c    ", "\n\n a\n  b", "<s>hi</s> <unk>", "▁▁x", "a▁b", "a\0b",
    "日本語 テキスト  é́", "x" * 300, " " * 47, "   ́x", "🙂  🙂 ok", "\t\tdef f(x):\n\t    return",
    "ΑΣ ΑΣ ΣΑΣ İstanbul", "it's we'll I'VE x'd 'S", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>",
    "é ́a x y z\u0085w\x1cq", "①²½ Ⅷ ٣٤", "don't'll'''s",
]
SOME_TEXT = st.text(alphabet=" \n\t  aeiouthensTHE<>|sé日🙂▁1.,-'", max_size=60)


@pytest.fixture(scope="module")
def pieces():
    return PieceTokenizer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    return WordEndTokenizer(WORDS), Tokenizer.from_file(WORDS)


def check_pieces(pieces, text):
    mine, library = pieces
    assert mine.count(text.encode()) == len(library.encode(text))
    want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
    assert mine.prefix_counts(text) == want
    for budget in (0, 3):
        longest = max(i for i, n in enumerate(want) if n <= budget)
        assert mine.truncated(text, budget) == text[:longest]


def check_words(words, text):
    mine, library = words
    ids = library.encode(text, add_special_tokens=False).ids
    assert mine.encode(text.encode()) == ids
    assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_odd_texts_are_encoded_as_the_libraries_do(pieces, words, text):
    check_pieces(pieces, text)
    check_words(words, text)


@settings(max_examples=300, deadline=None)
@given(SOME_TEXT)
def test_random_texts_are_encoded_as_the_libraries_do(pieces, words, text):
    check_pieces(pieces, text)
    check_words(words, text)


def test_latin_words_are_encoded_without_the_library(words, monkeypatch):
    """Their letters and marks are known, so new words of a large table cost no call each."""
    mine, library = words
    letters = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c) not in "ªµº"]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    texts = ["".join(letters), *[f"q{c}Z{m}{m}' {c}" for c in letters for m in marks]]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    fresh = WordEndTokenizer(WORDS)
    monkeypatch.setattr(fresh, "_cut_words", lambda piece: pytest.fail(piece))
    assert [fresh.encode(text.encode()) for text in texts] == want


def test_encoders_over_a_table(spark, sf_dir, pieces, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(None, None), (None, ""), (-1, "a  b " * 30_000), (-1, "a  b " * 30_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    docs = docs.withColumn("n_tokens", F.lit("x")).withColumn("found", F.lit(1))
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]

    counts = token_counts.token_counts(docs, PIECES).collect()
    sizes = [len(pieces[1].encode(t)) for _, t in texts]
    want = [(i, len(t.encode()), n, n > 4096) for (i, t), n in zip(texts, sizes)]
    assert collections.Counter(map(tuple, counts)) == collections.Counter(want)

    want = []
    for i, text in texts:
        ids = words[1].encode(text, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        decoded = words[1].decode(ids, skip_special_tokens=False)
        want.append(
            (i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        )
    got = encoding.encoded(docs, WORDS, with_ids=False).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    ids = docs.select(encoding.token_ids(F.col("text"), WORDS).alias("ids"))
    back = ids.select("ids", encoding.decoded_text(F.col("ids"), WORDS).alias("text")).collect()
    assert all(r.text == words[1].decode(r.ids, skip_special_tokens=False) for r in back)


def test_token_columns_of_empty_tables_and_nulls(spark):
    frame = spark.createDataFrame([("a b",), (None,)], "text string")
    got = frame.select(
        token_counts.prefix_token_counts(F.col("text"), PIECES),
        token_counts.truncated_text(F.col("text"), PIECES, 1),
    ).collect()
    assert [tuple(r) for r in got] == [([0, 1, 2, 2], "a"), (None, None)]
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.token_counts(none, PIECES).collect() == []
    assert encoding.encoded(none, WORDS).collect() == []


# --- quality -------------------------------------------------------------------------


def plain_measures(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = collections.Counter(zip(found, found[1:], found[2:]))
    hit = {i + k for i in range(len(found) - 2) if runs[tuple(found[i : i + 3])] > 1 for k in range(3)}
    failed = len(found) < 50 or 100 * len(hit) > 50 * len(found)
    return (
        len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(hit), failed,
    )


def plain_verdict(text):
    """Base rules and bands, each chunk compressed by itself."""
    data = text.encode()

    def share(x):
        compressor = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
        return len(compressor.compress(x)) / len(x) if x else 1.0

    def normal(x, length):
        low, high = next((a, b) for n, a, b in quality.BANDS if n is None or length <= n)
        return low <= share(x) <= high

    size = quality.CHUNK_BYTES
    whole_chunks = [data[i : i + size] for i in range(0, len(data), size)]
    fine = normal(data, len(data)) and all(normal(c, size) for c in whole_chunks if len(c) == size)
    return fine and not plain_measures(text)[-1]


def test_quality_measures(spark, sf_dir):
    rng = random.Random(4)
    noise = "".join(chr(rng.randrange(33, 126)) + " " * (rng.random() < 0.2) for _ in range(9_000))
    odd = ["", " \n \t", "a b c", "x\x1cy z " * 60, "same words here " * 40, noise, "é日 " * 20_000]
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").unionByName(
        spark.createDataFrame([(t,) for t in odd] + [(None,), (odd[2],)], "text string")
    )
    frame = frame.withColumn("kept", F.lit(1)).withColumn("found", F.lit(2))
    got = frame.select("text", quality.quality_measures(F.col("text")).alias("m")).collect()
    for r in got:
        text = r.text or ""
        assert tuple(r.m)[:6] == plain_measures(text)
        assert r.m.kept == plain_verdict(text)
    verdicts = {r.text: r.m.kept for r in got}
    assert not verdicts[noise] and not verdicts[odd[4]] and not verdicts[None]
    kept = quality.keep_quality(frame)
    assert kept.columns == frame.columns
    assert sorted(r.text for r in kept.collect()) == sorted(t for t in (x.text for x in got if x.m.kept))
    assert quality.keep_quality(frame.limit(0)).collect() == []


def test_the_end_of_a_text_is_in_a_chunk(spark, sf_dir):
    rng = random.Random(9)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    size = quality.CHUNK_BYTES
    prose = "\n".join(t for t in texts if t and quality.measure(t.encode())["kept"]).encode()
    head = next(c for i in range(0, len(prose), size) if quality.measure(c := prose[i : i + size])["kept"])
    assert quality.measure(head)["n_words"] >= 50
    noise = base64.b64encode(rng.randbytes(3_000))
    short = [quality.measure(head + noise[:n]) for n in (0, 1, 4_000)]
    assert [m["kept"] for m in short] == [True, True, False]
    assert short[2]["largest_chunk_ratio"] == quality.compressed_share((head + noise)[-size:])
    same = quality.measure(head + b"a" * 4_000)
    assert not same["kept"] and same["least_chunk_ratio"] < 0.28
    # A text of a whole number of chunks has no chunk more.
    parts = [quality.compressed_share(x) for x in (head, noise + b" " * 96)]
    two = quality.measure(head + noise + b" " * 96)
    assert [two["least_chunk_ratio"], two["largest_chunk_ratio"]] == sorted(parts)


# --- main text -----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style>
<script>var t="</p>";</script></head><body class="has-sidebar"><header class="site"><h1>Site</h1></header>
<nav><ul><li><a href="/a">a</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now, it is good.</div>
<div id="cookie-notice"><p>We use cookies, a lot of them, so please accept all that we have.</p></div>
%s
<div id=comments><p>I think this is a great long comment by a reader about all of that.</p></div>
<form><p>Your name</p></form><aside><p>See also these other pages of ours, they are fine.</p></aside>
<footer>&copy; all of it</footer></body></html>"""
BODY = """<h1>Title &amp; co</h1><p><b>Bold&nbsp;&lt;start.<br><p>First   paragraph
 with a <a href=x>link</a> &eacute; in it, 1 < 2.</p><p>Short.</p><p>Last one, of some length as well.</p>"""
TEXT = "Title & co\nBold <start.\nFirst paragraph with a link é in it, 1 < 2.\nShort.\nLast one, of some length as well."


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>'])
def test_main_text(around):
    assert html_text.main_text(PAGE % (around % BODY)) == TEXT


@pytest.mark.parametrize(
    "around",
    [
        "<article class='post has-comments'>%s</article>",
        "<main class='no-sidebar'>%s</main>",
        "<main><article id=search-post>%s</article></main>",
        "<div class='layout with-sidebar'><article>%s</article></div>",
        "<div class='layout with-sidebar'><div>%s</div></div>",
        "<div class='social'><section class=widget><article class=promo>%s</article></section></div>",
        "<article>%s<div class=share>Share this page with all of your friends.</div></article>",
        "<article>%s<article class=comment><p>I think this is a comment.</p></article></article>",
        "<article>%s</article><div class=comments><article><p>I think this is a comment.</p></article></div>",
    ],
)
def test_names_alone_drop_no_article(around):
    assert html_text.main_text(PAGE % (around % BODY)) == TEXT


def test_hidden_elements_are_dropped_however_large():
    hidden = "<div hidden><p>" + "Some text that nobody sees. " * 40 + "</p></div>"
    assert html_text.main_text(PAGE % (f"<article>{BODY}</article>" + hidden)) == TEXT


def test_dive_points_end_the_text():
    links = "".join(f"<li><a href={i}>A link with a fairly long name {i}</a></li>" for i in range(9))
    article = "<p>One paragraph of text, long enough for a surge of its own, we hope.</p>" * 3
    found = html_text.main_text(f"<body><ul>{links}</ul><div>{article}</div><ul>{links}</ul></body>")
    assert found.count("\n") == 2 and "link" not in found


def test_surge_points_begin_the_text():
    short = "<p>Few words.</p>"
    link = "<p><a href=x>A link alone</a></p>"
    article = "<p>One paragraph of text, long enough for a surge of its own, we hope.</p>" * 3
    page = f"<body><div>{short}{link * 3}</div><div>%s</div><div>{link * 3}{short}</div></body>"
    assert html_text.main_text(page % article) == "\n".join(re.findall(r"<p>(.*?)</p>", article))
    marked = html_text.main_text(page % f"<article>{short}{link * 3}{article}{link * 3}{short}</article>")
    assert marked.count("Few words.") == 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-ap \"'=&;b\nstyle", max_size=200))
def test_any_markup_is_read(page):
    assert isinstance(html_text.main_text(page), str)


def test_pages_table(spark, sf_dir):
    schema = "page_id bigint, url string, html string"
    odd = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "v", "<p>" + "word " * 200_000), (3, "w", "<!-- " * 9)]
    pages = spark.createDataFrame(odd, schema).withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(0))
    got = sorted(map(tuple, html_text.extract_pages(pages).collect()), key=str)
    long = ("word " * 200_000).strip()
    want = [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, "v", long, len(long)), (3, "w", "", 0)]
    assert got == sorted(want, key=str)
    real = html_text.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    assert all(r.n_chars == len(r.text) > 0 and "{" not in r.text for r in real)
    assert html_text.extract_pages(pages.limit(0)).collect() == []


def test_cuts_come_from_the_stored_prefix_counts(spark, pieces):
    """The longest prefix within a budget, found by encoding every prefix."""
    mine, library = pieces
    rng = random.Random(4)
    parts = ["the", "a", "  ", "   ", " ", "\n", "é", "日本", "x1", "hello", "ing", "\n\n", "▁", "😀", "Wor", "ld"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))
        sizes = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        for budget in (0, 1, 3, 8):
            within = max(k for k, n in enumerate(sizes) if n <= budget)
            assert mine.measure(text.encode(), budget) == (sizes[-1], within)
        rows.append((i, text, sizes[-1] > 4, max(k for k, n in enumerate(sizes) if n <= 4)))
    docs = spark.createDataFrame([*rows, (-1, None, False, 0)], "doc_id int, text string, over boolean, cut long")
    found = token_counts.token_counts(docs, PIECES, limit=4, with_cut=True).collect()
    assert {r.doc_id: (r.over_limit, r.n_chars_within) for r in found} == {r.doc_id: (r.over, r.cut) for r in docs.collect()}


SENTENCES = ["Sentence number %d of the article, with enough words in it." % i for i in range(12)]


def test_names_of_other_things_drop_no_text():
    article = "".join(
        f"<{tag}>{x}</{tag.split()[0]}>"
        for x, tag in zip(SENTENCES, ["p", "p class='share-price'", "section id='search-for-life'", "p class='no-comment-today'"] * 3)
    )
    page = f"<body><nav>menu</nav><article>{article}<div class='share-buttons'>Share this</div></article></body>"
    assert html_text.main_text(page) == "\n".join(SENTENCES)
    assert html_text.main_text("<article><p>Let <math><mi>x</mi></math> be one.</p></article>") == "Let x be one."


def test_comments_are_no_article_however_many():
    text = "".join(f"<p>{x}</p>" for x in SENTENCES[:4])
    comments = "".join(f"<p>Reader {i} says a sentence of about this length here.</p>" for i in range(60))
    for name in ("comments", "comment-list", "replies"):
        page = f"<body><div class='page'>{text}<div class='{name}'>{comments}</div></div></body>"
        assert html_text.main_text(page) == "\n".join(SENTENCES[:4])


def test_deep_and_unbalanced_markup_takes_linear_time():
    deep = "<div class='widget'>" * 10_000 + f"<p>{SENTENCES[0]}</p>" + "</div>" * 10_000
    open_ends = "<div>" * 10_000 + "</span>" * 50_000 + f"<article><p>{SENTENCES[0]}</p></article>"
    articles = "<article class='comment'>" * 10_000 + SENTENCES[0]
    for page in (deep, open_ends, articles):
        start = time.process_time()
        assert html_text.main_text(page) == SENTENCES[0]
        assert time.process_time() - start < 2


def test_surges_and_dives_of_pages_without_article_tags(spark, sf_dir):
    """The table's pages with article and main as plain elements: lines by the sums alone."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    for page in pages[:100]:
        plain = re.sub(r"<(/?)(article|main)\b[^>]*>", r"<\1div>", page.html or "")
        lines = html_text.page_lines(plain)
        weights = [
            0 if x.boilerplate or 2 * x.link_chars > len(x.text)
            else max(1, len(x.text) // 2) if x.named else len(x.text)
            for x in lines
        ]
        sums = [sum(weights[i : i + 3]) for i in range(len(lines))]
        enough = min(80, max(sums, default=0) / 2)
        begins = [i for i, total in enumerate(sums) if weights[i] and total >= enough]
        # A line stays if a surge is before it, or at it, and no dive between.
        kept = [
            x.text
            for i, x in enumerate(lines)
            if not x.boilerplate and any(b <= i and all(sums[b : i + 1]) for b in begins)
        ]
        assert html_text.main_text(plain) == "\n".join(kept)
