import datetime as dt
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from strataflow.llm import html_text, packing, token_lengths, url_lists
from strataflow.llm.common import table
from strataflow.llm.queries import QUERIES
from tests.conftest import SF, rows

ODD = [None, "", " ", "a<|endoftext|>b", "é ß \U0001f600\U0001f468‍\U0001f469", "x" * 9000, "1234567890 " * 50, "\r\n\t\v", "don't I'LL"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizers_file(spark, tokenizer):
    encode = packing.encoder()
    texts = ODD + [r.text for r in table(spark, SF, "documents").limit(100).collect()]
    for t in texts:
        assert encode(t or "") == plain_ids(tokenizer, t)


@pytest.mark.parametrize("white", [" ", "\n", "\t", "\u3000", " \n\t", "\r\n "])
def test_long_white_space_is_encoded(spark, tokenizer, documents, white):
    n = 2_000_000 if len(white) == 1 and white != "\u3000" else 300_000
    texts = [f"a b{white * n}c", white * n, f"x{white * 50_000}"]
    pieces = packing.packed(documents(*enumerate(texts))).collect()
    for i, text in enumerate(texts):
        parts = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in parts])
        assert ids.tolist() == [*plain_ids(tokenizer, text), 0]
    counted = token_lengths.length_histogram(documents(*enumerate(texts))).agg({"n_docs": "sum"}).first()[0]
    assert counted == 3


def check_sequences(pieces, limits):
    by = {}
    for p in sorted(pieces, key=lambda p: p.offset):
        end = by.setdefault(p.sequence_id, [0, 0, 0])
        assert p.offset == end[0] and p.length > 0
        end[0] += p.length
        end[1] += 1
        end[2] += p.loss_tokens
    assert all(t <= limits.tokens and s <= limits.segments and loss <= limits.loss_tokens for t, s, loss in by.values())
    return [t for t, _, _ in by.values()]


def test_every_id_is_in_exactly_one_piece(spark, tokenizer, documents):
    draw = random.Random(0)
    texts = ODD + ["word " * draw.randrange(2500) for _ in range(60)]
    docs = documents(*enumerate(texts), (0, "again"), (None, "no id")).repartition(2)
    pieces = packing.packed(docs).collect()
    check_sequences(pieces, packing.Limits())
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for i, t in enumerate(texts):
        ids = [*plain_ids(tokenizer, t), 0]
        parts = whole[i, len(ids)]
        assert [x for p in parts for x in np.frombuffer(p.ids, "<u4")] == ids
        assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts[:-1]]]))
    assert packing.packed(docs.limit(0)).count() == 0


def test_query_digests_and_padding(spark, tokenizer):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    pieces = QUERIES["op6_vector_packing"](spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(docs)
    for p in pieces:
        ids = np.array([*plain_ids(tokenizer, docs[p.doc_id]), 0], "<u4")
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
    total = Counter()
    for p in pieces:
        total[p.sequence_id] += p.length
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in total.values())
    assert padding < 0.02 * sum(total.values())


def test_limits_on_segments_and_loss_hold_for_instructions(spark):
    draw = random.Random(3)
    data = [(i, "ask " * draw.randrange(200), "answer " * draw.randrange(1, 300)) for i in range(300)]
    df = spark.createDataFrame([*data, (900, None, "x"), (901, "p " * 3000, None)], "doc_id LONG, prompt STRING, text STRING")
    limits = packing.Limits(tokens=1024, segments=5, loss_tokens=400)
    pieces = packing.packed(df, limits, prompt="prompt").collect()
    sizes = check_sequences(pieces, limits)
    loss = Counter()
    for p in pieces:
        loss[p.doc_id] += p.loss_tokens
    encode = packing.encoder()
    assert all(loss[i] == len(encode(t)) + 1 for i, _, t in data) and loss[901] == 1
    assert np.mean(sizes) > 450


def plain_sums(lengths, limit):
    return sum(n >= limit for n in lengths), sum(n for n in lengths if n >= limit), sum(min(n, limit) for n in lengths)


def test_histogram_answers_every_limit(spark, tokenizer, documents):
    draw = random.Random(1)
    texts = ODD + ["word " * draw.choice([3, 7, 1200, draw.randrange(3000)]) for _ in range(80)]
    docs = documents(*enumerate(texts), (0, "again and again")).repartition(3)
    lengths = [len(plain_ids(tokenizer, t)) for t in [*texts, "again and again"]]
    sums = token_lengths.with_suffix_sums(token_lengths.length_histogram(docs))
    got = {r.length: r for r in sums.collect()}
    assert {n: r.n_docs for n, r in got.items()} == Counter(lengths)
    for n, r in got.items():
        assert (r.docs_from, r.tokens_from, r.truncated_tokens) == plain_sums(lengths, n)
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    limits = [0, 1, 5, 100, 1024, 2047, max(lengths), 10**6]
    asked = {r.limit: tuple(r)[1:] for r in token_lengths.at_limits(sums, limits).collect()}
    assert asked == {n: plain_sums(lengths, n) for n in limits}
    median = token_lengths.length_quantiles(sums, [0.5, 1.0]).first()
    assert tuple(median) == (sorted(lengths)[(len(lengths) - 1) // 2], max(lengths))
    assert token_lengths.with_suffix_sums(token_lengths.length_histogram(docs.limit(0))).count() == 0


# ---- pages ----


def marked_article(source):
    inside = re.search(r"(?s)<article>(.*?)(?:</article>|<footer>|\Z)", source)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_pages_give_their_article(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    out = QUERIES["op8_html_text"](spark, SF).collect()
    assert {r.page_id for r in out} == set(pages)
    assert all(r.text == marked_article(pages[r.page_id].html) and r.n_chars == len(r.text) for r in out)


PAGE = (
    "<html><head><title>t</title></head><body><div id='header'><a href=x>Home</a> <a>About us</a></div>"
    "<div class='cookie-notice'>We use cookies to make it work well for all of you today and tomorrow.</div>"
    "<div class='content'><h2>Title here</h2><p>Some <b>bold</b> text &amp; more words in this long paragraph."
    "<div class=ad>Buy now this thing</div><p>Second&nbsp;paragraph   has a few\nmore words, too.</p>"
    "<form><label>Name</label><input name=a>send</form><p>1 &lt; 2</p></div>"
    "<div id=comments><p>I like it a lot said a reader here today and went on at length</p></div><footer>c 2020</footer>"
)


def test_pages_without_marks_and_edge_pages(spark):
    cases = [PAGE, None, "", "   ", "<p>", "<" * 5000, "<div>" * 20_000 + "deep words here", "plain text only"]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate([*cases, PAGE])], "page_id LONG, url STRING, html STRING")
    learned = html_text.learned_scores(table(spark, SF, "pages"))
    for scores in (learned, {}):
        out = {r.page_id: r.text for r in html_text.main_texts(df, scores).collect()}
        assert out[0] == out[8] == (
            "Title here\nSome bold text & more words in this long paragraph.\n"
            "Second paragraph has a few more words, too.\n1 < 2"
        )
        assert [out[i] for i in (1, 2, 3, 4)] == [""] * 4 and out[6] == "deep words here" and out[7] == "plain text only"
    assert html_text.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "before",
    [
        "<html><head><title>x</title><body><article>",
        "<head><title>x</title><meta charset=utf8><div>",
        "<head>\n<!-- <body> --><script>a = '</head>'</script><style>p{}</style></head><body>",
        "<head><script>x</head><body>",
        "<head><title>x</head><body>",
        "<header>x</header>",
        "<body><svg width='1' viewBox=\"0 0 1 1\"/>",
        "<body><svg/><svg><text>x</text></svg><svg a=b/><text>x</text></svg>",
    ],
)
def test_open_heads_and_closed_drawings_swallow_nothing(before):
    text = "word " * 49 + "word"
    assert html_text.Page(f"{before}<p>{text}</p>").main_text() == text


LONG = "words of the article that go on for a while and say something " * 3


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("alpha<br>beta gamma", "alpha beta gamma"),
        ("alpha<br/>beta<BR />\n gamma", "alpha beta gamma"),
        ("alpha<img src=x>beta", "alpha beta"),
        ("alpha<wbr>beta <b>ga</b>mma", "alphabeta gamma"),
        ("<br>alpha<br>", "alpha"),
        ("alpha<hr>beta comes after a line", "alpha\nbeta comes after a line"),
    ],
)
def test_what_stands_between_words(inner, text):
    found = html_text.Page(f"<article><p>{LONG}</p><p>{inner}</p></article>").main_text()
    assert found == f"{LONG.strip()}\n{text}"


@pytest.mark.parametrize("name", ["share-price", "notice-board", "menu-of-the-day", "search_history", "side-effects"])
def test_a_word_in_a_class_name_drops_no_paragraph(name):
    for mark in ("class", "id"):
        page = f"<body><nav><a>x</a></nav><article><p>{LONG}</p><div {mark}='{name}'><p>It rose by a third.</p></div><p>{LONG}</p></article>"
        assert html_text.Page(page).main_text() == f"{LONG.strip()}\nIt rose by a third.\n{LONG.strip()}"


def test_side_matter_is_learned_from_labelled_pages(spark):
    words = "one two three four five six " * 12
    page = "<body><div class=zq>{0}</div><article><p>{0}</p><div class='notice'><p>{0}</p></div></article><div class=zq>{0}</div>"
    pages = spark.createDataFrame([(i, "u", page.format(words)) for i in range(40)], "page_id LONG, url STRING, html STRING")
    scores = html_text.learned_scores(pages)
    assert scores["name zq"] <= html_text.SIDE_NAME < 0 < scores["name notice"]
    text = words.strip()
    bare = f"<div class=x><p>{words}</p><div class=zq>{words}</div><p class=notice>{words}</p></div>"
    assert html_text.Page(bare, scores).main_text() == f"{text}\n{text}"
    assert html_text.Page(bare).main_text() == f"{text}\n{text}"
    assert html_text.Page(bare, {"name notice": 1.0}).main_text() == f"{text}\n{text}\n{text}"


def test_the_run_is_the_best_of_all_runs():
    draw = random.Random(8)
    scores = {"<div>": -3.0, "</div>": -1.5, "word in div": 1.0, "word in side": -1.0, "<nav>": -2.0, "</nav>": -0.5}
    for _ in range(60):
        source = "".join(draw.choice(["<div>", "</div>", "<nav>", "</nav>", "w ", "w w w "]) for _ in range(25))
        page = html_text.Page(source)
        values = [c * (scores.get(k) or html_text.prior(k)) for k, c in zip(page.kinds, page.counts, strict=True)]
        best = max((sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=0)
        start, end = page.run(scores)
        assert sum(values[start:end]) == pytest.approx(max(best, 0.0))


# ---- lists of addresses ----

US = 1_000_000


def test_lists_as_they_stood(spark):
    day = 86_400 * US
    entries = [
        ("spam", "host", "a.example.com", 10 * day, 1, True),
        ("spam", "host", "a.example.com", 20 * day, 2, False),
        ("spam", "host", "a.example.com", 20 * day, 1, True),
        ("adult", "domain", "example.com", 15 * day, 1, True),
        ("spam", "prefix", "b.org/bad", 5 * day, None, True),
        ("spam", "host", None, 5 * day, 1, True),
        ("spam", "host", "b.org", None, 1, True),
    ]
    schema = "list STRING, scope STRING, pattern STRING, at LONG, seq LONG, listed BOOLEAN"
    urls = ["http://A.example.com/x", "https://www.example.com", "http://b.org/bad/page?q", "http://b.org/badly", "nonsense", None, ""]
    captures = [(u, t * day + off, 1, "c") for u in urls for t in (4, 5, 10, 15, 19, 20, 30) for off in (0, 7)]
    captures += captures[:5] + [("http://b.org/bad", None, 1, "c")]
    df = spark.createDataFrame(captures, "url STRING, fetched_at LONG, page_id LONG, lists STRING")
    out = url_lists.captures_on_lists(df, spark.createDataFrame(entries, schema))

    def expected(url, at):
        if not url or at is None or "//" not in url:
            return ""
        found = set()
        if "a.example.com" in url.lower() and 10 * day <= at < 20 * day:
            found.add("spam")
        if "example.com" in url.lower() and at >= 15 * day:
            found.add("adult")
        if url.startswith("http://b.org/bad/") and at >= 5 * day:
            found.add("spam")
        return ",".join(sorted(found))

    got = rows(out, "url", "fetched_at", "lists", "blocked")
    assert got == sorted([(u, t, e := expected(u, t), e != "") for u, t, _, _ in captures], key=repr)
    named = df.selectExpr("*", "1 AS _lists", "2 AS blocked", "3 AS _LISTS_")
    again = url_lists.captures_on_lists(named, spark.createDataFrame(entries, schema))
    assert rows(again, "url", "fetched_at", "lists", "blocked") == got and again.where("_lists = 1 AND _LISTS_ = 3").count() == len(captures)
    nothing = spark.createDataFrame([], schema)
    assert url_lists.captures_on_lists(df, nothing).where("blocked").isEmpty()
    assert url_lists.captures_on_lists(df.limit(0), spark.createDataFrame(entries, schema)).count() == 0


# ---- the pipeline ----


def test_stages_hand_on_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    counts = [docs.count()]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns
        assert after.exceptAll(before).isEmpty(), name
        counts.append(after.count())
        before = after
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]
    assert rows(corpus_pipeline.run(spark, SF).groupBy("doc_id").sum("length")) == rows(packed.groupBy("doc_id").sum("length"))
    good = labels.where("quality = 1 AND toxic = 0").join(docs, "doc_id")
    assert good.count() > 0 and dt.date.today()
