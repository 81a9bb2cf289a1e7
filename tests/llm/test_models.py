"""Quality, toxicity, decontamination and HTML extraction: held-out accuracy and brute force."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, html_extract, quality, toxicity
from orderlens.llm.html_nodes import Page
from tests.conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def table(spark, name, sf=SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def labels(spark, rows, what):
    return spark.createDataFrame(rows, f"doc_id long, {what} int")


# --- quality -------------------------------------------------------------------------------


def test_quality_separates_the_labels(spark):
    judged = quality.judged(table(spark, "documents", MEDIUM), table(spark, "labels", MEDIUM))
    rows = judged.join(table(spark, "labels", MEDIUM), "doc_id").collect()
    assert judged.count() == table(spark, "documents", MEDIUM).count()
    good = [r.accepted for r in rows if r.quality == 1]
    bad = [r.accepted for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


N = quality.ORDER


def kneser_ney(texts):
    """Log probability per symbol by the textbook, over dictionaries, of streams of symbols."""

    def grams(text):
        s = "\x02" * (N - 1) + text + "\x03" if text else ""
        for k in range(N - 1, len(s)):
            yield s[k - N + 1 : k + 1]

    tables = {N: Counter(g for t in texts for g in grams(t))}
    for k in range(N - 1, 0, -1):
        low = defaultdict(int)
        for g, n in tables[k + 1].items():
            low[g[1:]] += n if g[1] == "\x02" else 1
        tables[k] = dict(low)
    discounts = {}
    for k, t in tables.items():
        n = [sum(v == i for v in t.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else None
        d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[1] + n[2] else i / 2 for i in (1, 2, 3)]
        discounts[k] = [max(0.1, min(i - 0.1, x)) for i, x in zip((1, 2, 3), d)]
    contexts = {k: defaultdict(lambda: [0, 0.0]) for k in tables}
    for k, t in tables.items():
        for g, n in t.items():
            c = contexts[k][g[:-1]]
            c[0] += n
            c[1] += discounts[k][min(n, 3) - 1]
    seen = len(tables[1])

    def chance(g):
        p = 1.0 / (seen + 1)
        for k in range(1, N + 1):
            own = g[N - k :]
            total, left = contexts[k].get(own[:-1], (0, 0.0))
            if total:
                n = tables[k].get(own, 0)
                p = (n - discounts[k][min(n, 3) - 1] if n else 0) / total + left / total * p
        return p

    def rate(text):
        logs = [math.log(chance(g)) for g in grams(text)]
        return -sum(logs) / len(logs) if logs else None

    return rate


def stream(text):
    """The symbols of a text but the last end mark."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    again = [k > 0 and w[k] == w[k - 1] for k in range(len(w))]
    marks = [x if not again[k] else "\x05" if again[k - 1] else "\x01" for k, x in enumerate(w)]
    return "\x03".join(marks)


@pytest.mark.parametrize("block_bytes", [20_000, 16_000_000])
def test_quality_equals_the_textbook(spark, block_bytes):
    docs, known = table(spark, "documents"), table(spark, "labels")
    teachers = quality.trusted(known).where(~quality.held_out(F.col("doc_id"))).select("doc_id")
    rate = kneser_ney([stream(r.text) for r in docs.join(teachers, "doc_id").select("text").collect()])
    scored = quality.perplexities(docs, known, block_bytes=block_bytes).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(scored) == len(texts)
    for r in scored[::7]:
        assert r.log_perplexity == pytest.approx(rate(stream(texts[r.doc_id])), rel=1e-3)


def test_symbols_of_awkward_texts():
    texts = ["", "a a a a b", "\x01 \x03x \x01", " \t ", "\u65e5\u672c \u65e5\u672c \u65e5\u672c e\u0301", "", "a"]
    found = quality.Text(pa.array(texts, pa.large_string()))
    counted, sizes = Counter(), []
    for text in texts:
        w = [re.sub("[\x01-\x06]", "\x06", x) for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
        again = [k > 0 and w[k] == w[k - 1] for k in range(len(w))]
        marks = [x if not again[k] else "\x05" if again[k - 1] else "\x01" for k, x in enumerate(w)]
        s = "\x02" * (N - 1) + "".join(x + "\x03" for x in marks)
        sizes.append(len(s) - N + 1)
        counted.update(s[k - N + 1 : k + 1] for k in range(N - 1, len(s)))
    assert dict(zip(found.strings().tolist(), found.counts().tolist())) == dict(counted)
    assert found.size.tolist() == sizes


def test_an_unseen_symbol_after_a_start_is_as_unlikely_as_it_is(spark, documents):
    rows = [(k, "abc abd abe") for k in range(20)] + [(100, "\u00e9\u00e8\u00ea")]
    known = labels(spark, [(k, 1) for k in range(20)], "quality")
    teachers = [r.doc_id for r in known.where(~quality.held_out(F.col("doc_id"))).collect()]
    rate = kneser_ney([stream(rows[0][1])] * len(teachers))
    found = {r.doc_id: r for r in quality.perplexities(documents(rows), known).collect()}
    assert found[100].log_perplexity == pytest.approx(rate(stream(rows[-1][1])), rel=1e-3)


def test_usual_words_in_the_wrong_order_are_less_likely(spark, documents):
    words = [f"{'abcdefgh'[k % 8]}{'xyz'[k % 3]}" for k in range(24)]
    turned = " ".join(words[::-1])
    rows = [(k, " ".join(words)) for k in range(20)] + [(100, turned)]
    known = labels(spark, [(k, 1) for k in range(20)], "quality")
    found = {r.doc_id: r for r in quality.judged(documents(rows), known).collect()}
    assert found[100].log_perplexity > 3 * found[0].log_perplexity
    assert found[0].accepted and not found[100].accepted


def test_quality_of_awkward_rows(spark, documents, awkward):
    known = labels(spark, [(5, 1), (5, None), (7, 1), (8, 1), (8, 0), (None, 1), (99, 1)], "quality")
    docs = documents(awkward).drop("n_chars").withColumnRenamed("source", "symbols_of")
    rows = quality.judged(docs, known).collect()
    assert len(rows) == len(awkward)
    assert all(r.accepted for r in rows if not (dict(awkward)[r.doc_id] or "").strip())
    assert all((r.log_perplexity is None) == (r.symbols == 0) for r in rows)


def test_quality_without_teachers_or_documents(spark, documents):
    none = labels(spark, [], "quality")
    assert [r.accepted for r in quality.judged(documents([(1, "a b"), (2, None)]), none).collect()] == [True, True]
    assert quality.judged(documents([]), none).count() == 0


def test_bad_documents_of_a_small_table_go(spark):
    docs, known = table(spark, "documents"), table(spark, "labels")
    rows = quality.judged(docs, known).join(known, "doc_id").collect()
    assert all(r.threshold is not None for r in rows)  # fr and es have no held-out teachers
    assert all(r.accepted for r in rows if r.quality == 1)
    assert sum(r.accepted for r in rows if r.quality == 0) <= 1


def test_unlabelled_and_null_languages_are_judged(spark):
    docs, known = table(spark, "documents"), table(spark, "labels")
    bad = [r.doc_id for r in known.where("quality = 0").collect()]
    odd = F.when(F.col("doc_id").isin(bad[::2]), F.lit(None)).when(F.col("doc_id").isin(bad[1::2]), F.lit("xx"))
    lang = F.when(F.col("doc_id").isin(bad), odd).otherwise(F.col("lang"))
    rows = quality.judged(docs.withColumn("lang", lang), known).where(F.col("doc_id").isin(bad)).collect()
    assert len(rows) == len(bad) and sum(r.accepted for r in rows) <= 1


# --- toxicity ------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.1")
    known = table(spark, "labels", "/root/testdata/sf0.1")
    rows = toxicity.classify(docs, known).join(known, "doc_id").where("held_out").collect()
    toxic = np.array([r.score for r in rows if r.toxic == 1])
    clean = np.array([r.score for r in rows if r.toxic == 0])
    assert np.mean(toxic[:, None] > clean[None, :]) > 0.95


def test_toxicity_never_learns_from_held_out_rows(spark, documents):
    import zlib

    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    docs = documents([(k, "bad word" if k % 2 else "fine thing") for k in ids])
    rows = toxicity.classify(docs, labels(spark, [(k, k % 2) for k in ids], "toxic")).collect()
    assert all(r.held_out and r.score == 0.5 for r in rows)


def test_toxicity_of_awkward_rows(spark, documents, awkward):
    known = labels(spark, [(5, 1), (5, 0), (7, None), (None, 1), (8, 0)], "toxic")
    rows = toxicity.classify(documents(awkward, clash=("label", "turn", "score", "places")), known).collect()
    assert len(rows) == len(awkward)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert toxicity.classify(documents([]), known).count() == 0


def test_features_equal_sets_of_pairs():
    begins, hashes = toxicity.bare_words(pa.array(["A, b c! --", "a b", ""], pa.large_string()))
    assert np.diff(begins).tolist() == [3, 2, 0]
    doc, place = toxicity.features(pa.array(["A, b c! --", "a b", "", "a a a a"], pa.large_string()))
    # words; neighbours; one between; two between
    assert np.bincount(doc, minlength=4).tolist() == [3 + 2 + 1, 2 + 1, 0, 1 + 1 + 1 + 1]


# --- decontamination -----------------------------------------------------------------------


def align(left, right):
    best = 0
    h = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            points = decontaminate.MATCH if a == b else decontaminate.MISMATCH
            h[i + 1][j + 1] = max(
                0, h[i][j] + points, h[i][j + 1] + decontaminate.GAP, h[i + 1][j] + decontaminate.GAP
            )
            best = max(best, h[i + 1][j + 1])
    return best


def test_alignment_equals_the_textbook():
    rng = np.random.default_rng(3)
    left = [rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(60)]
    right = [rng.integers(1, 6, rng.integers(1, 15)).astype(np.uint64) for _ in range(60)]
    points, _ = decontaminate.smith_waterman(decontaminate._padded(left), decontaminate._padded(right))
    assert points.tolist() == [align(a.tolist(), b.tolist()) for a, b in zip(left, right)]


def plain(text):
    return [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", x.lower()) for x in (text or "").split()) if w]


def test_every_whole_copy_is_found(spark):
    docs, items = table(spark, "documents", MEDIUM), table(spark, "benchmark", MEDIUM)
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find(docs, items).collect()}
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    wanted = {r.item_id: plain(r.text) for r in items.collect()}
    copies = {
        (d, i) for d, t in texts.items() for i, w in wanted.items() if f" {' '.join(w)} " in f" {' '.join(t)} "
    }
    assert copies and copies <= set(found)
    for (d, i), r in found.items():
        assert r.score == pytest.approx(align(texts[d], wanted[i]) / (2 * len(wanted[i])))
        assert 0 <= r.begin < r.end <= len(texts[d])
    left = {r.doc_id for r in decontaminate.clean(docs, items).select("doc_id").collect()}
    assert left == set(texts) - {d for d, _ in found}


def test_edited_copies_are_found(spark, documents):
    item = [f"w{k}" for k in range(40)]
    edited = [("x" + w if k % 7 == 3 else w) for k, w in enumerate(item)]
    gappy = [w for k, w in enumerate(item) if k % 9 != 4]
    noise = [f"n{k}" for k in range(300)]
    rows = [
        (1, " ".join(noise + edited + noise)), (2, " ".join(noise[:50] + gappy)), (3, " ".join(noise)),
        (4, " ".join(item[:8] + noise)), (5, None), (6, ""), (None, " ".join(item)),
    ]
    items = spark.createDataFrame(
        [(9, " ".join(item)), (8, "w1 w2"), (7, None), (6, "")], "item_id long, text string"
    )
    docs = documents(rows, clash=("score", "item_id", "begin"))
    found = {(r.doc_id, r.item_id): (r.begin, r.end) for r in decontaminate.find(docs, items).collect()}
    assert found == {(1, 9): (300, 340), (2, 9): (50, 50 + len(gappy)), (None, 9): (0, 40)}
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {3, 4, 5, 6}


def test_an_item_copied_everywhere_is_found(spark, documents, monkeypatch):
    item = " ".join(f"w{k}" for k in range(20))
    docs = documents([(k, f"a{k} b{k} {item} c{k}") for k in range(50)])
    items = spark.createDataFrame([(1, item), (2, item), (None, item)], "item_id long, text string")
    assert decontaminate.find(docs, items).count() == 150
    monkeypatch.setattr(decontaminate, "AT_ONCE", 30)  # as many parts as items
    assert decontaminate.find(docs, items).count() == 150
    assert decontaminate.clean(docs, items).count() == 0


def test_decontamination_of_nothing(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(documents([(1, "a b c d")]), none).count() == 0
    assert decontaminate.clean(documents([(1, "a b c d")]), none).count() == 1
    one = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontaminate.find(documents([]), one).count() == 0


# --- HTML ----------------------------------------------------------------------------------


def article_of(html):
    """The text blocks of the test pages' article, by their own simple markup."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|h2|ul|li|div|table|tr|td|blockquote|pre)[^>]*>", inner)
    import html as h

    blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_the_test_pages(spark):
    pages = table(spark, "pages", MEDIUM)
    want = {r.page_id: article_of(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    assert got.keys() == want.keys()
    assert np.mean([got[k].text == want[k] for k in want]) > 0.99
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_unseen_boilerplate_goes(spark):
    forest = html_extract.train(table(spark, "pages", MEDIUM))
    body = "".join(f"<p>This is paragraph {k}, with some words, and an end.</p>" for k in range(6))
    extra = (
        '<aside><h3>More</h3><p>Some side words here.</p></aside><form><p>Your mail, please.</p><input>'
        '<button>Send</button></form><div class="comments"><p>I like it, really.</p></div>'
        '<div id="cookieNotice">We use cookies, as all do.</div><div class="sponsored">Buy this.</div>'
    )
    page = (
        "<html><head><title>T</title><script>x='<p>'</script></head><body><header><p>The Daily Site, since 1900.</p>"
        f"</header><nav><a href=/>Home</a></nav><article><h1>Title &amp; more</h1>{body}{extra}</article>{extra}"
        "<footer><p>All rights, reserved.</p></footer></body></html>"
    )
    text = html_extract.main_text(page, forest)
    assert text.split("\n\n") == ["Title & more"] + [
        f"This is paragraph {k}, with some words, and an end." for k in range(6)
    ]
    other = page.replace("<article>", '<div class="post-content">').replace("</article>", "</div>")
    assert html_extract.main_text(other, forest) == text


def test_decoding_never_contradicts_itself():
    page = Page("<body><div><p>a</p><p>b</p></div><nav><p>c</p></nav></body>")
    rng = np.random.default_rng(5)
    for _ in range(200):
        chance = rng.random(len(page.tags))
        kept = html_extract.decode(page, chance)
        assert all(kept[page.parents[k]] or not kept[k] for k in range(1, len(kept)))
        best = -np.inf
        for bits in range(2 ** (len(kept) - 1)):
            y = np.array([True] + [bool(bits >> k & 1) for k in range(len(kept) - 1)])
            if all(y[page.parents[k]] or not y[k] for k in range(1, len(y))):
                best = max(best, np.log(np.where(y, chance, 1 - chance)).sum())
        assert np.log(np.where(kept, chance, 1 - chance)).sum() == pytest.approx(best)


def test_awkward_pages(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (3, None, "no markup at all"), (4, "u", "<p>a<p>b"), (None, "u", "<article><p>x"),
        (5, "u", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", "</p></article><b>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_extract.extract(pages).count() == len(rows)
    assert html_extract.extract(pages.limit(0)).count() == 0
    assert [r.text for r in html_extract.extract(pages.limit(2)).collect()] == ["", ""]


def text_of(html):
    return [text for _, text, _ in Page(html).blocks]


def test_unclosed_heads_and_silent_elements_end():
    assert text_of("<head><title>T</title><article><p>x</p></article>") == ["x"]
    assert text_of("<head><meta charset=u><style>a</style>words<p>x") == ["words", "x"]
    for tag in ("object", "video", "audio", "svg", "canvas", "iframe"):
        assert text_of(f"<body><div><{tag}><b>hid</b></div><p>x</p></body>") == ["x"]
    assert text_of("<p>so <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so a=2 holds"]


def test_pages_in_other_words_are_not_emptied(spark):
    html = "<body><nav><a href=/>Home</a></nav><div class=inhalt><p>Ein Satz.</p></div></body>"
    pages = spark.createDataFrame([(k, "u", html) for k in range(5)], "page_id long, url string, html string")
    assert {r.text for r in html_extract.extract(pages).collect()} == {"Ein Satz."}
    assert html_extract.main_text("no markup at all", None) == "no markup at all"


def test_few_marked_pages_among_many_teach(spark):
    rows = [(k, "u", "<body><div class=inhalt><p>Ein Satz.</p></div></body>") for k in range(60)]
    rows.append((99, "u", "<body><nav><p>Home</p></nav><article><p>One, two.</p></article></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r[0] for r in html_extract.lessons(pages, 4).select("label").distinct().collect()} == {0, 1}


def test_broadcasts_hold_plain_values():
    """Workers without this package can read them: nothing is pickled by reference to it."""
    import pickle

    from orderlens.llm.decontaminate import Items
    from orderlens.llm.html_extract import Forest

    items = Items([1, 2], [np.arange(9, dtype=np.uint64), np.arange(4, dtype=np.uint64)])
    forest = Forest([tuple(np.zeros(3, kind) for kind in (int, float, int, int, float))], [1.0])
    for broadcast in (vars(items), vars(forest)):
        assert b"orderlens" not in pickle.dumps(broadcast)
    again = Items.of(pickle.loads(pickle.dumps(vars(items))))
    assert (again.distinct() == items.distinct()).all() and again.ids == items.ids
    assert (Forest(**vars(forest)).chance(np.zeros((2, 3))) == forest.chance(np.zeros((2, 3)))).all()
