"""Importance resampling, toxicity and HTML extraction."""

import random
import time

import numpy as np
from fixture_texts import words

from vejrkraft.llm import html_text, importance, toxicity

SCHEMA = "doc_id long, text string, label int, score double, bucket int"


def _corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, quality = [], {}
    for i in range(n):
        own = words(rng.randrange(5, 120), i)
        bad = i % 5 == 0
        docs.append((i, " ".join(w.upper() + "!!" if bad else w for w in own)))
        quality[i] = int(not bad)
    return docs, quality


def _df(spark, rows):
    return spark.createDataFrame([(i, t, 1, 0.5, 1) for i, t in rows], SCHEMA)


def test_bad_documents_go_and_clean_ones_stay(spark):
    docs, quality = _corpus()
    docs += [(900, None), (901, ""), (902, " \n"), (None, docs[1][1]), docs[1], docs[1]]
    known = [(i, q, 0) for i, q in quality.items() if i % 2] + [(i, q, 0) for i, q in quality.items() if i % 10 == 0]
    known += [(None, 1, 0), (3, None, 0), (4, 7, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, text int")
    df = _df(spark, docs)
    run = lambda: importance.importance_resample(df, labels).collect()
    got = run()
    assert len(got) == len(docs) and sorted(map(repr, got)) == sorted(map(repr, run()))
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[i] for i in (900, 901, 902))
    wrong = [i for i, q in quality.items() if kept[i] != bool(q)]
    assert len(wrong) <= 4, wrong
    # The same rows, whole, from the filter.
    stay = importance.select_documents(df, labels)
    assert stay.columns == df.columns
    assert sorted(map(repr, (r["doc_id"] for r in stay.collect()))) == sorted(repr(r["doc_id"]) for r in got if r["kept"])


def test_top_k_is_exact(spark):
    docs, quality = _corpus(150, 2)
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    for k in (0, 1, 37, 150, 500):
        got = importance.importance_resample(_df(spark, docs), labels, keep=k).collect()
        order = sorted(got, key=lambda r: -r["gumbel_key"])
        assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in order[:k]}


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    values = np.round(np.concatenate([rng.normal(size=500), [1.0] * 40, -1e6 * rng.random(3)]), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for k in (1, 2, 40, 300, len(values)):
        assert importance.kth_largest(df, "v", k, bins=16) == np.sort(values)[::-1][k - 1]
    assert importance.kth_largest(df, "v", 10**6, bins=16) == values.min()


def test_without_labels_all_documents_with_words_stay(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = importance.importance_resample(_df(spark, [(1, "a b"), (2, "")]), labels).collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {1: True, 2: False}
    assert importance.importance_resample(_df(spark, [(1, "a")]).limit(0), labels).count() == 0


def test_the_cut_parts_good_from_bad():
    assert 1 < importance.quality_cut(np.array([2.0, 3.0]), np.array([0.0, 1.0])) < 2
    assert importance.quality_cut(np.array([2.0]), np.array([])) == -np.inf


def _toxic(n=1200):
    rng = random.Random(3)
    bad, groups = ["slur%d" % i for i in range(8)], ["women", "men", "muslims", "christians"]
    docs, toxic = [], {}
    for i in range(n):
        own = words(rng.randrange(10, 80), 10_000 + i, 800)
        is_toxic = i % 4 == 0
        if is_toxic:
            own[rng.randrange(len(own))] = rng.choice(bad) + ","
        # One group is named in most toxic texts: without the penalty its name alone would be a signal.
        if rng.random() < (0.8 if is_toxic else 0.05):
            own.append("muslims")
        elif rng.random() < 0.3:
            own.append(rng.choice(groups))
        docs.append((i, " ".join(own)))
        toxic[i] = int(is_toxic)
    return docs, toxic


def test_held_out_texts_and_neutral_mentions(spark):
    import zlib

    docs, toxic = _toxic()
    probe = [(5000 + i, " ".join(words(40, 60_000 + i, 800)) + " muslims") for i in range(100)]
    extra = [(6000, None), (6001, ""), (None, "slur1"), docs[0], docs[0]]
    labels = spark.createDataFrame([(i, t, "x") for i, t in toxic.items()] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    df = _df(spark, docs + probe + extra)
    plain, fair = (
        {r["doc_id"]: r for r in toxicity.score_toxicity(df, labels, penalty=p).collect()} for p in (0.0, 4.0)
    )
    assert toxicity.score_toxicity(df, labels).count() == len(docs) + 105
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(fair[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in toxic)
    right = np.mean([fair[i]["predicted"] == toxic[i] for i in held])
    assert right > 0.97, right
    false = [sum(m[i]["predicted"] for i, _ in probe) for m in (plain, fair)]
    assert false[1] == 0 and np.mean([fair[i]["score"] for i, _ in probe]) < np.mean([plain[i]["score"] for i, _ in probe])
    assert 0 <= fair[6000]["score"] <= 1 and fair[6000]["score"] == fair[6001]["score"] and not fair[None]["held_out"]


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(_df(spark, [(1, "a")]), labels).first()["predicted"] == 0
    assert toxicity.score_toxicity(_df(spark, [(1, "a")]).limit(0), labels).count() == 0


PAGES = {
    "article": ("<html><head><title>T</title></head><body><nav><ul><li>Home</ul></nav><div class='ad'>Buy</div><article><h1>A &amp; B</h1>"
    "<p><b>Bold.<br><p>Two\n  lines&nbsp;x</p><aside>side</aside><section id=comments><p>Nice!</p></section></article><footer>&copy; F</footer>", ["A & B", "Bold.", "Two lines x"]),
    "main": ("<body><header>Site</header><main><p>One<p>Two <i>it</i>alic<ul><li>a<li>b</ul><form>f</form><script>x='</p>'</script></main>", ["One", "Two italic", "a", "b"]),
    "body": ("<div class=sidebar>s</div><div class='post-body'>Text<div hidden>h</div> more</div><!-- c --><p>Last <", ["Text", "more", "Last <"]),
    "headed": ("<article><header><h2>Title</h2></header><table><tr><td>1<td>2</table><div class='share-buttons'>S</div>x &lt; y &#228; &unknown;</article>", ["Title", "1", "2", "x < y ä &unknown;"]),
    "none": ("<nav>only</nav>", []),
}


def test_blocks_of_pages():
    for name, (html, want) in PAGES.items():
        assert html_text._main_blocks(html)[1] == want, name
    assert html_text._main_blocks("")[1] == []
    assert html_text._main_blocks("<div>" * 3000 + "deep")[1] == ["deep"]
    assert html_text._main_blocks("<p>" + "a " * 100_000)[1] == ["a " * 99_999 + "a"]


def test_nothing_of_an_article_is_lost():
    blocks = lambda html: html_text._main_blocks(html)[1]
    inside = "<article><h1>A</h1><h2 id='social-history'>B</h2><section id='related-work'><p>C</p></section><div class='share-prices'>D</div>"
    inside += "<p>E <span id='copyright'>F</span> <label>G</label></p><div class='related-posts'>X</div><ul class=comments><li>X</ul></article>"
    assert blocks(inside) == ["A", "B", "C", "D", "E F G"]
    assert blocks("<main><h1>Title</h1><article><p>A longer body.</p></article></main>") == ["Title", "A longer body."]
    assert blocks("<h1>Title</h1><article><p>A body that is longer.</p></article>") == ["Title", "A body that is longer."]
    assert blocks("<article><p>One half.</p></article><section><p>The other.</p></section>") == ["One half.", "The other."]
    assert blocks('<article><p class="a>one</p><p>two</p></article>') == ["one", "two"]
    assert blocks("<p title='it's>a</p><b x=\"1>c") == ["a", "c"]


def test_depth_costs_nothing():
    for html in ("<div>" * 100_000 + "deep", "<div>x" * 50_000, "<p><b>" * 30_000 + "x", "<ul><li>" * 30_000 + "x", "<table><tr><td>" * 20_000 + "x", "</div>" * 100_000 + "x"):
        begin = time.perf_counter()
        assert html_text._main_blocks(html)[1]
        assert time.perf_counter() - begin < 3


def test_only_the_count_of_subtrees_decides(spark):
    """Nothing in tag or name tells the box from the text; its wording is the same on ten pages or more, whatever the host's size."""
    box = "<div class=k><p>Read <b>more</b> of us</p></div>"
    page = lambda i, extra: f"<article><h1>News {i}</h1>{extra}<p>It was day {i}.</p><p>Yes.</p></article>"
    rows = [(i, "http://a.org/x", page(i, box if i < 12 else "")) for i in range(400)]
    rows += [(1000 + i, "http://b.org/x", page(i, box if i < 9 else "")) for i in range(50)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"News {i}\n\nIt was day {i}.\n\nYes." for i in range(400))
    assert all(("Read more of us" in got[1000 + i]) == (i < 9) for i in range(50))


def test_templates_of_a_host_are_deleted(spark):
    rows = []
    for i in range(40):
        body = f"<div>About this site</div><div><p>Story {i} of the day</p></div>"
        rows.append((i, f"http://a.org/{i}", body, "x"))
    # Copies of one page are no template, and another host's page keeps its words.
    rows += [(100 + i, f"http://b.org/{i}", "<div><p>Same page</p></div>", "x") for i in range(40)]
    rows += [(200, "http://c.org/", "<div>About this site</div>", "x"), (201, None, None, "x"), (None, "bad", "<p>x", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_text.main_text(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["text"] == f"Story {i} of the day" for i in range(40))
    assert all(got[100 + i]["text"] == "Same page" for i in range(40))
    assert got[200]["text"] == "About this site" and got[201]["text"] == "" and got[None]["text"] == "x"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_a_card_and_a_formula_do_not_hide_text():
    page = "<main><h1>Title</h1><p>A body of some length.</p><article>card</article></main>"
    assert html_text._main_blocks(page)[1] == ["Title", "A body of some length.", "card"]
    formula = "<article><p>So <math><mi>x</mi><annotation>\\x</annotation></math> is it.</p></article>"
    assert html_text._main_blocks(formula)[1] == ["So x is it."]
