"""Phrase mining, page text and hard negatives against brute force and labelled pages."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import hard_negatives, html_blocks, jaccard_join, phrase_mining

# phrases

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_rows() -> list[tuple]:
    rnd = random.Random(5)
    words = ["a", "b", "c", "the", "of", "X", "é", "漢"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "\x0c", ""]
    rows = [("".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "de", None, "und"]), i) for i in range(60)]
    return rows + [(None, "en", 1), ("", "x", 2), ("The cat sat on the mat today again ok", "en", 3)] * 6 + [("a " * 3000, "fr", 4), ("z" * 5000, "fr", 5), (" .,;:!? \t", "fr", 6)]


def collocations(rows, least, top):
    counts, totals = Counter(), Counter()
    for text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(A_TO_Z)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    inside = {(lang, p[i : i + k]) for (lang, p), a in counts.items() if a >= least for k in range(2, len(p)) for i in range(len(p) - k + 1) if counts[lang, p[i : i + k]] == a}
    found = defaultdict(list)
    for (lang, p), a in counts.items():
        if a >= least and len(p) > 1 and (lang, p) not in inside:
            score, cut = min((1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
            found[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:cut]], counts[lang, p[cut:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, totals[lang], -s) for lang, all_of in found.items() for rank, (s, a, p, left, right) in enumerate(sorted(all_of)[:top], 1))


@pytest.mark.parametrize(("least", "top", "slots"), [(3, 50, 1 << 12), (2, 2000, 64)])
def test_phrases(spark, least, top, slots):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, phrase int").repartition(3)
    assert sorted(tuple(r)[:8] for r in phrase_mining.mine_phrases(docs, least, top, slots).collect()) == collocations(rows, least, top)


def test_phrases_of_nothing(spark):
    assert phrase_mining.mine_phrases(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_rare_runs_never_hide_frequent_ones(spark):
    rows = [(f"w{i} w{i + 1}", "en") for i in range(40) for _ in range(1 + i % 5)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    bits = phrase_mining.frequent_slots(docs, 3, 1 << 14)
    kept = {r["phrase"]: r["n"] for r in phrase_mining.runs(docs, bits, 1 << 14).filter("k > 1").collect()}
    assert {p: n for p, n in kept.items() if n >= 3} == {f"w{i} w{i + 1}": 1 + i % 5 for i in range(40) if 1 + i % 5 >= 3}


def test_unary_paths(spark):
    """Two passages of ten words share their middle six: three paths, and counts that only differ between them."""
    middle = "m1 m2 m3 m4 m5 m6"
    rows = [(f"a1 a2 {middle} a3 a4", "en")] * 3 + [(f"b1 b2 {middle} b3 b4", "en")] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    counted = phrase_mining.runs(docs, phrase_mining.frequent_slots(docs, 1, 64), 64)
    levels = phrase_mining.flow(counted)
    paths = phrase_mining.unary_paths(levels[4], levels[3]).collect()
    by_head = defaultdict(dict)
    for r in paths:
        by_head[r["head"]][r["place"]] = r["phrase"]
        assert r["length"] >= r["place"] + 1
    assert {h: len(p) for h, p in by_head.items()} == {"a1 a2 m1 m2 m3": 2, "b1 b2 m1 m2 m3": 2, "m1 m2 m3 m4 m5": 2, "m3 m4 m5 m6 a3": 2, "m3 m4 m5 m6 b3": 2}
    got = {r["phrase"]: r["passage_words"] for r in phrase_mining.mine_phrases(docs, 2, 2000, 64).collect()}
    assert got["m1 m2 m3 m4 m5"] == 6 and got["a1 a2 m1 m2 m3"] == 6


# pages


def text_of(page: str, tree) -> str:
    blocks, has_article = html_blocks.text_blocks(page)
    return "\n".join(b.text for b, p in zip(blocks, tree.predict(html_blocks.features(blocks, has_article)), strict=True) if p >= 0.5)


@pytest.fixture(scope="module")
def tree():
    return html_blocks.fit(html_blocks.sample_pages(html_blocks.SAMPLE))


def test_held_out_pages(tree):
    pages = html_blocks.sample_pages(200, 7)
    blocks = right = 0
    for page, text in pages:
        want, got = Counter(text.split("\n")), Counter(text_of(page, tree).split("\n"))
        blocks += sum((want | got).values())
        right += sum((want & got).values())
    assert right / blocks > 0.97


BLOG = """<!DOCTYPE html><html><HEAD><title>Site &amp; more</title><script>if (a < b) document.write("<p>no</p>");</script></HEAD>
<body class="has-sidebar"><div id="cookie-bar" class="cookie-notice"><p>We use cookies to give you the best experience on this site.</p></div>
<header class="site-header"><h2>The site</h2><nav><ul><li><a href="/">Home<li><a href="/b">Blog</a></ul></nav></header>
<main><article class="post"><header class="entry-header"><h1>A  title &mdash; here</h1></header>
<p>First&nbsp;paragraph with <a href="/x">a link</a> and <em>em</em>phasis&#33;
<p>Second &lt;one&gt;<br>after a break.</p><aside class="pull">A pull quote of the author, repeated</aside>
<div class="ad-slot">Buy our things now</div><ul><li>First point of a list</li><li>Second point</li></ul>
<form><label>Your mail</label><input type=text value="a>b"><button>Send</button></form>
<!-- <p>gone</p> --><p hidden>Not for people</p><p>Last line of it.</p></article>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I think this is a very good article, it has all that I was looking for.</p></div></section></main>
<aside class="sidebar"><h3>About</h3><p>I am the author of this page and write about many things.</p></aside>
<footer>&copy; 2020 The site. All rights reserved.</footer>"""


def test_page_of_a_blog(tree):
    assert text_of(BLOG, tree) == "A title — here\nFirst paragraph with a link and emphasis!\nSecond <one> after a break.\nFirst point of a list\nSecond point\nLast line of it."


def test_pages(spark, tree):
    article = "<nav><a href=/>Home</a></nav><article><h1>Head</h1><p>Some words of text.</p></article><footer>Foot</footer>"
    long = "<article>" + "<p>word by word, on and on.</p>" * 50_000 + "</article>"
    pages = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", article, "x"), (3, "u", article, "x"), (None, "u", "no tags", "x"), (4, "u", "<article><p>cut of<", "x"), (5, "u", long, "x"), (6, "u", "<!-- open", "x")]
    df = html_blocks.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string, text string"))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = df.collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    got = {r["page_id"]: r["text"] for r in rows}
    assert got[1] == got[2] == got[6] == "" and got[3] == "Head\nSome words of text." and got[4] == "cut of<" and got[5].count("\n") == 49_999
    assert html_blocks.extract_text(spark.createDataFrame(pages[:0], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", ["<a '" * 100_000, "<!--" * 50_000, "<p>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000, "<a href=\"" * 50_000 + ">x", "<" * 300_000, "<p class=" + " " * 300_000 + ">", "<script>" * 50_000])
def test_broken_pages_take_linear_time(page):
    html_blocks.text_blocks(page)


def test_tree_fits_what_splits_tell():
    x = np.array([[i, i % 3] for i in range(60)], float)
    y = ((x[:, 0] > 30) & (x[:, 1] == 1)).astype(float)
    assert ((html_blocks.fit_tree(x, y, least=1).predict(x) >= 0.5) == y).all()


# vectors


def vector_rows(n: int, width: int, every: int, labels: int, same: int) -> list[tuple]:
    """Some equal vectors, very different lengths, repeated rows, and rows that take no part."""
    rnd = np.random.default_rng(n)
    base = rnd.normal(size=width)
    rows = [(i, [float(x) for x in (base if i < same else rnd.normal(size=width) * rnd.choice([0.1, 1, 1, 3])).astype(np.float32)], int(rnd.integers(labels))) for i in range(n)]
    one = [1.0] * width
    bad = [(None, one, 0), (5, None, 1), (6, one, None), (7, [math.nan, *one[1:]], 1), (8, [math.inf, *one[1:]], 1), (9, [None, *one[1:]], 1)]
    return rows + bad + [(every, [], 0), (2 * every, [0.0] * width, 1), (3 * every, [1.0] * (width + 3), 1), rows[0], rows[0], rows[every]]


def negatives(rows, every):
    known = [(i, v, [math.floor(256 * x) for x in e], label) for i, (v, e, label) in enumerate(rows) if None not in (v, e, label) and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, e, label in known:
        if v % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(e, f)), w, j, other) for j, w, f, other in known if j != i)  # noqa: B905
        for p, positive, _, _ in [s for s in scores if s[3] == label][:5]:
            fits = [s for s in scores if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(v, positive, rank, s[1], -p, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("shape", [(300, 8, 10, 3, 0), (300, 16, 20, 2, 120)])
def test_negatives(spark, monkeypatch, shape, small):
    if small:
        for name, value in (("BLOCK", 37), ("ANCHORS", 5), ("PILOT", 7)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows(*shape)
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "vec_id long, embedding array<float>, label int, norm double").repartition(3)
    found = hard_negatives.mine_negatives(df, F.col("id") % shape[2] == 0)
    assert sorted(tuple(r) for r in found.collect()) == negatives(rows, shape[2])


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine_negatives(df, F.col("id") % 100 == 0).count() == 0


def test_very_large_components_are_exact():
    rows, anchor = np.array([[2.0**40, 1.0], [-(2.0**70), 0.0]]), np.array([2.0**20, 3.0])
    norms = np.linalg.norm(rows, axis=1)
    assert hard_negatives.exact_scores(rows, norms, anchor, np.linalg.norm(anchor)).tolist() == [2**60 + 3, -(2**63 - 1)]


# word hashes


def test_words_that_polynomial_hashes_mix_up_stay_apart(spark):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    docs = [(i, w) for i, w in enumerate(x for n in (1024, 2048, 4096) for x in (word[:n], word[:n].translate(str.maketrans("ab", "ba"))))]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i for i, _ in docs}
