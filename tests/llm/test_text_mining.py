"""Phrases, source divergence and main text of pages against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import divergence, html_text, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, phrase string, term string, range string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, l, s, 7, "x", "y", "z") for i, t, l, s in rows], SCHEMA).repartition(parts)


def made_rows():
    """Texts over few words, with copies, ties, awkward white space, NULLs and case."""
    rng = np.random.default_rng(5)
    words = ["the", "of", "New", "YORK", "city", "É", "zwölf", "a b", "日本", "x" * 40, "don't", "#"]
    ends = [" ", " ", " ", "  ", "\t", " \t ", ". ", ", ", "\n", "\r\n", "\x0b", "?"]
    rows = []
    for i in range(120):
        n = int(rng.integers(0, 60))
        text = "".join(words[min(int(rng.zipf(1.5)) - 1, 11)] + ends[int(rng.integers(0, 12))] for _ in range(n))
        if i % 7 == 0:
            text += " New York city of the É " * 3
        lang = [None, "en", "en", "en", "de"][int(rng.integers(0, 5))]
        rows.append((i if i % 11 else None, text if i % 13 else None, lang, ["a", "b", None, "", "c"][int(rng.integers(0, 5))]))
    return rows + rows[5:9] + [(900, "", "fr", "a"), (901, " \t.,", None, None), (902, "Ends; here", "it", "a")]


def plain_collocations(rows, least, best):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = (
                len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 100 * a
                for q, b in candidates.items()
            )
            if any(inside):
                continue
            cut = min((1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-cut[0], -a, " ".join(p).encode(), own[p[: cut[1]]], own[p[cut[1] :]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:best], start=1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least, best", [(3, 2000), (8, 10), (1, 40)])
def test_collocations_equal_plain_counts(spark, least, best):
    rows = made_rows()
    got = phrases.collocations(frame(spark, rows), least, best)
    assert [t for _, t in got.dtypes] == ["string", *["bigint"], "string", *["bigint"] * 5]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, least, best)


def test_collocations_of_a_text_longer_than_a_portion(spark):
    text = "alpha beta gamma. " * 250_000 + "beta gamma"
    assert len(text) > phrases.PORTION
    got = phrases.collocations(frame(spark, [(1, text, "en", "s"), (2, "alpha beta", "en", "s")], 2), 100, 5)
    assert {r["phrase"]: r["a"] for r in got.collect()} == {"alpha beta": 250_001, "beta gamma": 250_001, "alpha beta gamma": 250_000}


def test_collocations_of_no_rows(spark):
    assert phrases.collocations(frame(spark, [], 1)).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None, None)], 1)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=8), st.integers(1, 12))
def test_merged_summaries_keep_every_frequent_item(parts, least):
    """Whatever the order of merging: an item of ``least`` or more survives, and counts stay within the cut."""
    true = Counter(x for p in parts for x in p)
    whole = phrases.Summary(sum(map(len, parts)) // least + 1)
    for part in parts:
        own = phrases.Summary(whole.capacity)
        gram, n = np.unique(np.array(part, np.uint64), return_counts=True)
        own.merge(gram, n.astype(np.int64))
        whole.merge(own.gram, own.n, own.cut)
    assert len(whole.gram) <= whole.capacity and whole.cut < least
    kept = dict(zip(whole.gram.tolist(), whole.n.tolist()))
    assert {x for x, n in true.items() if n >= least} <= set(whole.at_least(least).tolist())
    assert all(true[x] - whole.cut <= n <= true[x] for x, n in kept.items())


def test_a_full_map_loses_nothing():
    """Where the map of survivors is full, more is looked at and nothing left out."""
    grams = np.arange(1000, dtype=np.uint64) << np.uint64(50)
    assert phrases._marked(np.full((1 << phrases.BITS) // 8, 255, np.uint8), grams).all()
    assert not phrases._marked(np.zeros((1 << phrases.BITS) // 8, np.uint8), grams).any()


def plain_divergence(rows, least_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(own):
            total = sum(own[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1000000000 * (own[t] + 2) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s})
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(found, start=1)]
    return sorted(out)


@pytest.mark.parametrize("least_docs, top", [(10, 10), (1, 3), (1000, 10)])
def test_divergence_equals_plain_counts(spark, least_docs, top):
    rows = made_rows()
    got = divergence.source_divergence(frame(spark, rows), least_docs, top)
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "string", "bigint", "int"]
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(rows, least_docs, top)


def test_divergence_of_no_rows(spark):
    assert divergence.source_divergence(frame(spark, [], 1)).count() == 0


def test_divergence_of_a_text_longer_than_a_shard(spark):
    rows = [(1, "one two three " * 300_000, "en", "a")] + [(i, "two Three four", "en", "b") for i in range(2, 20)]
    assert len(rows[0][1]) > divergence.SHARD
    got = divergence.source_divergence(frame(spark, rows, 3))
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(rows, 10, 10)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abAB é日#", max_size=30), max_size=12), st.integers(0, 3))
def test_pointers_are_sorted_by_their_terms(texts, times):
    texts = texts + ["prefix prefixlonger prefixlongerstill " * 700] * times
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *[len(t.encode()) for t in texts]])
    pointers = divergence.Pointers(data, bounds)
    order, runs = pointers.sorted_runs()
    got = [pointers.text(i) for i in order]
    want = sorted((w for t in texts for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(LOWER))), key=str.encode)
    assert got == want
    assert [got[i] for i in runs] == sorted(set(want), key=str.encode)


P1 = "The council met on Tuesday, and after a long debate it agreed to mend the old bridge before winter."
P2 = "Engineers had warned, twice, that the piers were weak; nobody listened until the flood of last spring."
P3 = "Work starts in May."
REMARK = "I have lived here for forty years, and honestly, I do not believe a single word of what they promise us!"
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News of the day</a></li><li><a href="/c">Sport</a></li></ul>'
BODY = f"<h1>Bridge to be mended</h1><p>{P1}</p><h2>Warnings</h2><p>{P2}</p><p>{P3}</p>"
TEXT = "\n\n".join(["Bridge to be mended", P1, "Warnings", P2, P3])


@pytest.mark.parametrize("page", [
    f"<html><body><nav>{MENU}</nav><article>{BODY}</article><footer>All rights reserved, 2024.</footer></body></html>",
    f"<body><header><h2>The Daily</h2>{MENU}</header><main>{BODY}</main><aside><p>{REMARK}</p></aside>",
    f'<body><div class="top-menu">{MENU}</div><div id="content">{BODY}</div><div class="sidebar"><p>{REMARK}</p></div></body>',
    f'<body><div id="page">{MENU}<div class="entry-content">{BODY}</div><div id="comments"><p>{REMARK * 6}</p></div></div></body>',
    f'<article>{BODY}<section class="comments"><article class="comment"><p>{REMARK * 9}</p></article></section></article>',
    f'<body><div class="cookie-notice"><p>{REMARK}</p><button>OK</button></div>{BODY}<form><label>Mail</label><input></form></body>',
    f'<body><script>var x = "<p>{REMARK}</p>";</script><style>p {{ margin: 0 }}</style><!-- <p>{REMARK}</p> -->{BODY}',
    f'<table><tr><td>{MENU}</td><td>{BODY}</td></tr></table>',
    f'<body class="has-sidebar"><form id="whole"><div class="ad">{REMARK}</div><article>{BODY}</article></form></body>',
    f'<body><div role="navigation">{MENU}</div><div role="main">{BODY}</div><div role="contentinfo">Imprint, 2024.</div></body>',
    f'<article>{BODY}<div class="related"><a href="/x">Other bridge</a> <a href="/y">Another flood</a></div></article>',
    f'<article>{BODY}{MENU}</article>',
    f'<main><article>{BODY}</article><article class="teaser"><h3>Else</h3><p>Short one.</p></article></main>',
    f"<article>{BODY.replace('</p>', '')}",
])
def test_main_text_leaves_out_what_is_around_the_article(page):
    assert html_text.main_text(page) == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><head><title>T</title></head><body></body></html>", ""),
    ("just words", "just words"),
    ("<p>a &lt;b&gt; &amp;amp; &eacute;&#x41;&nbsp;&#8217;</p>", "a <b> &amp; éA ’"),
    ("<article><p>one\n two\t<b>th</b>ree<br>four</p>five<ul><li>six<li>seven</ul></article>", "one two three four\n\nfive\n\nsix\n\nseven"),
    ("<article><h1>T</h1><p><b>un<p>closed <i>here</article><footer>foot</footer>", "T\n\nun\n\nclosed here"),
    ('<article><p title="a > b">x < y and z</p></article>', "x < y and z"),
    ("<article><p>cut off <a href=\"x", "cut off"),
    ("<nav><a href=/>only</a></nav><footer>this</footer>", ""),
    ("<article><p>a</p></div></b></article></article><p>b", "a"),
])
def test_main_text_of_awkward_pages(page, text):
    assert html_text.main_text(page) == text


def test_extraction_returns_every_row(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "x"), (1, "u", f"<article>{BODY}</article>", "x"), (None, None, None, None), (3, "v", "", "")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string").repartition(3)
    got = html_text.extracted(pages)
    assert got.dtypes == [("page_id", "int"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_a_very_long_page():
    body = "".join(f"<p>Sentence {i}, of a very long page, that goes on and on.</p>" for i in range(60_000))
    text = html_text.main_text(f"<nav>{MENU}</nav><article>{body}</article>")
    assert text.count("\n\n") == 59_999 and len(text) > 2_000_000
    assert html_text.main_text("<div>" * 50_000 + "deep words, here." + "</div>" * 50_000) == "deep words, here."
