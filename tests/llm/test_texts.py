"""Mixing, decontamination, licenses, pages and quality."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import documents, no_documents, odd_documents, plain  # noqa: F401
from pyspark.sql import functions as F

from gristmill.llm import html_text, licenses, mixing, pairwise_quality, queries, spaced_seeds

# ---- mixing ------------------------------------------------------------------------------------


def closest(lengths, budget):
    reach = {0}
    for n, c in lengths.items():
        reach = {s + n * k for s in reach for k in range(c + 1)}
    return min(abs(s - budget) for s in reach)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=6), st.integers(0, 300))
def test_fit_comes_as_close_as_any_choice(lengths, budget):
    taken = mixing.fit(lengths, budget, "s")
    total = sum(n * c for n, c in taken.items())
    assert all(0 < c <= lengths[n] for n, c in taken.items())
    whole = {n: c * budget // max(1, sum(n * c for n, c in lengths.items())) for n, c in lengths.items()}
    if budget < sum(n * c for n, c in lengths.items()):
        rest = {n: c - whole[n] for n, c in lengths.items()}
        base = sum(n * c for n, c in whole.items())
        assert abs(total - budget) == closest(rest, budget - base)
    assert mixing.fit(lengths, budget, "s") == taken


def test_fit_of_a_large_budget():
    lengths = {n: 50 for n in range(100, 4000, 7)}
    budget = sum(n * 50 for n in lengths) // 3
    assert sum(n * c for n, c in mixing.fit(lengths, budget, "s").items()) == budget


def test_targets():
    found = mixing.targets([("b", 100), (None, 1000), ("a", 10)])
    assert found["a"] == 30 and found["b"] == pytest.approx(300) and found[None] == pytest.approx(780)
    assert sum(found.values()) == pytest.approx(1110)
    assert mixing.targets([("a", 0)]) == {"a": 0.0} and mixing.targets([]) == {}


def test_mix(spark, sf_dir, documents):
    result = queries.op2_source_mixing(spark, sf_dir).collect()
    again = queries.op2_source_mixing(spark, sf_dir).collect()
    assert sorted(result) == sorted(again)
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    sizes = Counter()
    for doc_id, text in plain(documents):
        sizes[source[doc_id]] += len(brute.WORD.findall(text or ""))
    wanted, taken = mixing.targets(list(sizes.items())), Counter()
    for r in result:
        assert r["source_size"] == sizes[source[r["doc_id"]]] and r["target"] == pytest.approx(wanted[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source[r["doc_id"]]] += r["taken"]
    # The small table has ten documents in a source; with more, every target is met to the word.
    assert all(abs(taken[s] - t) <= 0.02 * t for s, t in wanted.items())


def test_mix_of_odd_documents(odd_documents, no_documents):
    result = mixing.mix(odd_documents).collect()
    assert len(result) == odd_documents.count()
    sizes = sorted((r["doc_id"] or 0, r["size"]) for r in result)
    expected = [(r["doc_id"] or 0, len(brute.WORD.findall(r["text"] or ""))) for r in odd_documents.collect()]
    assert sizes == sorted(expected)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in result)
    assert mixing.mix(no_documents).count() == 0


def test_ranks_within_a_class(spark):
    """Many documents of one length: exactly as many are taken as fit, by rank inside one part of the hash range."""
    rows = [(i, "a b c", "x") for i in range(3000)] + [(9000 + i, "a b c d", "y") for i in range(3000)]
    result = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    totals = defaultdict(int)
    for r in result:
        totals[r["target"]] += r["taken"]
    assert totals and all(abs(t - n) < 4 for t, n in totals.items())


# ---- decontamination -----------------------------------------------------------------------------


def leaks(documents, benchmark):
    return {r["doc_id"]: list(r["items"]) for r in spaced_seeds.leaks(documents, benchmark).collect()}


def test_leaks(spark, sf_dir, documents):
    result = {r["doc_id"]: list(r["items"]) for r in queries.op5_benchmark_decontamination(spark, sf_dir).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert result == brute.leaked(plain(documents), items, spaced_seeds.STRETCH, spaced_seeds.SHARE)
    assert any(result.values())


@pytest.mark.parametrize("size", range(1, spaced_seeds.STRETCH + 1))
def test_every_pattern_of_replaced_words_has_a_seed(size):
    item, short = np.arange(1, size + 1, dtype=np.uint64), [size] if size < 12 else []
    seeds, places = spaced_seeds.seed_hashes(item, short)
    known = set(zip(seeds.tolist(), places.tolist()))
    for replaced in combinations(range(size), size - math.ceil(size * spaced_seeds.SHARE)):
        words = item.copy()
        words[list(replaced)] += np.uint64(1000)
        found, at = spaced_seeds.seed_hashes(words, short)
        assert not known.isdisjoint(zip(found.tolist(), at.tolist())), replaced


def test_short_items_with_replaced_words(spark):
    """Items of 1 to 13 words, each in documents with none to three words replaced, against all alignments."""
    draw = np.random.default_rng(8)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 14)] + [(20, "the same the same the"), (21, "a b a b a b a b")]
    rows = []
    for i, (_, text) in enumerate(items):
        words = text.split()
        for k in range(12):
            some = list(words)
            for at in draw.choice(len(words), min(k % 4, len(words)), replace=False):
                some[at] = f"other{at}"
            rows.append((100 * i + k, f"Before it. {' '.join(some).upper()}; and after"))
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    result = leaks(documents, spark.createDataFrame(items, "item_id bigint, text string"))
    expected = brute.leaked(rows, items, spaced_seeds.STRETCH, spaced_seeds.SHARE)
    assert result == expected and sum(map(bool, expected.values())) > 60


def test_leaks_with_replaced_words(spark, odd_documents, no_documents):
    words = [f"q{i}" for i in range(40)]
    every = [w if i % 6 else "other" for i, w in enumerate(words)]
    items = [
        (1, " ".join(words)), (2, None), (3, ""), (4, "just three words"), (4, "just three words"), (None, "x y"),
        (5, " ".join(f"e{i}" for i in range(20))),
    ]
    rows = [
        (1, "Before. " + " ".join(words).upper() + " after"), (2, "z " + " ".join(every) + " z"), (3, None), (4, ""),
        (5, " ".join(words[:15])), (6, "So: just, three (words)!"), (7, "three words just"), (8, " ".join(words[3:30])),
        (9, " ".join(w if i % 3 else "no" for i, w in enumerate(words))), (10, "x y"),
    ]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, doc_id int")
    documents = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, item_id int")
    result = leaks(documents, benchmark)
    assert result == {1: [1], 2: [1], 3: [], 4: [], 5: [], 6: [4], 7: [], 8: [1], 9: [], 10: []}
    assert not any(leaks(odd_documents, benchmark).values()) and leaks(no_documents, benchmark) == {}
    assert not any(leaks(documents, benchmark.where("item_id > 99")).values())


# ---- licenses ------------------------------------------------------------------------------------


def expected_license(text):
    n, starts, base = brute.phrase_places(text, licenses.PHRASES)
    more = brute.contained(text, licenses.TEMPLATES, licenses.THRESHOLD)
    score = 1.0 if base else max(more.values(), default=0.0)
    ends = (min(starts, default=None), max(starts, default=None))
    return (n, len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(base | set(more))), score)


def test_licenses(spark, sf_dir, documents):
    texts = dict(plain(documents))
    result = queries.op7_license_scan(spark, sf_dir).collect()
    assert all(tuple(r)[1:] == expected_license(texts[r["doc_id"]]) for r in result) and any(r["labels"] for r in result)


def test_licenses_of_odd_documents(spark, odd_documents, no_documents):
    texts = [
        None, "", "CC BY cc-by-cc BY", "All  rights\nreserved; ALL RIGHTS RESERVED", "ccby cc byé cc-by",
        "GNU General Public License general public license", "Released under\nthe MIT license",
        "this copy: permission is hereby granted, free of charge, to any person obtaining a copy of the software",
        "released under the licence mit", "cc by " * 500,
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, labels string")
    result = licenses.license_labels(frame).collect()
    assert sorted((tuple(r) for r in result), key=repr) == sorted(((i, *expected_license(t)) for i, t in enumerate(texts)), key=repr)
    assert licenses.license_labels(odd_documents).count() == odd_documents.count()
    assert licenses.license_labels(no_documents).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""


def test_statements_over_several_lines(spark):
    """The usual wrapping of two notices, one word per line, and words too far apart."""
    texts = [
        f"Some words before.\n\n{MIT}\nand more", BSD, MIT.replace(" ", "\n"), f"{BSD}\n{MIT}", "released\nunder\n\nthe MIT\nlicense",
        "released under\n" + "other words " * 9 + "\nthe mit license",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.license_labels(frame).collect()}
    assert found == {0: "mit-notice", 1: "bsd", 2: "mit-notice", 3: "bsd,mit-notice", 4: "mit", 5: ""}


# ---- pages ------------------------------------------------------------------------------------------


def page_texts(spark, pages):
    frame = spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(pages)], "page_id bigint, url string, html string, text string")
    return [r["text"] for r in sorted(html_text.main_text(frame).collect())]


BODY = "<p>" + "A sentence of some length that belongs to the article itself. " * 5 + "</p>"
WANTED = " ".join(("A sentence of some length that belongs to the article itself. " * 5).split())


def wrapped(inner, around="div class='post-content-12'"):
    return (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header><h2>Site</h2></header>"
        "<nav><ul><li><a href=/>Home</a><li><a href=/x>About</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
        f"<{around}>{inner}</{around.split()[0]}><div id='comments'><p>{'What a reader says at length. ' * 40}</p></div>"
        "<aside><p>More of our stories</p></aside><form><input>Search</form><footer>&copy; 2020</footer></body></html>"
    )


def test_parts_that_are_not_the_article():
    page = html_text.Page(wrapped(f"<h1>Title &amp; more</h1>{BODY}<p>a<br>b &nbsp;c <b>d</b>e<p>f</div>"))
    path, _ = page.best()
    assert path.endswith("div.post-content-#")
    assert page.under(path) == f"Title & more {WANTED} a b c de f"


def test_hosts_agree_on_a_path(spark):
    pages = [("http://h.example/1", wrapped(f"<h1>One</h1>{BODY}"))] * 3
    # On this page the teasers outweigh the short article; the host's other pages tell which part it is.
    odd = wrapped("<p>Short.</p>").replace("<aside>", f"<section class='list'>{BODY}</section><aside>")
    pages += [("http://H.example:80/2", odd), ("http://other.example/", wrapped(BODY, "article")), (None, None), ("x", ""), (None, "<p>bare")]
    texts = page_texts(spark, pages)
    assert texts == [f"One {WANTED}"] * 3 + ["Short.", WANTED, "", "", "bare"]


def sentences(n, word="word"):
    return " ".join(f"{word} {i} of a sentence." for i in range(n))


@pytest.mark.parametrize("around", ["article", "main", "div class='story'"])
def test_articles_of_several_parts(spark, around):
    """Title, lead and body in containers of their own; a body in two unlike sections."""
    lead, long, short = sentences(5, "lead"), sentences(50, "long"), sentences(33, "short")
    nested = f"<h1>The title</h1><div class=lead>{lead}</div><div class=body><p>{long}</p></div>"
    deep = f"<div class=top><h1>The title</h1></div><div class=text><div class=a>{long}</div><div class=b>{short}</div></div>"
    split = f"<div class=one><p>{long}</p></div><section class=two><p>{short}</p></section>"
    texts = page_texts(spark, [(f"http://{i}.example/", wrapped(x, around)) for i, x in enumerate([nested, deep, split])])
    assert texts == [f"The title {lead} {long}", f"The title {long} {short}", f"{long} {short}"]


@pytest.mark.parametrize(
    "name",
    ["class='content no-sidebar'", "class='has-comments'", "id='page-with-nav'", "class='sidebar-right content'", "class='layout-menu' role='navigation'"],
)
@pytest.mark.parametrize("around", ["article", "main", "div class='post'"])
def test_wrappers_with_marks(name, around):
    """Words on an element around the whole article; those on its neighbours and inside of it still count."""
    text = sentences(40)
    inner = f"<h1>T</h1><p>{text}, se<b>n</b>t</p><div class='share'>Share this story with all of your friends</div>"
    page = wrapped(inner, around).replace("<body>", f"<body><div {name}>").replace("</body>", "</div></body>")
    outside = f"<body><div {name}><{around}>{inner}</{around.split()[0]}></div><ol class='comments'><li>{sentences(90)}</ol></body>"
    for html in (page, outside):
        page = html_text.Page(html)
        assert page.under(page.best()[0]) == f"T {text}, sent"


def test_marked_parts_beside_an_article():
    """Teasers and comments are often articles themselves, and may be longer than the text."""
    text, more = sentences(40), sentences(20, "more")
    own = f"<body><div class='text'><h1>T</h1><p>{text}</p></div>"
    for part in (
        f"<div class='related'><article><p>{more}</p></article></div>",
        f"<ol class='comment-list'><li><article class='comment-body'>{more * 5}</article></ol>",
        f"<div class='comments-with-replies'><p>{more * 5}</p></div>",
    ):
        page = html_text.Page(f"{own}{part}</body>")
        assert page.under(page.best()[0]) == f"T {text}"
    only = html_text.Page(f"<body><div class='page sidebar-left'><p>{text}</p><div class='ads'>Buy</div></div></body>")
    assert only.under(only.best()[0]) == text


def test_parts_that_stand_in_the_body(spark):
    one, two = sentences(30, "one"), sentences(20, "two")
    page = f"<body><nav>Home</nav><section class=a>{one}</section><section class=b>{two}</section><footer>f</footer></body>"
    lone = f"<body><div class=text><p>{one}</p></div><div class=tagline>{sentences(2, 'site')}</div></body>"
    assert page_texts(spark, [("http://a.example/", page), ("http://b.example/", lone)]) == [f"{one} {two}", one]


def test_parts_that_some_pages_of_a_host_lack(spark):
    body, lead = sentences(50, "body"), sentences(5, "lead")
    plain_page, more = (f"<div class=story>{x}<div class=body><p>{body}</p></div></div>" for x in ("", f"<div class=lead>{lead}</div>"))
    pages = [("http://h.example/", wrapped(x, "div class=page")) for x in (plain_page, plain_page, more)]
    assert page_texts(spark, pages) == [body, body, f"{lead} {body}"]


def test_pages(spark, sf_dir):
    result = queries.op4_html_extraction(spark, sf_dir).collect()
    sources = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    import re

    for r in result:
        article = re.search(r"<article>(.*?)</article>", sources[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", article))
        blocks = [" ".join(html.unescape(p.replace("<br>", " ")).split()) for p in parts]
        assert r["text"] == " ".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_no_pages(spark):
    assert page_texts(spark, []) == []


# ---- quality ------------------------------------------------------------------------------------------


def test_quality(spark, sf_dir):
    result = queries.op9_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in result if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 30 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in result)
    good, bad = [s for s, _, q in held if q], [s for s, _, q in held if not q]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(p == q for _, p, q in held) / len(held) > 0.93


def test_quality_of_odd_documents(spark, odd_documents, no_documents):
    schema = "doc_id bigint, quality int, text string"
    labels = spark.createDataFrame([(6, 1, ""), (8, 1, ""), (11, 0, ""), (10, 0, ""), (4, None, ""), (13, 1, ""), (13, 0, ""), (None, 1, "")], schema)
    result = pairwise_quality.quality(odd_documents, labels).collect()
    assert len(result) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in result)
    import zlib

    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in result)
    repeated = [r["score"] for r in result if r["doc_id"] == 5]
    assert repeated[0] == repeated[1]
    assert pairwise_quality.quality(no_documents, labels).count() == 0
    none = pairwise_quality.quality(odd_documents, labels.where("doc_id < 0")).collect()
    assert {r["predicted"] for r in none} == {1}


def test_one_row_of_an_id_is_learned_from(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"words of text {i}") for i in ids] + [(ids[0], f"another text {k} of that id") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int")
    fitted = []
    monkeypatch.setattr(pairwise_quality, "Ranker", lambda x, good: fitted.append((x.tolist(), good.tolist())))
    pairwise_quality.learn(docs, labels)
    pairwise_quality.learn(docs.orderBy(F.desc("text")), labels)
    assert len(fitted[0][0]) == len(ids) and fitted[0] == fitted[1]


def test_a_ranker_orders_by_the_feature_that_matters():
    rng = np.random.default_rng(3)
    x = rng.random((400, pairwise_quality.FEATURES))
    ranker = pairwise_quality.Ranker(x, x[:, 4] > 0.5)
    scores = ranker.scores(x)
    assert ((scores >= pairwise_quality.CUT) == (x[:, 4] > 0.5)).mean() > 0.97


def test_forms_and_headers_around_the_article(spark):
    """A form around the whole page, with and without an article; a site's header goes, an article's keeps its title."""
    body = " ".join(f"<p>{sentences(3, f'b{i}')}</p>" for i in range(4))
    plain = " ".join(sentences(3, f"b{i}") for i in range(4))
    site = "<header><h1>Site name</h1><nav><a href=/>Home</a></nav><p>The site of the sites, of all the sites there are</p></header>"
    form = "<form action=/subscribe><p>Subscribe to our letter and get all of the news of each and every day</p><input></form>"
    head = "<header><h1>The title</h1><p>By a writer</p></header>"
    pages = {
        f"<body><form id=aspnetForm>{site}<article>{body}</article>{form}</form></body>": plain,
        f"<body><form id=aspnetForm><div class=content>{body}</div></form></body>": plain,
        f"<body>{site}<article>{head}{body}{form}</article></body>": f"The title {plain}",
        f"<body>{site}<main><div>{head}{body}</div></main></body>": f"The title {plain}",
        f"<body>{site}<div class=text>{body}{form}</div></body>": plain,
        f"<body>{form}</body>".replace("<p>", "<label>").replace("</p>", "</label>"): "",
    }
    for i, (html, text) in enumerate(pages.items()):
        assert page_texts(spark, [(f"http://h{i}.example/", html)]) == [text], html


def test_long_pages_ties_and_repeated_rows(spark):
    """A page of two megabytes whole; of two paths with as many votes and equal scores the last; copies alike."""
    long = " ".join(f"<p>{sentences(4, f'w{i}')}</p>" for i in range(12_000))
    one, two = f"<div class=a><p>{sentences(5, 'x')}</p></div>", f"<div class=b><p>{sentences(5, 'x')}</p></div>"
    pages = [("http://long.example/", f"<body><article>{long}</article></body>")]
    pages += [("http://tie.example/", f"<body>{x}</body>") for x in (one, two, one, two)]
    texts = page_texts(spark, pages)
    assert texts[0] == " ".join(sentences(4, f"w{i}") for i in range(12_000)) and len(texts[0]) > 10**6
    assert texts[1:] == [sentences(5, "x")] * 4


def plain_ranking(x, good, seed=7):
    """Bradley-Terry by plain gradient steps over the same pairs: centre, scale, weights and threshold."""
    centre, scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    z = np.clip((x - centre) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    better, worse = [i for i, g in enumerate(good) if g], [i for i, g in enumerate(good) if not g]
    one = [i for i in better for _ in range(pairwise_quality.RIVALS)] + list(rng.choice(better, len(worse) * pairwise_quality.RIVALS))
    two = list(rng.choice(worse, len(better) * pairwise_quality.RIVALS)) + [i for i in worse for _ in range(pairwise_quality.RIVALS)]
    d = z[one] - z[two]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    rate = 1 / (np.linalg.norm(d, 2) ** 2 / len(d) / 4 + pairwise_quality.PENALTY)
    for _ in range(40_000):
        at = w + 0.99 * speed
        slope = -(d / (1 + np.exp(d @ at))[:, None]).mean(axis=0) + pairwise_quality.PENALTY * at
        speed = 0.99 * speed - rate * slope
        w = w + speed
        if np.abs(slope).max() < 1e-12:
            break
    scores = z @ w
    cuts = np.quantile(scores, np.linspace(0.002, 0.998, 499))
    rate_of = [sum(s < c for s in scores[good]) / good.sum() + sum(s >= c for s in scores[~good]) / (~good).sum() for c in cuts]
    least = [c for c, r in zip(cuts, rate_of) if r <= min(rate_of) + 1e-12]
    return centre, scale, w, least[len(least) // 2]


def test_quality_is_that_of_a_plain_fit(spark, sf_dir):
    """The query's scores against a plain fit on all labelled documents that are not held out."""
    import zlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()}
    ids = sorted(i for i in labels if i in texts and zlib.crc32(str(i).encode()) % 5)
    measured = {i: pairwise_quality.features((t or "").encode()) for i, t in texts.items()}
    x, good = np.array([measured[i] for i in ids]), np.array([labels[i] == 1 for i in ids])
    # The fit takes its rows by id, then class; pairs are drawn by position.
    centre, scale, w, threshold = plain_ranking(x, good)
    ranker = pairwise_quality.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert np.abs(ranker.weights - w).max() < 1e-4 and abs(ranker.threshold - threshold) < 1e-3
    found = {r["doc_id"]: r for r in queries.op9_quality_classifier(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for i, row in found.items():
        s = np.clip((measured[i] - centre) / scale, -8, 8) @ w - threshold
        plain = 1 / (1 + np.exp(-(s + np.log(0.3 / 0.7))))
        assert abs(row["score"] - plain) < 2e-3 and row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.3)


def test_quality_of_a_very_long_text(spark, sf_dir):
    long = " ".join(f"word{i % 5000} of a sentence that goes on." for i in range(60_000))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranker = pairwise_quality.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    frame = spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string")
    scores = [r["score"] for r in pairwise_quality.score(frame, ranker).collect()]
    assert scores == [float(ranker.scores(pairwise_quality.features(long.encode())[None])[0])] * 2
