"""Decontamination, license scan, HTML text and fingerprints."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import decontaminate, fingerprint, html, licenses
from quarry.llm.textops import string_buffers
from tests.llm.cases import DOCS, edge_docs, edge_rows, no_docs, words

import pyarrow as pa

ITEM = ("A train leaves the station with 240 people and travels 60 km towards Boston. After 60 km the driver Alice counts 240 people again. "
        "How many people did Alice count in total before the train came to Boston?")


def _bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def _docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_verbatim_reparameterised_and_inconsistent_questions(spark):
    changed = ITEM.replace("240", "511").replace("60 km", "85 miles").replace("Alice", "Mary Ann").replace("Boston", "Paris")
    mixed = ITEM.replace("240", "511", 1).replace("60 km", "85 miles", 1).replace("Alice", "Bob", 1)
    docs = _docs(spark, words(1, 80) + ".\n" + ITEM + "\n" + words(2, 30), words(3, 10) + ". " + changed, words(4, 10) + "\n" + mixed,
                 words(5, 300), "How many people did they count in total before noon?", None, "")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs, _bench(spark, ITEM, words(99, 40))).collect()}
    assert set(got) == {(0, 0), (1, 0)}
    assert not got[0, 0].reparameterised and got[0, 0].coverage == 1.0 and got[0, 0].first_token == 80
    assert got[1, 0].reparameterised and got[1, 0].coverage > 0.9


def test_names_that_open_a_sentence_and_values_with_two_roles(spark):
    bench = _bench(spark, "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have?",
                   "A basket on the old table holds 3 apples and 3 pears which were picked early this morning by the farmer",
                   "Yesterday the painter Émile walked from the big house to Marie Curie before the rain and Émile sang while Marie Curie slept")
    docs = _docs(spark, "Ann has 7 apples. Ann buys 9 more. How many apples does Ann have?",
                 words(1, 30) + "\nA basket on the old table holds 4 apples and 7 pears which were picked early this morning by the farmer",
                 "yesterday the painter émile walked from the big house to marie curie before the rain and émile sang while marie curie slept",
                 "Yesterday the painter\nOlga walked from the big house\nto Ödön before the rain and\nOlga sang while Ödön\nslept",
                 "YESTERDAY THE PAINTER ÉMILE WALKED FROM THE BIG HOUSE TO MARIE CURIE", words(2, 90))
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 2), (4, 2)}
    assert got[0, 0].coverage == 1.0 and got[2, 2].coverage == 1.0
    assert {k: r.reparameterised for k, r in got.items()} == {(0, 0): True, (1, 1): True, (2, 2): False, (3, 2): True, (4, 2): False}


def test_items_with_few_literals_or_without_spaces(spark):
    zh = "小明有五个苹果，他又买了三个苹果。请问小明现在一共有多少个苹果？"
    th = "แดงมีแอปเปิ้ลห้าลูกและซื้ออีกสามลูก"
    bench = _bench(spark, "Compute 12 + 34 - 5 * 6 + 78 / 9", zh, th, "Sum 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", "12 + 34", "谁？", "明日は晴れ")
    docs = _docs(spark, words(1, 30) + " Compute 12 + 34 - 5 * 6 + 78 / 9 " + words(2, 9), "前言。" + zh + "后记，" + zh[:5], words(3, 5) + " " + th + "ครับ",
                 "sum 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 of them", "Sum 2 1 4 3 6 5 8 7 10 9 12 11 14 13 16 15", "so\n12 + 34\nand",
                 "room 12 34 is free", "他说：谁？我说谁都好。", "Compute 13 + 35 - 6 * 7 + 79 / 8", "きっと明日は晴れるよ", "小明有很多书，他又看了几本书。" * 3)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (5, 4), (7, 5), (9, 6)}
    assert all(r.coverage == 1.0 and not r.reparameterised for r in got.values())


def test_near_copies_with_added_and_dropped_words(spark):
    long, short, tiny = words(60, 59).split(), words(61, 20).split(), words(62, 13).split()
    bench = _bench(spark, *(" ".join(x) for x in (long, short, tiny)))
    docs = _docs(spark, " ".join([words(1, 30), *long[:20], "new", *long[20:40], "new", *long[40:], words(2, 9)]),
                 " ".join([words(3, 30), *short[:10], "new", *short[10:]]), " ".join([*tiny[:6], "new", *tiny[6:], words(4, 30)]),
                 " ".join([*long[:20], *long[21:40], *long[41:]]), " ".join([*short[:9], words(5, 200), *short[11:18]]),
                 " ".join(["ha"] * 12))
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 0)}
    assert got[0, 0].windows == 38 and got[0, 0].first_token == 30
    # an item that repeats itself is not found by one of its windows
    assert decontaminate.contamination(docs, _bench(spark, "ha " * 200)).collect() == []


def test_partial_short_and_common_lines(spark):
    item, line = words(7, 40), words(8, 9)
    bench = _bench(spark, item, line + " " + words(9, 40), "only five words right here", "two words", None)
    docs = _docs(spark, words(1, 50) + " " + " ".join(item.split()[:26]) + " " + words(2, 50), words(3, 30) + "\n" + line + "\n" + words(4, 30),
                 "they had only five words right here, then", " ".join(item.split()[:14]))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {(0, 0), (2, 2)}


def test_decontamination_equals_brute_force_on_plain_text(spark):
    items = [words(50 + i, 12 + 4 * i) for i in range(5)]
    texts = [" ".join([words(i, 20), items[i % 5] if i % 2 else words(700 + i, 30), words(900 + i, 5)]) for i in range(40)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(_docs(spark, *texts).repartition(4), _bench(spark, *items)).collect()}
    assert got == {(i, i % 5) for i in range(40) if i % 2}


def test_decontamination_in_edge_cases(spark):
    docs = edge_docs(spark, clashing=True)
    bench = spark.createDataFrame([(1, words(2, 60)), (1, words(2, 60)), (None, words(1, 120)), (3, None), (4, "")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontaminate.contamination(docs, bench).collect()) == [40, 43]
    assert decontaminate.contamination(docs, bench.limit(0)).collect() == []
    assert decontaminate.contamination(no_docs(spark), bench).collect() == []


def test_license_spans_and_coverage(spark):
    mit = licenses.TEMPLATES["MIT notice"]
    edited = mit.replace("free of charge, ", "").replace("modify, merge,", "modify and merge,")
    docs = _docs(spark, words(1, 30) + "\nReleased under the MIT License.\n" + words(2, 10), words(3, 7) + "\n" + edited + "\n" + words(4, 9),
                 "licensed under the Apache license, version 2.0!", words(5, 100), " ".join(mit.split()[:20]),
                 "Released under the MIT License. Released under the MIT License.", None, "")
    got = sorted(licenses.scan_licenses(docs).collect(), key=lambda r: (r.doc_id, r.license, r.first_word))
    assert [(r.doc_id, r.license) for r in got] == [(0, "MIT"), (1, "MIT notice"), (2, "Apache-2.0"), (5, "MIT"), (5, "MIT")]
    assert (got[0].first_word, got[0].end_word, got[0].coverage) == (30, 35, 1.0)
    assert got[1].first_word == 7 and 0.9 < got[1].coverage < 1.0
    assert [(r.first_word, r.end_word) for r in got[3:]] == [(0, 5), (5, 10)]


def test_short_licenses_by_name_and_version(spark):
    found = ["Released under an MIT License", "licensed under the apache licence, version 2.0", "Licensed under CC BY NC 4.0",
             "This book is licensed under the GNU General Public License v3.0", "mit wem mit Released under a GPL License. Released under an MIT License mit",
             "This work is licensed under the Creative Commons Attribution 4.0 International License"]
    other = ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             "This work is licensed under a Creative Commons Attribution Share Alike 4.0 International License", "Released under the BSD License",
             "Licensed under the Apache License, Version 1.1", "This work is licensed under the GNU Lesser General Public License, version 3",
             "This work is licensed under the GNU General Public License, version 2", "er kam mit der Bahn " * 50]
    got = [(r.doc_id, r.license) for r in licenses.scan_licenses(_docs(spark, *found, *other)).collect()]
    assert sorted(got) == [(0, "MIT"), (1, "Apache-2.0"), (2, "CC-BY-NC-4.0"), (3, "GPL-3.0"), (4, "MIT"), (5, "CC-BY-4.0")]


def brute_align(template, text):
    """Best matched words over all local alignments, without a band."""
    best = [[(0, 0)] * (len(text) + 1) for _ in range(len(template) + 1)]
    top = (0, 0)
    for i in range(1, len(template) + 1):
        for j in range(1, len(text) + 1):
            same = template[i - 1] == text[j - 1]
            steps = [(0, 0), (best[i - 1][j - 1][0] + (2 if same else -1), best[i - 1][j - 1][1] + same),
                     (best[i - 1][j][0] - 1, best[i - 1][j][1]), (best[i][j - 1][0] - 1, best[i][j - 1][1])]
            best[i][j] = max(steps)
            top = max(top, best[i][j])
    return top[1]


def test_banded_alignment_equals_full_alignment():
    rng = np.random.default_rng(1)
    for _ in range(40):
        template = rng.integers(0, 30, 25)
        text = list(template)
        for _ in range(4):
            at = rng.integers(0, len(text))
            text[at:at + 1] = [] if rng.random() < 0.5 else [text[at], 99]
        text = np.concatenate((rng.integers(100, 200, 6), text, rng.integers(100, 200, 6)))
        assert licenses.align(template, text, 6)[0] == brute_align(list(template), list(text))


def test_licenses_in_edge_cases(spark):
    assert licenses.scan_licenses(edge_docs(spark, clashing=True)).collect() == []
    assert licenses.scan_licenses(no_docs(spark)).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header class="entry-header"><h1>Head &amp; line</h1></header><!-- ad --><p>First   <b>bold</b>
text.<br>More&nbsp;words<p>Second &lt;p&gt; &#233;<div class="ad">Buy</div><form><input value=1>Name</form><ul><li>x<li>y</ul>
<section id="comments"><p>Nice post</p></section><aside>Side</aside></article>
<div class="sidebar">Links</div><footer>&copy; x</footer></body></html>"""


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, text string, low string")


def test_main_text_of_one_page(spark):
    got = html.main_text(_pages(spark, [(1, "http://h/", PAGE, "z", "z", "z"), (2, None, None, None, None, None), (3, "x", "", "", "", ""),
                                        (4, "http://h/", "plain &amp; text", "", "", ""), (5, "http://h/", "<p>unclosed <b>one<p>two", "", "", ""),
                                        (5, "http://h/", "<p>unclosed <b>one<p>two", "", "", "")])).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == 6
    assert by[1] == "Head & line\nFirst bold text. More words\nSecond <p> é\nx\ny"
    assert (by[2], by[3], by[4], by[5]) == ("", "", "plain & text", "unclosed one\ntwo")
    assert html.main_text(_pages(spark, [])).collect() == []


def _text(page):
    return "\n".join(b.text for b in html.taken(html.parse(page)[0]))


def test_only_whole_attributes_count():
    assert _text("<article style='overflow:hidden' title=\"Hidden gems\"><p data-id='ad' data-role=\"search\">Kept</p>"
                 "<p data-text=\"class='ad' hidden\" data-hidden>Also</p><p hidden>A</p><p HIDDEN=''>B</p><p title='x'hidden>C</p>"
                 "<p aria-hidden=true>D</p><p aria-hidden='false'>E</p><p class = ad>F</p></article>") == "Kept\nAlso\nE"
    assert _text("<p>Out</p><div data-role='main'><p>In</p></div>") == "Out\nIn"
    assert _text("<p>Out</p><div class=x role='main'><p>In</p></div>") == "In"


def test_style_tree_removes_what_a_host_repeats(spark):
    def page(i, host):
        return (i, f"http://{host}/p{i}", f"<body><div class='strip'><p>Welcome to our site</p><p>Call us now</p></div>"
                f"<div class='story{i}'><p>{words(i, 30)}</p><p>The same line</p></div></body>", "", "", "")
    rows = [page(i, "big.example") for i in range(40)] + [page(100, "tiny.example")]
    got = {r.page_id: r.text for r in html.main_text(_pages(spark, rows)).collect()}
    assert all(got[i] == f"{words(i, 30)}\nThe same line" for i in range(40))
    assert got[100].startswith("Welcome")  # one page gives no evidence


def test_heading_slugs_and_compound_names():
    body = ("<section id='related-work'><h2 id='social-history'>A</h2></section><section id='search-algorithms'><h2 id='search'>B</h2></section>"
            "<p class='share-price'>C</p><div class='big comment-syntax'>D</div><h2 class='post-header'>E</h2>")
    ads = ("<div class='ad-slot ad-300x250'>x</div><div class='share-buttons'>x</div><div class='widget_2'>x</div><div class='post-share'>x</div>"
           "<div role='search'>x</div><div id='comments'>x</div><ul class='related-posts'><li>x</ul>")
    assert _text(f"<article>{body}{ads}</article>") == _text(f"<div>{body}{ads}</div>") == "A\nB\nC\nD\nE"


def test_copies_of_a_page_are_one_page_of_evidence(spark):
    def page(i, host, text, date=""):
        return (i, f"http://{host}/p{i}", f"<body><div class='story'><p>{text}</p><div>{text[:20]}</div>{date}</div></body>", "", "", "")
    def framed(i, text):
        return (i, f"http://frame/p{i}", f"<body><div class='strip'><p>Welcome</p></div><article><div>{text}</div></article><div class='s{i}'></div></body>", "", "", "")
    texts = [words(300 + i, 30) for i in range(12)]
    rows = [page(i, "one", texts[0], f"<p>{i}.5.2020</p>") for i in range(10)] + [page(100 + i, "two", texts[i % 2]) for i in range(200)]
    rows += [framed(1000 + i, texts[i % 2]) for i in range(60)]
    strip = "<div class='strip'><p>Welcome to us</p></div>"
    rows += [(2000 + i, "http://many/", f"<body>{strip}<div class='story'><p>{texts[i % 12]}</p></div></body>", "", "", "") for i in range(240)]
    rows += [(3000, "http://many/", f"<body>{strip}</body>", "", "", "")]
    got = {r.page_id: r.text for r in html.main_text(_pages(spark, rows)).collect()}
    assert all(got[i].startswith(texts[0]) for i in range(10)) and all(got[100 + i].startswith(texts[i % 2]) for i in range(200))
    assert all(got[1000 + i] == texts[i % 2] for i in range(60))
    assert all(got[2000 + i] == texts[i % 12] for i in range(240))  # what frames 12 distinct texts still goes
    assert got[3000] == "Welcome to us"


def test_importance_is_the_entropy_formula(spark):
    # 4 pages: one style everywhere; texts a on all, b on two pages, c and d on one
    rows = [("h", 1, True, 9)] * 4 + [("h", 1, False, 1)] * 4 + [("h", 1, False, 2)] * 2 + [("h", 1, False, 3), ("h", 1, False, 4)]
    got = html.node_importance(spark.createDataFrame(rows, "host string, path bigint, style boolean, feature bigint")).first()
    content = 1 - (np.log(4) + np.log(2)) / 4 / np.log(4)
    assert got.pages == 4 and abs(got.importance - html.CONTENT_WEIGHT * content) < 1e-12


def _vectors(*texts):
    return fingerprint.vectors(*string_buffers(pa.array(texts, pa.string())))


def test_fingerprints_are_homomorphic_multisets():
    a, b, c = words(1, 20), words(2, 33), words(3, 2)
    v = _vectors(f"{a}\n{b}\n{c}", f"{c}\n\n{a}\n{b}", f"{a}\n{b}", c, f"{a}\n{a}\n{b}", None, "", "\n\n")
    assert (v[0] == v[1]).all() and not (v[0] == v[4]).all()
    assert (fingerprint.combine(v[2:3], v[3:4])[0] == v[0]).all()  # insertion
    assert (fingerprint.combine(v[0:1], v[3:4], -1)[0] == v[2]).all()  # deletion
    assert not v[5:].any()
    near = fingerprint.likeness(v[[0, 0, 5, 0]], v[[1, 3, 6, 5]])
    assert near[0] == 1 and near[1] < 0.5 and near[2] == 1 and near[3] == 0


def test_likeness_of_long_repetitive_texts():
    """Sums above 2**15 in one lane; beside the cosine over the run counts themselves."""
    texts = ["ha " * n for n in (20_000, 32_000, 40_000, 70_000, 100_000)]
    v = _vectors(*texts)
    for i in range(len(texts)):
        near = fingerprint.likeness(v[[i] * len(texts)], v)
        assert near.min() > 0.999 and near[i] == 1
    other = _vectors("ho " * 40_000 + words(3, 4000))
    assert fingerprint.likeness(v[2:3], other)[0] < 0.5


def test_edited_texts_and_successors_equal_brute_force(spark):
    docs = edge_docs(spark, clashing=True).repartition(6)
    rows = sorted(((r[0], r[1] or "") for r in edge_rows()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (k, t) in enumerate(rows):
        n, following = len(t) // 3, rows[(i + 1) % len(rows)][1]
        want.append((k, len(t), hashlib.sha256((t[:len(t) - n] + following[:n]).encode()).hexdigest()))
    got = fingerprint.edited_fingerprints(docs).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r.fingerprint for r in got}
    assert by[10] == by[13] != by[16]
    assert fingerprint.edited_fingerprints(no_docs(spark)).collect() == []
    single = spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")
    assert fingerprint.edited_fingerprints(single).first().edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_successors_over_many_ranges(spark):
    keys = [(i * 37) % 1009 - 500 for i in range(900)]
    docs = spark.createDataFrame([(k, f"t{k}") for k in keys], "doc_id bigint, text string").repartition(9)
    ordered = sorted(keys, reverse=True)
    got = {r.doc_id: r.next_text for r in fingerprint.with_next(docs).collect()}
    assert got == {k: f"t{ordered[(i + 1) % len(ordered)]}" for i, k in enumerate(ordered)}


def test_successors_where_one_key_fills_many_ranges(spark):
    rows = [(None, f"n{i}") for i in range(1500)] + [(7, f"s{i}") for i in range(1500)] + [(i, f"t{i}") for i in range(100, 1100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    linked = fingerprint.with_next(docs)
    got = linked.collect()
    assert sorted(map(str, [(r.doc_id, r.text) for r in got])) == sorted(map(str, rows))
    # one cycle over all texts, keys descending along it and null last
    after, key = {r.text: r.next_text for r in got}, {t: (k is None, -(k or 0)) for k, t in rows}
    walk = ["t1099"]
    while after[walk[-1]] != "t1099" and len(walk) <= len(rows):
        walk.append(after[walk[-1]])
    assert len(walk) == len(rows) and [key[t] for t in walk] == sorted(key.values())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sizes = [r["count"] for r in fingerprint.with_next(docs).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) <= 2.5 * len(rows) / n


def test_fingerprint_column_keeps_the_others(spark):
    got = fingerprint.fingerprints(edge_docs(spark, clashing=True))
    assert got.columns[-1] == "fingerprint" and got.count() == len(edge_rows())
