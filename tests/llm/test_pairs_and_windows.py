"""Near-duplicates and substring dedup against brute force."""

import re

import pytest

from quarry.llm import neardup, substrings
from quarry.llm.components import components
from tests.llm.cases import DOCS, edge_docs, edge_rows, no_docs, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_spans(rows, window):
    """{key: set of removed word positions}, one text per key."""
    texts = {k: WORD.findall(t or "") for k, t in rows if k is not None}
    first, gone = {}, {k: set() for k in texts}
    for k in sorted(texts):
        for i in range(len(texts[k]) - window + 1):
            w = tuple(texts[k][i:i + window])
            if w in first:
                gone[k].update(range(i, i + window))
            else:
                first[w] = k
    return texts, gone


def check_repeats(df, rows, window):
    texts, gone = brute_spans(rows, window)
    got = substrings.remove_repeats(df, window=window).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        kept = [w for i, w in enumerate(texts[r.doc_id]) if i not in gone[r.doc_id]]
        assert (r.n_words, r.n_removed, r.kept_text) == (len(texts[r.doc_id]), len(gone[r.doc_id]), " ".join(kept))


@pytest.mark.parametrize("window", [8, 20])
def test_repeated_windows_equal_brute_force(spark, window):
    rows = []
    passages = [words(100 + i, 20 + 3 * i) for i in range(6)]
    for i in range(60):
        parts = [words(i, 15 + i % 40), passages[i % 6] if i % 3 else passages[(i + 1) % 6][:90], words(1000 + i, i % 25)]
        rows.append((i * 7 % 61, "\n".join(parts)))
    rows += [(100, "a b c d " * 40), (101, "a b c d " * 11 + "e"), (102, passages[5]), (103, passages[5])]
    check_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows, window)


def test_repeats_in_edge_cases(spark):
    rows = [r[:2] for r in edge_rows()]
    check_repeats(edge_docs(spark, clashing=True), rows, 20)
    assert substrings.remove_repeats(no_docs(spark)).collect() == []


def test_cut_keeps_layout_columns_and_untouched_texts(spark):
    docs = edge_docs(spark, clashing=True)
    got = substrings.cut_repeats(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    source = {r.doc_id: r for r in docs.collect() if r.doc_id is not None}
    assert by[19].text is None and by[22].text == "" and by[25].text == source[25].text
    assert by[10].text == source[10].text and by[10].spans == "z"
    assert 13 not in by  # a whole copy loses every word
    assert by[40].text.count("\n") == 2  # the earlier passage stays with its line breaks
    assert by[43].text == " ".join(source[43].text.split(" ")[60:])
    assert sum(r.doc_id is None for r in rows) == 2


def brute_components(rows, size, percent):
    def shingles(t):
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    sets = {k: shingles(t) for k, t in rows if k is not None}
    label = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b]))
             and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sets, label


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    import random
    rng = random.Random(size)
    rows, key = [], 1000
    for g in range(12):
        base = words(g, rng.choice([4, 12, 40, 150, 400])).split()
        for _ in range(rng.choice([1, 2, 5, 30])):
            edited = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((key := key - rng.randrange(1, 4), " ".join(edited)))
    rows += [(5000, "a b"), (5001, "A B"), (5002, "a"), (5003, "a b c")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6),
                                  neardup.Likeness(size, percent)).collect()
    sets, label = brute_components(rows, size, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {k: (len(sets[k]), label[k]) for k in sets}


def test_near_duplicates_in_edge_cases(spark):
    rows = [r[:2] for r in edge_rows()]
    got = neardup.near_duplicates(edge_docs(spark, clashing=True), neardup.Likeness(3, 85)).collect()
    sets, label = brute_components(rows, 3, 85)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id])
    assert neardup.near_duplicates(no_docs(spark)).collect() == []


def test_components_of_a_long_path_and_no_edges(spark):
    path = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (200, 150), (300, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
