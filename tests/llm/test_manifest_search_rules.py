"""Merkle manifest, ranked search and quality rules against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import manifest, rules, search
from tests.conftest import SMOKE
from tests.llm.cases import DOCS, edge_docs, edge_rows, no_docs, words

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- manifest

def _leaf(row) -> str:
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def _tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """Root and per node its (before, after) siblings level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for w, a in zip(ways, at):
            run, k = runs[a // 16], a % 16
            w.append((run[:k], run[k + 1:]))
        at = [a // 16 for a in at]
        nodes = [H("".join(r)) for r in runs]
    return nodes[0], ways


def brute_manifest(rows: list[tuple]) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[g] = _tree([_leaf(r) for r in groups[g]])
    root, tops = _tree([trees[g][0] for g in names]) if names else ("", [])
    out = []
    for g, top in zip(names, tops):
        for r, way in zip(groups[g], trees[g][1]):
            steps = way + top
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                now = (r[0], r[1].translate(LOWER), *r[2:])
            fold = _leaf(now)
            for before, after in steps:
                fold = H("".join(before) + fold + "".join(after))
            proof = H("".join("".join(b) + "".join(a) for b, a in steps))
            out.append((r[0], _leaf(r), trees[g][0], root, proof, fold, fold == root))
    return out


def _got(df) -> list[tuple]:
    return [tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


_order = lambda rows: sorted(rows, key=str)


@pytest.mark.parametrize("clashing", [False, True])
def test_manifest_of_edge_rows(spark, clashing):
    assert _order(_got(manifest.tampered_documents(edge_docs(spark, clashing)))) == _order(brute_manifest(edge_rows()))


def test_manifest_of_a_hot_source_and_lone_sources(spark):
    rng = random.Random(3)
    rows = [(i if i % 50 else i % 100, f"Text {i} " + "A" * (i % 7), "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(700)]
    rows += [(1000 + i, words(i, 5), None, f"lone{i}", 1) for i in range(300)] + [(5, "same", "en", "hot", 4)] * 40
    rng.shuffle(rows)
    got = _got(manifest.tampered_documents(spark.createDataFrame(rows, DOCS).repartition(5)))
    assert _order(got) == _order(brute_manifest(rows))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(spark, n):
    rows = [(i, f"T{i}", "en", "a", i) for i in range(n)]
    assert _order(_got(manifest.tampered_documents(spark.createDataFrame(rows, DOCS)))) == _order(brute_manifest(rows))


def test_manifest_of_no_rows(spark):
    assert manifest.tampered_documents(no_docs(spark)).count() == 0


def test_equal_rows_are_spread_over_tasks(spark):
    rows = spark.range(4000).selectExpr("'=hot' AS g", "1L AS key", "'x' AS digest")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # it joins partitions as small as these
    spark.conf.set(key, "false")
    try:
        placed = manifest.placed(rows, [rows["key"], rows["digest"]], "hot")
    finally:
        spark.conf.unset(key)
    assert sorted(r.pos for r in placed.select("pos").collect()) == list(range(4000))
    assert placed.groupBy().agg({"n": "max"}).first()[0] == 4000 and len(placed.inputFiles()) >= 6


# ---------------------------------------------------------------- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n = sum(1 for t in terms if t)
    total = sum(sum(t.values()) for t in terms)
    df = Counter(w for t in terms for w in t)
    asked: dict = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, query in asked.items():
        scored = []
        for (doc, _), t in zip(docs, terms):
            m = 25 + (75 * sum(t.values()) * n) // total if total else 0
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * t[w]) // (1000 * t[w] + 8 * m))
                        for w, q in query.items() if w in t)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def _search(spark, docs, items, **how) -> list[tuple]:
    found = search.ranked_search(spark.createDataFrame(docs, "doc_id bigint, text string, n long, score long").repartition(4),
                                 spark.createDataFrame(items, "item_id bigint, text string"), **how)
    return sorted((tuple(r) for r in found.collect()), key=str)


def _corpus(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    pick = lambda k: " ".join(f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(k))
    return [(i, pick(rng.choice((3, 30, 200)))) for i in range(n)]


@pytest.mark.parametrize("block_terms", [search.BLOCK_TERMS, 40])
def test_search_is_brute_force(spark, monkeypatch, block_terms):
    docs = _corpus(1, 900)
    docs += [(5000 + i, docs[7][1]) for i in range(60)] + [(9, "w1 w1 W1"), (9, "w1 w1 W1"), (None, docs[3][1]), (77_000, None), (77_001, ""), (77_002, "-- !")]
    items = [(i, docs[11 * i][1]) for i in range(20)] + [(50, None), (51, "nowhere"), (52, "w1 w1 w2"), (52, "w3"), (None, docs[3][1]), (53, docs[7][1]), (53, docs[7][1])]
    got = _search(spark, [(*d, 1, 2) for d in docs], items, block_terms=block_terms)
    assert got == brute_search(docs, items)


def test_small_spans_and_shards_skip_nothing(monkeypatch):
    """The hybrid alone, with many spans and both kinds of lists."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(search, "SPAN", 16)
    n, size = 3000, 60
    held = rng.random((n, size)) < (rng.random(size) ** 4)[None, :]
    of, term = np.nonzero(held)
    impact = rng.integers(1, 10_000, len(of))
    full = np.zeros((n, size), dtype=np.int64)
    full[of, term] = impact
    for trial in range(30):
        terms = rng.choice(size, rng.integers(1, 20), replace=False)
        repeats = rng.integers(1, 4, len(terms))
        best = search.Best(10)
        for a in range(0, n, 1000):
            mine = (of >= a) & (of < a + 1000)
            shard = search.Shard(np.arange(a, a + 1000), np.zeros(1000, np.int8), of[mine] - a, term[mine], impact[mine], size)
            search.rank_in_shard(shard, terms, repeats, best)
        score = full[:, terms] @ repeats
        order = np.lexsort((np.arange(n), -score))[:10]
        order = order[score[order] > 0]
        assert best.rows["doc"].tolist() == order.tolist() and best.rows["score"].tolist() == score[order].tolist()


def test_search_without_rows(spark):
    assert _search(spark, [], [(1, "a")]) == [] and _search(spark, [(1, "a", 0, 0)], []) == []


def test_search_of_long_and_odd_texts(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    items = [(1, "日本語 текст"), (2, "ha w7 two"), (3, "x" * 200_000), (4, words(2, 60))]
    assert _search(spark, [(*d, 0, 0) for d in docs], items) == brute_search(docs, items)


# ---------------------------------------------------------------- rules

def brute_base(text: str | None) -> tuple:
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def _texts() -> list[str | None]:
    rng = random.Random(4)
    prose = lambda k: " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(words(k, 120, 3000).split()))
    junk = [lambda k: prose(k).replace(" ", "&&& "), lambda k: prose(k).upper().replace(" ", "!! "), lambda k: prose(k).replace(" ", " | ").replace(".", "")]
    out = [r[1] for r in edge_rows()] + [prose(i) for i in range(300)] + [junk[i % 3](i) for i in range(60)]
    out += ["\n".join([prose(1)[:40], "  ", prose(1)[:40], "a b", " a b", "a b"] * rng.randint(1, 3)) for _ in range(5)]
    return out


def test_rules_base_measures_and_verdicts(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, kept string")
    found = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        r, base = found[i], brute_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)
    prose, junk = range(len(edge_rows()), len(edge_rows()) + 300), range(len(edge_rows()) + 300, len(edge_rows()) + 360)
    assert all(found[i].kept for i in prose) and not any(found[i].kept for i in junk)


def test_posterior_is_brute_force(spark):
    """The query's posterior against expectation-maximisation over single documents in plain Python."""
    table = rules.measure(spark.createDataFrame([(i, t) for i, t in enumerate(_texts())], "doc_id bigint, text string"))
    judged, model = rules.judge(table)
    rows = judged.select("doc_id", "posterior", *[(r.vote() - 1).alias(f"v{i}") for i, r in enumerate(rules.RULES)]).collect()
    votes = [list(r)[2:] for r in rows]
    share, accuracy = 0.8, [0.8] * len(rules.RULES)
    for _ in range(rules.ROUNDS):
        odds = [share / (1 - share) * math.prod((a / (1 - a)) ** v for a, v in zip(accuracy, vs)) for vs in votes]
        p = [o / (1 + o) for o in odds]
        share = min(max(sum(p) / len(p), 0.05), 0.95)
        for j in range(len(accuracy)):
            right = sum(q if vs[j] > 0 else 1 - q for q, vs in zip(p, votes) if vs[j])
            used = sum(1 for vs in votes if vs[j])
            prior = 0.001 * len(votes)
            accuracy[j] = min(max((right + 0.8 * prior) / (used + prior), rules.LEAST), rules.MOST)
    assert np.allclose(model.accuracy, accuracy, atol=1e-6)
    assert np.allclose([r.posterior for r in rows], p, atol=1e-6)


def test_estimate_does_not_depend_on_size():
    votes = np.array([[0, 0, 1], [2, 2, 1], [1, 2, 0], [0, 1, 0]])
    counts = np.array([3.0, 50.0, 4.0, 2.0])
    a, b = rules.estimate(votes, counts), rules.estimate(votes, counts * 1e9)
    assert np.allclose(a.accuracy, b.accuracy) and abs(a.share - b.share) < 1e-9


def test_rules_on_edge_rows_and_no_rows(spark):
    found = rules.quality_rules(edge_docs(spark, clashing=True))
    assert found.count() == len(edge_rows()) and rules.quality_rules(no_docs(spark)).count() == 0


def test_rules_follow_the_labels(spark):
    from quarry.llm.queries import op13_quality_rules
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet").select("doc_id", "quality")
    rows = op13_quality_rules(spark, SMOKE).join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert right >= 0.97 * len(rows)


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        rules.judge(rules.measure(no_docs(spark)), [rules.RULES[0]] * (rules.MAX_RULES + 1))
