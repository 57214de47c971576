"""Quality classifier and language identification."""

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language, quality, queries
from quarry.llm.textops import Words
from tests.conftest import SF01
from tests.llm.cases import edge_docs, edge_rows, no_docs


def test_quality_held_out_accuracy_and_contract(spark):
    got = queries.QUERIES["op2_quality"](spark, SF01)
    rows = got.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    assert got.count() == 1000
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_in_edge_cases(spark):
    labels = spark.createDataFrame([(10, 1), (10, 1), (16, 0), (None, 1), (19, None), (9999, 0)], "doc_id bigint, quality int")
    got = quality.score_quality(edge_docs(spark, clashing=True), labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    none = quality.score_quality(edge_docs(spark), labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert quality.score_quality(no_docs(spark), labels).collect() == []


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, quality.FEATURES))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 1)))
    y = (rng.random(4000) < p).astype(float)
    net = quality.fit_network(x, y)
    fresh = rng.normal(size=(4000, quality.FEATURES))
    truth = 1 / (1 + np.exp(-(2 * fresh[:, 0] - fresh[:, 1] + 1)))
    got = net.probabilities(fresh)
    assert np.corrcoef(got, truth)[0, 1] > 0.85
    assert abs(got.mean() - truth.mean()) < 0.05


def test_word_vectors_cover_all_batches(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma" if i % 2 else "beta alpha") for i in range(50)], "doc_id bigint, text string")
    one = quality.word_vectors(docs.coalesce(1))
    assert np.allclose(one, quality.word_vectors(docs.repartition(7)))
    index = quality.index_vectors().astype(float)
    text = np.frombuffer(b"alpha beta gamma", dtype=np.uint8)
    a, b, c = quality.tokens(text, np.array([0, len(text)]))[1]
    want = 50 * index[b] + 25 * index[c]  # neighbours of alpha: beta everywhere, gamma in half
    assert np.allclose(one[a], want / np.linalg.norm(want), atol=1e-6)


def test_a_long_text_is_pooled_like_its_whole(spark):
    """Texts of several blocks: neighbours across a block border count, and mean and spread are
    those of all tokens."""
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i)}x" for i in range(26)]
    texts = [" ".join(words[i] for i in rng.integers(0, 26, n)) for n in (quality.BLOCK - 1, 2 * quality.BLOCK + 3, 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    vectors = quality.word_vectors(docs)
    index, want = quality.index_vectors().astype(np.int64), np.zeros_like(vectors, dtype=np.float64)
    buckets = []
    for text in texts:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        b = quality.tokens(data, np.array([0, len(data)]))[1]
        buckets.append(b)
        for step in range(1, quality.REACH + 1):
            np.add.at(want, b[step:], index[b[:-step]])
            np.add.at(want, b[:-step], index[b[step:]])
    norms = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(vectors, want / np.maximum(norms, 1e-9), atol=1e-6)
    for r in quality.pooled(docs, vectors).collect():
        v = vectors[buckets[r.doc_id]].astype(np.float64)
        assert np.allclose(r.features[:64], np.concatenate((v.mean(axis=0), v.std(axis=0))), atol=1e-5)


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op3_language"](spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert got.count() == 1000
    assert np.mean([r.lang == r.lang_pred for r in rows if r.lang]) > 0.98


def _model(spark):
    en = "the quick brown fox jumps over the lazy dog and then the other animals of the wood were there with that thing "
    de = "der schnelle braune fuchs springt und die anderen tiere sind nicht auf dem feld weil sie schlafen wollen "
    ru = "быстрая лиса прыгает через ленивую собаку и потом другие звери леса были там с этой вещью "
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate([(en, "en"), (de, "de"), (ru, "ru")])]
    return language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")), en, de, ru


def test_spans_of_mixed_text_and_scripts(spark):
    model, en, de, ru = _model(spark)
    docs = spark.createDataFrame([(1, en + de), (2, "the fox " + ru), (3, "12 34 ... !!"), (4, None), (5, ""), (6, "— … 😀"), (7, "zzz")],
                                 "doc_id bigint, text string")
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    n_en, n_de = len(en.split()), len(de.split())
    assert [(s.first_word, s.end_word, s.lang) for s in got[1].spans] == [(0, n_en, "en"), (n_en, n_en + n_de, "de")]
    assert got[2].lang_pred == "ru" and [s.lang for s in got[2].spans] == ["en", "ru"]
    assert [got[i].lang_pred for i in (3, 4, 5, 6)] == ["und"] * 4 and got[4].score == 0
    assert got[7].lang_pred in ("en", "de")  # Latin letters close the Cyrillic language


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(3)
    lengths = [1, 0, 5, 7, 3]
    first = np.concatenate(([0], np.cumsum(lengths)))
    scores = rng.normal(size=(first[-1], 3)).astype(np.float32) * 3
    got = language.viterbi(scores, first, 2.0)
    import itertools
    for r, n in enumerate(lengths):
        if not n:
            continue
        s = scores[first[r]:first[r + 1]]
        best = max(itertools.product(range(3), repeat=n), key=lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:])))
        assert list(got[first[r]:first[r + 1]]) == list(best)


def test_language_in_edge_cases(spark):
    docs = edge_docs(spark, clashing=True)
    model = language.train(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(edge_rows()) and {r.lang_pred for r in got} <= {"en", "de", "und"}
    nothing = language.train(docs.where(F.lit(False)))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(no_docs(spark), model).collect() == []


def test_words_are_cut_at_row_borders_and_hashed_by_content():
    texts = ["ab cd", "", "cd x ab", "ab"]
    raw = [t.encode() for t in texts]
    w = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [w.text(i) for i in range(len(w.start))] == ["ab", "cd", "cd x", "ab", "ab"]
    assert list(w.row) == [0, 0, 2, 2, 3]
    assert w.hash[0] == w.hash[3] == w.hash[4] and len(set(w.hash.tolist())) == 3
