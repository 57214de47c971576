"""Vocabulary and whole-text encoding golden cases."""

from quarry.operators import text as txt


def test_vocab_order_and_ids(spark):
    docs = spark.createDataFrame([(1, "b a b, C!"), (2, "a b"), (3, ""), (4, None)], "idx long, sentence string")
    vocab = {r["word"]: (r["id"], r["count"]) for r in txt.build_vocab(docs).collect()}
    # counts: b=3, a=2, c=1 -> ids 4, 5, 6 (count desc, then word)
    assert vocab == {"b": (4, 3), "a": (5, 2), "c": (6, 1)}
    capped = {r["word"] for r in txt.build_vocab(docs, max_size=6).collect()}
    assert capped == {"b", "a"}


def _docs(spark):
    rows = [(1, "a b", 0), (2, "b zz a a a a a", 1), (3, "...", 0), (4, None, 1), (1, "b", 0)]
    return spark.createDataFrame(rows, "idx long, sentence string, label int")


def test_whole_texts_become_windows(spark):
    vocab = spark.createDataFrame([("a", 4, 5), ("b", 5, 3)], "word string, id int, count long")
    for shipped in (100, 1):  # the dictionary sent along, and the joined way beyond its limit
        enc = sorted((r["idx"], r["window"], list(r["input_ids"]), sum(r["attention_mask"]))
                     for r in txt.encode_text(_docs(spark), vocab, max_length=6, shipped=shipped).collect())
        assert enc == [(1, 0, [2, 4, 5, 3, 0, 0], 4), (1, 0, [2, 5, 3, 0, 0, 0], 3),  # a repeated key keeps its rows apart
                       (2, 0, [2, 5, 1, 4, 4, 3], 6), (2, 1, [2, 4, 4, 4, 3, 0], 5),
                       (3, 0, [2, 3, 0, 0, 0, 0], 2), (4, 0, [2, 3, 0, 0, 0, 0], 2)]
    train = txt.encode_text(_docs(spark), vocab, max_length=6, keep=("label",))
    assert set(train.columns) == {"label", "window", "input_ids", "attention_mask", "token_type_ids"}


def test_encoding_moves_no_tokens(spark):
    vocab = spark.createDataFrame([("a", 4, 5)], "word string, id int, count long")
    plan = txt.encode_text(_docs(spark), vocab, max_length=6)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_scores_use_all_windows(spark):
    docs = spark.createDataFrame([(1, "x " * 9 + "good good good", 1), (2, "x " * 9 + "bad bad bad", 0)], "idx long, sentence string, label int")
    vocab = txt.build_vocab(docs)
    enc = txt.encode_text(docs, vocab, max_length=6, keep=("idx", "label"))
    stats = txt.fit_token_counts(enc)
    assert {(r["label"], r["count"]) for r in stats.where("id = -1").collect()} == {(0, 1), (1, 1)}
    got = {r["idx"]: r["pred"] for r in txt.score_bag_of_ids(enc, stats, [0, 1], id_space=vocab.count() + 4).collect()}
    assert got == {1: 1, 2: 0}  # the deciding words stand in the last window


def test_scores_beyond_the_shipped_figures(spark):
    rows = [(1, "x " * 9 + "good good good", 1), (2, "x " * 9 + "bad bad bad", 0), (3, "", 1), (4, "bad good " * 7, 0), (None, "good", 1)]
    docs = spark.createDataFrame(rows, "idx long, sentence string, label int")
    vocab = txt.build_vocab(docs.where("idx < 3"))
    enc = txt.encode_text(docs, vocab, max_length=6, keep=("idx", "label"))
    stats = txt.fit_token_counts(enc)
    space = vocab.count() + 4
    sent, joined = (sorted(((r["idx"] or 0, r["label"], r["pred"], [round(x, 9) for x in r["scores"]])
                            for r in txt.score_bag_of_ids(enc, stats, [0, 1], space, keep=["label"], shipped=n).collect()))
                    for n in (2 * space, 2 * space - 1))
    assert sent == joined and len(joined) == 5


def test_words_scored_in_one_pass(spark):
    """Sent and joined figures agree with each other and with plain Python, losses included."""
    import math
    from collections import Counter
    rows = [(1, "x " * 9 + "good good good", 1), (2, "x " * 9 + "Bad bad bad", 0), (3, "", 1), (4, "bad good " * 7, 0), (None, "good", 1),
            (1, "new words only", None), (7, None, 0), (8, "good", 5)]
    docs = spark.createDataFrame(rows, "idx long, sentence string, label int").repartition(3)
    train, space = [r for r in rows if r[0] and r[0] < 5 and r[2] is not None], 11
    model = txt.fit_words(spark.createDataFrame(train, docs.schema), space)
    assert model.classes == [0, 1]
    count = {c: Counter(w for r in train if r[2] == c for w in (r[1] or "").lower().split()) for c in (0, 1)}

    def brute(text):
        ws = (text or "").lower().split()
        return [math.log(sum(r[2] == c for r in train) / len(train)) + sum(math.log(count[c][w] + 1) for w in ws)
                - len(ws) * math.log(sum(count[c].values()) + space) for c in (0, 1)]

    expected = []
    for idx, text, label in rows:
        sc = brute(text)
        top = math.log(sum(math.exp(x - max(sc)) for x in sc)) + max(sc)
        expected.append((idx, label, int(sc[1] > sc[0]), None if label not in (0, 1) else round(top - sc[label], 9)))
    for shipped in (1000, 0):
        got = txt.score_words(docs, model, label="label", shipped=shipped).collect()
        assert sorted(((r["idx"], r["label"], r["pred"], None if r["loss"] is None else round(r["loss"], 9)) for r in got), key=str) == sorted(expected, key=str)


def test_rare_words_are_joined_per_row(spark):
    """A dictionary of any size gives the same windows."""
    import random
    rng = random.Random(2)
    name = lambda n: "".join("abcdefghij"[int(d)] for d in str(n))
    docs = spark.createDataFrame([(i, " ".join(name(int(rng.paretovariate(0.7)) % 3000) for _ in range(rng.choice((0, 5, 90))))) for i in range(200)],
                                 "idx long, sentence string").repartition(5)
    vocab = txt.build_vocab(docs).where("id % 7 <> 0").checkpoint()
    rows = [sorted((r["idx"], r["window"], tuple(r["input_ids"])) for r in
                   txt.encode_text(docs, vocab, max_length=20, keep=("idx",), shipped=n).collect()) for n in (10**6, 100, 1)]
    assert rows[0] == rows[1] == rows[2]
    words = {r["word"]: r["id"] for r in vocab.collect()}
    first = {i: w for i, n, w in rows[0] if n == 0}
    for r in docs.collect():
        ids = [words.get(w, 1) for w in r["sentence"].split()][:18]
        assert list(first[r["idx"]]) == [2, *ids, 3] + [0] * (18 - len(ids))


def test_subwords_are_whole_and_exact(spark):
    from tokenizers import Tokenizer
    from quarry.plans.queries import TOKENIZER
    long = "Unbelievably ünïcode 日本語 <|endoftext|> 123 " * 500
    rows = [(1, "Hello, world"), (2, None), (3, ""), (4, long), (5, "x" * 5000), (1, "again")]
    docs = spark.createDataFrame(rows, "idx long, sentence string")
    units = Tokenizer.from_file(TOKENIZER)
    units.encode_special_tokens = True
    start, end = units.token_to_id("<|startoftext|>"), units.token_to_id("<|endoftext|>")
    for piece in (64, 1 << 16):
        got = {}
        for r in txt.encode_subwords(docs, TOKENIZER, max_length=32, keep=("idx", "sentence"), piece=piece).collect():
            real = sum(r["attention_mask"])
            assert r["input_ids"][0] == start and r["input_ids"][real - 1] == end and set(r["input_ids"][real:]) <= {0}
            got.setdefault((r["idx"], r["sentence"]), {})[r["window"]] = r["input_ids"][1:real - 1]
        for idx, text in rows:
            ids = [i for _, part in sorted(got[idx, text].items()) for i in part]
            assert ids == units.encode(text or "", add_special_tokens=False).ids
        back = sorted((r["idx"], r["text"].replace(" ", "")) for r in
                      txt.decode_subwords(txt.encode_subwords(docs, TOKENIZER, max_length=32, keep=("idx",), piece=piece), TOKENIZER).collect())
        assert back == sorted((i, (t or "").lower().replace(" ", "")) for i, t in rows)
