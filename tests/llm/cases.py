"""Small document tables for the edge cases that every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: columns that bear names the operators use themselves
CLASHING = "doc bigint, n bigint, at string, h5 string, spans string, sig string, component string, score string, features string, weight string, rate string, id string, item string, host string, fingerprint string"


def words(seed: int, n: int, vocabulary: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows() -> list[tuple]:
    base = words(1, 120)
    near = base.replace(base.split()[60], "other", 1)
    passage = words(2, 60)
    texts = [base, base, near, None, "", " \n\t ", "one", "two words", words(3, 30000, 400), "x" * 200_000,
             words(4, 40) + "\n" + passage + "\n" + words(5, 40), passage + " " + words(6, 50), "ha " * 3000,
             "Ünïcode ünïcode     日本語 текст \U0001f600 " + words(7, 30), words(8, 19), words(9, 20), words(9, 20)]
    rows = [(10 + 3 * i, t, ("en", "de", None)[i % 3], ("a", "b", None, "a")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, base, "en", "a", len(base)))  # a null key
    rows.append((None, None, None, None, None))
    return rows


def edge_docs(spark, clashing: bool = False):
    rows = edge_rows()
    if clashing:
        return spark.createDataFrame([(*r, 1, 2, *["z"] * 13) for r in rows], f"{DOCS}, {CLASHING}")
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
