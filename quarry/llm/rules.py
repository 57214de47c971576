"""Quality rules as weak supervision.

1. One pass over the whole texts measures every document (NumPy on the raw bytes).
2. A rule is a pair of column expressions over the measures: it votes against a document, for
   it, or abstains. Votes are counted by pattern over all documents; with ``R`` rules there
   are at most ``3 ** R`` patterns, however many documents.
3. Expectation-maximisation on the pattern counts estimates each rule's accuracy on good and
   on bad documents, and the share of good ones, without labels.
4. The posterior probability of a document's pattern replaces "passes every rule".
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.textops import SEPARATOR, Words, slices, span_hashes, window_hashes

#: fixed value: the symbols that the contract counts
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: lines above this are hashed one by one, so that memory follows the text
LONG_LINE = 1 << 16
#: most rules of a set: 3 ** 11 patterns at most come to the driver
MAX_RULES = 11
#: accuracies stay between these: a rule is better than chance, and never certain
LEAST, MOST = 0.55, 0.99
ROUNDS = 200

_KINDS = np.zeros((256, 5), dtype=bool)  # symbol, A-Z, a-z, !, not a UTF-8 continuation byte
_KINDS[list(SYMBOLS.encode()), 0] = True
_KINDS[65:91, 1] = True
_KINDS[97:123, 2] = True
_KINDS[ord("!"), 3] = True
_KINDS[:, 4] = (np.arange(256) & 0xC0) != 0x80
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True
_PLAIN = np.ones(256, dtype=bool)  # letters, digits and ordinary punctuation
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = False
_PLAIN[list(b".,;:!?'()\"-")] = True
_LETTER = _KINDS[:, 1] | _KINDS[:, 2] | (np.arange(256) >= 0x80)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_top_word", "n_upper", "n_ascii_letters",
            "n_exclaim", "n_sentence_ends", "n_letter_words", "n_plain_words")


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    if len(offs) == 2:  # a long text is alone
        return np.array([np.count_nonzero(flags)])
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offs])


def _line_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    long = ends - starts > LONG_LINE
    out[~long] = span_hashes(data, starts[~long], ends[~long])
    for i in np.flatnonzero(long):
        out[i] = np.frombuffer(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), dtype=np.uint64)[0]
    return out


def _groups(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first places in it, sizes) of equal (row, value) pairs."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))) if len(r) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(r)))


def measured(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The ``MEASURES`` of a slice of texts."""
    rows = len(offs) - 1
    w = Words(data, offs)
    n_words = np.diff(w.first)
    symbols, upper, lower, exclaim = (_per_row(_KINDS[data, k], offs) for k in range(4))
    word_chars = _per_row(_KINDS[data, 4] & ~SEPARATOR[data], offs)
    # lines: every text starts one, every \n starts another; only those with a word count
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate((offs[:-1], breaks + 1))
    ends = np.concatenate((breaks, offs[1:]))
    starts, ends = np.sort(starts), np.sort(ends)
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[has_word], ends[has_word]
    line_row = np.searchsorted(offs, starts, "right") - 1
    n_lines = np.bincount(line_row, minlength=rows)
    order, first, _ = _groups(line_row, _line_hashes(data, starts, ends))
    n_dup = n_lines - np.bincount(line_row[order[first]], minlength=rows)
    # words in windows that the text has at least twice
    count = len(w.hash) - WINDOW + 1
    covered = np.zeros(len(w.hash), dtype=bool)
    if count > 0:
        inside = np.flatnonzero(w.row[:count] == w.row[WINDOW - 1:])
        order, first, size = _groups(w.row[inside], window_hashes(w.hash, WINDOW)[inside])
        twice = inside[order[np.repeat(size > 1, size)]]
        for i in range(WINDOW):
            covered[twice + i] = True
    order, first, size = _groups(w.row, w.hash)
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, w.row[order[first]], size)
    ends_sentence = _ENDS[data[w.end - 1]] if len(w.end) else np.zeros(0, dtype=bool)
    with_letter = np.logical_or.reduceat(_LETTER[data], w.start) if len(w.start) else np.zeros(0, dtype=bool)
    plain = _PLAIN[data[w.start]] & _PLAIN[data[w.end - 1]] if len(w.end) else ends_sentence
    return [n_words, word_chars, symbols, n_lines, n_dup, _per_row(covered, w.first), top, upper, upper + lower, exclaim,
            *(_per_row(flags, w.first) for flags in (ends_sentence, with_letter, plain))]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``MEASURES`` as longs) of every row; a null or empty text has zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([part.column("doc"), *(pa.array(m.astype(np.int64)) for m in measured(data, offs))], ["doc", *MEASURES])

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"))
    found = rows.mapInArrow(run, "doc bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return found.withColumnRenamed("doc", key)


@dataclass(frozen=True)
class Rule:
    """Votes against a document where ``bad`` holds, for it where ``good`` holds (``bad`` wins),
    else abstains; a null condition does not hold. Both are SQL conditions over the measures."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        holds = lambda c: F.coalesce(F.expr(c), F.lit(False))
        return F.when(holds(self.bad), 0).when(holds(self.good), 2).otherwise(1)


NEVER = "false"
#: Shares are written as products, so a text without words makes no division. Most rules only
#: accuse: a text that is ordinary in one respect says little, and rules that approve for it would
#: outvote the one that sees the fault. Each fault is seen by two rules or more.
RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", NEVER),
    Rule("plain_words", "n_plain_words < 0.8 * n_words", NEVER),
    Rule("letters", "n_letter_words < 0.8 * n_words", NEVER),
    Rule("sentence_ends", "n_words >= 50 and n_sentence_ends < 0.01 * n_words", NEVER),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 12 * n_words", NEVER),
    Rule("repeated_lines", "n_dup_lines > 0.3 * n_lines", NEVER),
    Rule("repeated_words", "n_repeat_words > 0.3 * n_words", NEVER),
    Rule("top_word", "n_words >= 50 and n_top_word > 0.2 * n_words", NEVER),
    Rule("capitals", "n_upper > 0.3 * n_ascii_letters", NEVER),
    Rule("exclamation", "n_exclaim > 0.1 * n_words", NEVER),
    Rule("prose", NEVER, "n_words >= 50 and n_sentence_ends between 0.02 * n_words and 0.3 * n_words and n_symbols <= 0.02 * n_words"
         " and n_upper <= 0.15 * n_ascii_letters and n_repeat_words <= 0.3 * n_words"),
)


@dataclass(frozen=True)
class Estimate:
    """What expectation-maximisation found: the share of good documents, and the chance that a
    vote of each rule is right."""

    share: float
    accuracy: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of a good document for rows of votes (0 against, 1 none, 2 for)."""
        weight = np.log(self.accuracy) - np.log(1 - self.accuracy)
        return 1 / (1 + np.exp(-(np.log(self.share / (1 - self.share)) + (votes - 1) @ weight)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Estimate:
    """Expectation-maximisation over vote patterns and their counts: a rule abstains without
    regard to quality, and a vote is right with the rule's accuracy. Votes of a thousandth of
    the documents at an accuracy of 0.8 are added as a prior, so an estimate is the same for a
    corpus and for copies of it, whatever its size."""
    mass = counts / max(counts.sum(), 1)
    now, prior = Estimate(0.8, np.full(votes.shape[1], 0.8)), 0.001
    for _ in range(rounds):
        p = now.posterior(votes)
        right = (mass * p) @ (votes == 2) + (mass * (1 - p)) @ (votes == 0)
        accuracy = np.clip((right + 0.8 * prior) / (mass @ (votes != 1) + prior), LEAST, MOST)
        new = Estimate(float(np.clip(mass @ p, 0.05, 0.95)), accuracy)
        moved = max(abs(new.share - now.share), np.abs(new.accuracy - now.accuracy).max(initial=0))
        now = new
        if moved < 1e-12:
            break
    return now


def judge(measures: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, Estimate]:
    """``measures`` with ``posterior``, and the estimate. Votes are counted over all rows; the
    patterns (at most ``3 ** len(rules)``) come to the driver and go back with a broadcast."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, so that the vote patterns stay few")
    code = sum((r.vote() * 3 ** i for i, r in enumerate(rules)), F.lit(0)).cast("int")
    voted = measures.withColumn("_votes", code)
    found = voted.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).orderBy("_votes").collect()
    codes = np.array([r[0] for r in found], dtype=np.int64)
    votes = (codes[:, None] // 3 ** np.arange(len(rules))) % 3
    model = estimate(votes, np.array([r[1] for r in found], dtype=np.float64))
    table = list(zip(codes.tolist(), model.posterior(votes).tolist()))
    known = measures.sparkSession.createDataFrame(table, "_votes int, posterior double")
    return voted.join(F.broadcast(known), "_votes").drop("_votes"), model


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``MEASURES``, base_failed, posterior, kept) of every row of ``docs``.

    ``base_failed``: below 50 words, or more than half of the words in repeated 3-word windows;
    such a document is never kept. Others are kept at a posterior of ``threshold`` or more, a
    tie included. Null, empty and wordless texts fail the base. Repeated rows are judged (and
    counted) each; a null key is judged like any. An empty table gives no rows; very long
    texts are measured whole, one at a time; other columns are not carried.
    """
    judged, _ = judge(written(measure(docs, key, text), "measures"), rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
