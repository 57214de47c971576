"""Language identification: script ranges narrow the candidates of each word, then Viterbi
over per-word scores with a switching penalty labels the spans of mixed-language texts.

A word's score for a language is the sum, over its bytes, of smoothed log probabilities of
byte trigrams (A-Z lower-cased, other signs as word borders), hashed to ``BUCKETS``
buckets. Counts come from all learned rows: per-batch partial tables summed by Spark. The
model (languages x buckets) comes to the driver and is sent to the tasks; its size follows
the number of languages, not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.textops import LOWER_AZ, Words, slices

BUCKETS = 1 << 15
#: log units that a change of language costs between two words
SWITCH = 6.0
#: share of a language's words that must use a script for the language to be its candidate
SCRIPT_SHARE = 0.01

#: fixed values: first code point of each block of letters and the script it belongs to
SCRIPT_RANGES = [
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"),
    (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "None"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"),
    (0x30000, "None"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES} - {"None"})
_RANGE_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_RANGE_BITS = np.array([0 if name == "None" else 1 << SCRIPTS.index(name) for _, name in SCRIPT_RANGES], dtype=np.int64)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _trigrams(data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of the trigram around each letter byte inside a word."""
    letter = _LETTER[data]
    signs = np.where(letter, LOWER_AZ[data], np.uint8(0x20)).astype(np.int64)
    before, after = np.empty_like(signs), np.empty_like(signs)
    if len(signs):
        before[0], before[1:] = 0x20, signs[:-1]
        after[-1], after[:-1] = 0x20, signs[1:]
        before[w.start] = 0x20
        after[w.end - 1] = 0x20
    at = np.flatnonzero(letter)
    code = (before[at] << 16 | signs[at] << 8 | after[at]).astype(np.uint64)
    bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)
    return bucket, np.searchsorted(w.start, at, "right") - 1


def _word_scripts(data: np.ndarray, w: Words) -> np.ndarray:
    """Bits of the scripts whose letters occur in each word."""
    bits = np.zeros(len(w.start), dtype=np.int64)
    latin = 1 << SCRIPTS.index("Latin")
    ascii_letters = np.concatenate(([0], np.cumsum(_LETTER[data] & (data < 128))))
    bits[ascii_letters[w.end] > ascii_letters[w.start]] |= latin
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        b = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        b0, b1, b2, b3 = (b[lead + i] for i in range(4))
        cp = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63,
                      np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
                               (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
        script = _RANGE_BITS[np.maximum(np.searchsorted(_RANGE_STARTS, cp, "right") - 1, 0)]
        script[cp < 0xC0] = 0  # Latin-1 signs that are no letters
        np.bitwise_or.at(bits, np.searchsorted(w.start, lead, "right") - 1, script)
    return bits


@dataclass
class Model:
    """Sorted languages, log probabilities (bucket x language) and script bits per language."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts of trigrams and scripts over all rows with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for part, data, offs in slices(batches, "_text"):
            names = np.array(part.column("_lang").to_pylist(), dtype=object)
            w = Words(data, offs)
            bucket, word = _trigrams(data, w)
            bits = _word_scripts(data, w)
            for name in set(names):
                mine = (names == name)[w.row]
                grams[name] = grams.get(name, 0) + np.bincount(bucket[mine[word]], minlength=BUCKETS)
                scripts[name] = scripts.get(name, 0) + np.array([np.count_nonzero(bits[mine] >> i & 1) for i in range(len(SCRIPTS))])
        for name, counts in grams.items():
            used = np.flatnonzero(counts)
            both = np.concatenate((used, BUCKETS + np.arange(len(SCRIPTS))))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(both)), pa.array(both), pa.array(np.concatenate((counts[used], scripts[name])))],
                                             ["lang", "cell", "n"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"))
    cells = rows.mapInArrow(run, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(cells["lang"].unique())
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[cells["cell"].to_numpy(dtype=np.int64), [languages.index(x) for x in cells["lang"]]] = cells["n"]
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    logs = np.log(grams / grams.sum(axis=0, keepdims=True)) if languages else grams
    if languages:
        logs -= logs.mean(axis=1, keepdims=True)  # what all languages share decides nothing
    common = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    bits = (common * (1 << np.arange(len(SCRIPTS)))[:, None]).sum(axis=0) if languages else np.zeros(0, dtype=np.int64)
    return Model(languages, logs.astype(np.float32), bits.astype(np.int64))


def word_scores(model: Model, data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(scores, letters): word x language scores, and letter bytes per word. A word whose
    scripts are those of some languages only is closed to the others."""
    bucket, word = _trigrams(data, w)
    scores = np.zeros((len(w.start), len(model.languages)), dtype=np.float32)
    if len(word):
        found, first = np.unique(word, return_index=True)
        scores[found] = np.add.reduceat(model.scores[bucket], first, axis=0)
    bits = _word_scripts(data, w)
    fits = (bits[:, None] & model.scripts[None, :]) != 0
    closed = fits.any(axis=1)[:, None] & ~fits
    scores[closed] = -1e4
    letters = np.bincount(word, minlength=len(w.start))
    return scores, letters


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label per word of every text (``first[r]:first[r + 1]`` are text r's words): the sum
    of scores less ``penalty`` per change of label is greatest. All texts step together."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    labels = np.zeros(len(scores), dtype=np.int16)
    if not len(scores) or scores.shape[1] < 2:
        return labels
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")  # texts with more than t words
    stay = np.zeros(scores.shape, dtype=bool)
    leader = np.zeros(len(scores), dtype=np.int16)  # best label of the word before
    best = scores[begin[:active[0]]]
    rows = np.arange(len(begin))
    for t in range(1, lengths[0]):
        k = active[t]
        if k < active[t - 1]:
            done = slice(k, active[t - 1])
            labels[begin[done] + lengths[done] - 1] = best[done].argmax(axis=1)
            best = best[:k]
        at = begin[:k] + t
        top = best.argmax(axis=1)
        change = (best[rows[:k], top] - penalty)[:, None]
        kept = best >= change
        stay[at], leader[at] = kept, top
        best = np.where(kept, best, change) + scores[at]
    labels[begin[:len(best)] + lengths[:len(best)] - 1] = best.argmax(axis=1)
    for t in range(lengths[0] - 1, 0, -1):
        at = begin[:active[t]] + t
        here = labels[at]
        labels[at - 1] = np.where(stay[at, here], here, leader[at])
    return labels


def _has_letter(data: np.ndarray, offs: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Whether a text has a letter; texts with only non-ASCII bytes are looked at by sign."""
    plain = np.concatenate(([0], np.cumsum(_LETTER[data] & (data < 128))))
    sure = plain[offs[1:]] > plain[offs[:-1]]
    for r in np.flatnonzero(~sure & (letters > 0)):
        sure[r] = any(c.isalpha() for c in data[offs[r]:offs[r + 1]].tobytes().decode())
    return sure


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", penalty: float = SWITCH) -> DataFrame:
    """(key, lang_pred, score, spans) for every row: the language with most letters, its share
    of the letters, and the labelled spans ``struct<first_word, end_word, lang>``.

    ``und`` with score 0 and no spans for a text that is null, empty or without a letter, and
    for all texts if nothing was learned. Repeated rows and null keys are treated like
    others; an empty table gives no rows; other columns are not carried.
    """
    kind = dict(docs.dtypes)[key]
    names = np.array([*model.languages, "und"], dtype=object)
    und = len(model.languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, letters, counts, lettered = [], [], [np.zeros(1, np.int64)], []
            for _, data, offs in slices(iter([batch]), "_text"):
                w = Words(data, offs)
                s, n = word_scores(m, data, w)
                scores.append(s)
                letters.append(n)
                counts.append(np.diff(w.first))
                lettered.append(_has_letter(data, offs, np.bincount(w.row, weights=n, minlength=len(offs) - 1)))
            if not lettered:
                continue
            first = np.cumsum(np.concatenate(counts))
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            n = np.concatenate(letters).astype(np.float64)
            known = np.concatenate(lettered) & (und > 0)
            label = viterbi(np.concatenate(scores), first, penalty)
            share = np.bincount(row * max(und, 1) + label, weights=n, minlength=batch.num_rows * max(und, 1)).reshape(batch.num_rows, -1)
            top = share.argmax(axis=1)
            total = share.sum(axis=1)
            score = np.where(known, share.max(axis=1) / np.maximum(total, 1), 0.0)
            turn = np.ones(len(label), dtype=bool)
            turn[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
            turn &= known[row]
            head = np.flatnonzero(turn)
            tail = np.append(head[1:], len(label))
            tail = np.minimum(tail, first[row[head] + 1])
            per_row = np.bincount(row[head], minlength=batch.num_rows)
            spans = pa.StructArray.from_arrays(
                [pa.array((head - first[row[head]]).astype(np.int32)), pa.array((tail - first[row[head]]).astype(np.int32)),
                 pa.array(names[label[head]], pa.string())], ["first_word", "end_word", "lang"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_row)).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(known, top, und)], pa.string()), pa.array(score), lists],
                [key, "lang_pred", "score", "spans"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, spans array<struct<first_word:int,end_word:int,lang:string>>")


def learned_rows(key: Column, parts: int, held: int) -> Column:
    """Rows to learn from: crc32 of the key's text does not leave the remainder ``held``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts != held
