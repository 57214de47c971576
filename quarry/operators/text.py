"""Text: vocabulary, fixed-length encoding, bag-of-ids class scoring, predictions.

Words are runs of Unicode letters of the lower-cased text, taken from the whole text, and
the vocabulary holds every word unless a size is asked for. Words are hashed to 64 bits where
Spark splits the text; tasks see hashes only and look them up in a sorted NumPy dictionary, so
no string crosses to Python and no Python object is made per word. Encoding is row-local: a
row's words become consecutive windows of ``max_length`` positions, no frequent word is
shuffled, and rows that share a key stay apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quarry.functions.arrays import argmax_index, array_log_softmax
from quarry.operators.indexing import global_index

# Fixed special-token ids (padding, unknown, sequence start, sequence end).
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4
WORD_PATTERN = r"\p{L}+"

#: words whose hash and id are sent to the tasks (12 bytes each), the most frequent ones; the
#: others, which are rare, are joined
MAX_SHIPPED_WORDS = 8_000_000
#: class x word figures that are sent to the tasks (8 bytes each); more are joined
MAX_SHIPPED_SCORES = 8_000_000
#: tokens that a task works on at a time; a longer single text is worked on alone
SLICE_TOKENS = 1 << 17


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), 0)


def word_hashes(text: Column) -> Column:
    """The words of a text as 64-bit hashes of their UTF-8 bytes."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def build_vocab(docs: DataFrame, text: str = "sentence", max_size: int | None = None) -> DataFrame:
    """``(word, id, count)`` ordered by count descending then word; ids start after the four
    special ids. All words, or with ``max_size`` the ``max_size - 4`` most frequent. The
    numbering is distributed, so the vocabulary never meets in one task."""
    counts = docs.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("count"))
    ranked = global_index(counts.withColumn("_rarity", -F.col("count")), ["_rarity", "word"], pos="_pos")
    if max_size is not None:
        ranked = ranked.where(F.col("_pos") < max_size - FIRST_WORD_ID)
    return ranked.select("word", (F.col("_pos") + FIRST_WORD_ID).cast("int").alias("id"), "count")


@dataclass(frozen=True)
class Dictionary:
    """Ids by sorted word hashes; ``whole`` if no word of the vocabulary is left out."""

    hashes: np.ndarray
    ids: np.ndarray
    whole: bool

    def look_up(self, tokens: np.ndarray) -> np.ndarray:
        """The id of each hash, ``UNK_ID`` where there is none."""
        if not len(self.hashes):
            return np.full(len(tokens), UNK_ID, dtype=np.int32)
        place = np.searchsorted(self.hashes, tokens)
        place[place == len(self.hashes)] = 0
        return np.where(self.hashes[place] == tokens, self.ids[place], np.int32(UNK_ID))


def dictionary(vocab: DataFrame, shipped: int = MAX_SHIPPED_WORDS) -> Dictionary:
    """The vocabulary's first ``shipped`` ids, which are its most frequent words."""
    coded = vocab.select(F.xxhash64("word").alias("h"), "id")
    whole = coded.limit(shipped + 1).count() <= shipped
    found = (coded if whole else coded.where(F.col("id") < FIRST_WORD_ID + shipped)).toArrow()
    hashes, ids = found.column("h").to_numpy(), found.column("id").to_numpy()
    order = np.argsort(hashes, kind="stable")
    return Dictionary(hashes[order], ids[order].astype(np.int32), whole)


def _list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, row offsets) of a list column of numbers; a null list is empty."""
    lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    if column.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths)))


def token_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into row slices of about ``SLICE_TOKENS`` tokens: (rows, tokens, offsets)."""
    for batch in batches:
        tokens, offs = _list_parts(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE_TOKENS, "right")) - 1)
            yield batch.slice(lo, hi - lo), tokens[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def _rare_ids(ids: np.ndarray, tokens: np.ndarray, offs: np.ndarray, rare: pa.Array) -> None:
    """Fill unknown ``ids`` from the rows' own lists of (hash, id)."""
    values = rare.flatten()
    open_ = np.flatnonzero(ids == UNK_ID)
    if not len(values) or not len(open_):
        return
    lengths = np.diff(rare.offsets.to_numpy(zero_copy_only=False))
    if rare.null_count:
        lengths = np.where(rare.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[open_]
    h, known = values.field("h").to_numpy(zero_copy_only=False), values.field("id").to_numpy(zero_copy_only=False)
    names, code = np.unique(np.concatenate((h, tokens[open_])), return_inverse=True)
    have = np.repeat(np.arange(len(lengths)), lengths) * len(names) + code[:len(h)]
    want = row * len(names) + code[len(h):]
    order = np.argsort(have)
    place = np.minimum(np.searchsorted(have[order], want), len(have) - 1)
    hit = have[order][place] == want
    ids[open_[hit]] = known[order][place[hit]]


def windows_of(ids: np.ndarray, offs: np.ndarray, max_length: int, cls: int = CLS_ID, sep: int = SEP_ID,
               pad: int = PAD_ID) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, window number, ids, mask) of every window: ``cls``, up to ``max_length - 2`` ids,
    ``sep``, padded. A row without ids has one empty window."""
    room = max_length - 2
    count = np.diff(offs)
    many = np.maximum(1, -(-count // room))
    first = np.concatenate(([0], np.cumsum(many)))
    row = np.repeat(np.arange(len(count)), many)
    number = np.arange(first[-1]) - first[row]
    size = np.minimum(count[row] - number * room, room)
    out = np.full((len(row), max_length), pad, dtype=np.int32)
    out[:, 0] = cls
    at = np.arange(len(ids)) - np.repeat(offs[:-1], count)
    out[np.repeat(first[:-1], count) + at // room, 1 + at % room] = ids
    out[np.arange(len(row)), size + 1] = sep
    mask = (np.arange(max_length) < (size + 2)[:, None]).astype(np.int32)
    return row, number.astype(np.int32), out, mask


def _window_batch(part: pa.RecordBatch, keep: list[str], ids: np.ndarray, offs: np.ndarray, max_length: int, **special: int) -> pa.RecordBatch:
    row, number, out, mask = windows_of(ids, offs, max_length, **special)
    ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * max_length)
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (out, mask, np.zeros_like(mask))]
    origin = pa.array(row)
    return pa.RecordBatch.from_arrays([*(part.column(c).take(origin) for c in keep), pa.array(number), *lists],
                                      [*keep, "window", "input_ids", "attention_mask", "token_type_ids"])


def _window_schema(docs: DataFrame, keep: Sequence[str]) -> StructType:
    array = ArrayType(IntegerType())
    return StructType([*[docs.schema[c] for c in keep], StructField("window", IntegerType()), StructField("input_ids", array),
                       StructField("attention_mask", array), StructField("token_type_ids", array)])


def _with_rare(rows: DataFrame, vocab: DataFrame, known: Dictionary) -> DataFrame:
    """``rows`` with ``_rare``: the (hash, id) of their words that ``known`` leaves out. Frequent words
    never move, so no join key is hot."""
    sent = rows.sparkSession.sparkContext.broadcast(known)
    tagged = rows.withColumn("_row", F.monotonically_increasing_id()).checkpoint()  # fixes the row numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, offs in token_slices(batches, "_tokens"):
            left = np.flatnonzero(sent.value.look_up(tokens) == UNK_ID)
            row = np.repeat(np.arange(part.num_rows), np.diff(offs))[left]
            pairs = pd.DataFrame({"row": row, "h": tokens[left]}).drop_duplicates()
            yield pa.RecordBatch.from_arrays([part.column("_row").take(pa.array(pairs["row"].to_numpy())), pa.array(pairs["h"].to_numpy())], ["_row", "h"])

    asked = tagged.select("_row", "_tokens").mapInArrow(run, "_row bigint, h bigint")
    found = (asked.join(vocab.select(F.xxhash64("word").alias("h"), F.col("id").cast("int").alias("id")), "h")
             .groupBy("_row").agg(F.collect_list(F.struct("h", "id")).alias("_rare")))
    return tagged.join(found, "_row", "left").drop("_row")


def encode_text(docs: DataFrame, vocab: DataFrame, max_length: int = 512, text: str = "sentence",
                keep: Sequence[str] = ("idx", "label"), shipped: int = MAX_SHIPPED_WORDS) -> DataFrame:
    """Whole texts as consecutive windows: ``keep`` columns, ``window`` (0-based), ``input_ids`` =
    [CLS] + up to ``max_length - 2`` word ids (unknown -> [UNK]) + [SEP], padded with [PAD]
    to ``max_length``; ``attention_mask`` 1 on real positions; ``token_type_ids`` all 0.

    Window 0 is what a fixed-length encoder that truncates would give; a null text or one
    without words has one empty window. Only ``keep`` columns survive (drop ``sentence``
    and ``idx`` for training input, keep them for predictions).
    """
    keep = list(keep)
    rows = docs.select(*keep, word_hashes(F.col(text)).alias("_tokens"))
    known = dictionary(vocab, shipped)
    if not known.whole:
        rows = _with_rare(rows, vocab, known)
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, offs in token_slices(batches, "_tokens"):
            ids = sent.value.look_up(tokens)
            if not sent.value.whole:
                _rare_ids(ids, tokens, offs, part.column("_rare"))
            yield _window_batch(part, keep, ids, offs, max_length)

    return rows.mapInArrow(run, _window_schema(docs, keep))


#: characters of a text that are cut into sub-words at a time
PIECE_CHARS = 1 << 16
#: words whose units a task remembers
KNOWN_WORDS = 1 << 17
_SPACE = re.compile("[ \t\n\r]")


def _pieces(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of ``size`` characters or more that end before white space."""
    lo = 0
    while lo < len(text):
        space = _SPACE.search(text, lo + size) if lo + size < len(text) else None
        hi = space.start() if space else len(text)
        yield text[lo:hi]
        lo = hi


def encode_subwords(docs: DataFrame, tokenizer: str, max_length: int = 512, text: str = "sentence", keep: Sequence[str] = ("idx", "label"),
                    start: str = "<|startoftext|>", end: str = "<|endoftext|>", pad: int = PAD_ID, piece: int = PIECE_CHARS) -> DataFrame:
    """``encode_text`` with the sub-word units of a public tokenizer file instead of a corpus
    vocabulary, so that no word is unknown: words that the file lacks are split into units
    it has. The same columns; ``start`` and ``end`` are the tokens that open and close a window.

    ``tokenizer`` is the path of a JSON file of the ``tokenizers`` library whose units never
    span white space. It is read once, by the driver, and sent to the tasks (a fixed size,
    however many documents there are). Texts are cut before white space into pieces of about
    ``piece`` characters and these into words, which changes no unit; a task encodes a word
    when it first meets it.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    own = Tokenizer.from_str(content)
    special = {"cls": own.token_to_id(start), "sep": own.token_to_id(end), "pad": pad}
    if None in special.values():
        raise ValueError(f"the tokenizer has no {start} or {end}")
    keep = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Tokenizer.from_str(sent.value)
        units.encode_special_tokens = True  # their strings in a text are ordinary text
        units.no_truncation()
        known: dict[str, list[int]] = {}

        def encoded(part: str) -> np.ndarray:
            found = _SPACE.sub(" ", part).split(" ")
            new = [w for w in set(found) if w not in known]
            if len(known) + len(new) > KNOWN_WORDS:
                known.clear()
                new = list(set(found))
            known.update((w, e.ids) for w, e in zip(new, units.encode_batch(new, add_special_tokens=False)))
            return np.fromiter(chain.from_iterable(map(known.__getitem__, found)), dtype=np.int32)

        for batch in batches:
            ids, offs, lo = [], [0], 0
            for i, value in enumerate(batch.column("_text")):
                offs.append(offs[-1])
                for part in _pieces(value.as_py() or "", piece):
                    ids.append(encoded(part))
                    offs[-1] += len(ids[-1])
                if offs[-1] >= SLICE_TOKENS or i + 1 == batch.num_rows:
                    yield _window_batch(batch.slice(lo, i + 1 - lo), keep, np.concatenate(ids) if ids else np.empty(0, np.int32),
                                        np.asarray(offs), max_length, **special)
                    ids, offs, lo = [], [0], i + 1

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, _window_schema(docs, keep))


#: windows whose texts are spelled at a time
SPELLED_ROWS = 256


def _spelling(units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, bytes) of every id. Byte-level units write a byte as one character: printable
    Latin-1 as itself, the others from U+0100 on; ``</w>`` ends a word."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(sorted(set(range(256)) - set(plain)))}
    spelled = []
    for i in range(units.get_vocab_size()):
        token = units.id_to_token(i) or ""
        body = token.removesuffix("</w>")
        known = all(c in byte_of for c in body)
        spelled.append((bytes(byte_of[c] for c in body) if known else body.encode()) + b" " * (body != token))
    length = np.array([len(t) for t in spelled], dtype=np.int64)
    return np.cumsum(length) - length, length, np.frombuffer(b"".join(spelled), dtype=np.uint8)


def decode_subwords(encoded: DataFrame, tokenizer: str, key: str = "idx") -> DataFrame:
    """``(key, text)``: the texts that windows of :func:`encode_subwords` stand for, as a byte-level
    tokenizer spells them (lower case, a space behind every word).

    Reads ``encoded`` as that function leaves it: the windows of a text follow each other in
    order, so nothing is moved and a task holds one text. Ids become bytes by a table, without
    an object per unit.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        sent = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, length, data = _spelling(Tokenizer.from_str(sent.value))
        kind, current, held = None, [], []  # key and parts of the text that may go on

        def texts(names: list, whole: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, type=kind), pa.array([t.decode("utf-8", "replace") for t in whole], type=pa.string())],
                                              [key, "text"])

        for batch in batches:
            kind = batch.schema.field(key).type
            for lo in range(0, batch.num_rows, SPELLED_ROWS):
                part = batch.slice(lo, SPELLED_ROWS)
                flat, offs = _list_parts(part.column("input_ids"))
                count = np.add.reduceat(_list_parts(part.column("attention_mask"))[0], offs[:-1]) - 2
                at = np.arange(len(flat)) - np.repeat(offs[:-1], np.diff(offs))
                ids = flat[(at > 0) & (at <= np.repeat(count, np.diff(offs)))]
                ends = np.cumsum(length[ids])
                raw = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ids] - ends + length[ids], length[ids])]
                border = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(count)))]
                names, first = part.column(key).to_pylist(), np.flatnonzero(part.column("window").to_numpy() == 0)
                cuts = [border[i] for i in first] + [border[-1]]
                held.append(raw[:cuts[0]].tobytes())
                if len(first):
                    done = list(zip(current, [b"".join(held)])) + [(names[i], raw[a:z].tobytes()) for i, a, z in zip(first[:-1], cuts, cuts[1:])]
                    if done:
                        yield texts(*map(list, zip(*done)))
                    current, held = [names[first[-1]]], [raw[cuts[-2]:].tobytes()]
        if current:
            yield texts(current, [b"".join(held)])

    schema = StructType([encoded.schema[key], *StructType.fromDDL("text string").fields])
    return encoded.select(key, "window", "input_ids", "attention_mask").mapInArrow(run, schema)


def fit_token_counts(encoded_train: DataFrame, label: str = "label") -> DataFrame:
    """Class statistics of a bag-of-ids classifier: ``(label, id, count)`` plus, per
    class, ``docs`` and ``tokens`` (as rows with ``id = -1`` and ``-2``). Bounded by
    classes x vocabulary. A text counts as one document however many windows it has."""
    toks = encoded_train.select(label, F.explode("input_ids").alias("id")).where(
        (F.col("id") >= UNK_ID) & ~F.col("id").isin(CLS_ID, SEP_ID))
    per_id = toks.groupBy(label, "id").agg(F.count(F.lit(1)).alias("count"))
    per_class_tokens = toks.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("id", F.lit(-2))
    first = encoded_train.where("window = 0")
    per_class_docs = first.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("id", F.lit(-1))
    return per_id.unionByName(per_class_docs.select(label, "id", "count")).unionByName(
        per_class_tokens.select(label, "id", "count"))


def _shipped_sums(encoded: DataFrame, words_of: DataFrame, classes: Sequence, id_space: int, key: str, keep: list[str], sums: list[str]) -> DataFrame:
    """Per key: ``keep``, ``_n`` tokens, and per class the sum of ln(count + 1) over the tokens."""
    found = words_of.toPandas()
    table = np.zeros((id_space, len(classes)))
    place = {c: i for i, c in enumerate(classes)}
    for c, i, n in zip(found["_c"], found["id"], found["count"]):
        table[i, place[c]] = n
    logs = np.log(table + 1.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[key, *keep]].reset_index(drop=True)
            ids = np.stack(batch["input_ids"].to_numpy()) if len(batch) else np.zeros((0, 1), dtype=np.int64)
            real = (ids >= UNK_ID) & (ids != CLS_ID) & (ids != SEP_ID)
            out["_n"] = real.sum(axis=1)
            for i, name in enumerate(sums):
                out[name] = (logs[ids, i] * real).sum(axis=1)
            yield out

    schema = StructType([*[encoded.schema[c] for c in (key, *keep)], *StructType.fromDDL("_n bigint, " + ", ".join(f"{m} double" for m in sums)).fields])
    scored = encoded.select(key, *keep, "input_ids").mapInPandas(run, schema)
    return scored.groupBy(key).agg(*[F.first(c).alias(c) for c in keep], F.sum("_n").alias("_n"), *[F.sum(m).alias(m) for m in sums])


def _joined_sums(encoded: DataFrame, words_of: DataFrame, classes: Sequence, id_space: int, key: str, keep: list[str], sums: list[str]) -> DataFrame:
    """The same without a table in the tasks. An id that a class does not have adds ln(1) = 0."""
    real = F.filter("input_ids", lambda i: (i >= UNK_ID) & ~i.isin(CLS_ID, SEP_ID))
    rows = encoded.select(key, *keep, real.alias("_ids"))
    total = rows.groupBy(key).agg(*[F.first(c).alias(c) for c in keep], F.sum(F.size("_ids")).alias("_n"))
    tokens = rows.select(F.col(key).alias("_key"), F.explode("_ids").alias("id")).groupBy("_key", "id").agg(F.count(F.lit(1)).alias("_k"))
    gained = (tokens.join(words_of, "id").groupBy("_key", "_c").agg(F.sum(F.col("_k") * F.log(F.col("count") + 1.0)).alias("_s"))
              .groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_s"))).alias("_of")))
    kind = words_of.schema["_c"].dataType
    return total.join(gained, total[key].eqNullSafe(F.col("_key")), "left").select(
        key, *keep, "_n", *[F.coalesce(F.try_element_at("_of", F.lit(c).cast(kind)), F.lit(0.0)).alias(m) for c, m in zip(classes, sums)])


def score_bag_of_ids(encoded: DataFrame, stats: DataFrame, classes: Sequence, id_space: int,
                     key: str = "idx", label: str = "label", keep: Sequence[str] = (), shipped: int = MAX_SHIPPED_SCORES) -> DataFrame:
    """Multinomial class scores with add-one smoothing over ``id_space`` ids:
    ``score[c] = ln(docs_c / docs) + sum over tokens ln((count_c(id) + 1) / (tokens_c + id_space))``;
    ``pred`` = first class with the highest score. One row per ``key`` and ``keep`` columns
    (their values must be the same in all windows of a key).

    Up to ``shipped`` class figures (classes x ids) are sent to the tasks: a window's tokens
    are summed where it lies, and only window sums are shuffled. Beyond, a text's ids are
    counted and joined with the figures.
    """
    place = {c: i for i, c in enumerate(classes)}
    docs_of, tokens_of = np.zeros(len(classes)), np.zeros(len(classes))
    for c, i, n in stats.where("id < 0").select(label, "id", "count").collect():
        (docs_of if i == -1 else tokens_of)[place[c]] = n
    denominators = [math.log(t + id_space) for t in tokens_of]
    priors = [math.log(d / docs_of.sum()) if d else float("-inf") for d in docs_of]
    sums = [f"_m{i}" for i in range(len(classes))]
    words_of = stats.where("id >= 0").select(F.col(label).alias("_c"), "id", "count")
    by_key = _shipped_sums if len(classes) * id_space <= shipped else _joined_sums
    total = by_key(encoded, words_of, classes, id_space, key, list(keep), sums)
    arr = F.array(*[F.lit(p) + F.col(m) - F.col("_n").cast("double") * F.lit(d) for p, m, d in zip(priors, sums, denominators)])
    labels = F.array(*[F.lit(c) for c in classes])
    return (total.withColumn("scores", arr)
            .withColumn("pred", F.element_at(labels, F.array_position("scores", F.array_max("scores")).cast("int")))
            .drop("_n", *sums))


@dataclass(frozen=True)
class WordModel:
    """A fitted multinomial classifier of words: per class the log prior and the log of the
    smoothed size, and ``figures`` (c, h, count), the class counts of the words it has seen."""

    classes: list
    priors: list[float]
    sizes: list[float]
    figures: DataFrame
    words: int  # rows of ``figures``


def fit_words(train: DataFrame, id_space: int, text: str = "sentence", label: str = "label") -> WordModel:
    """Class counts of every word of the labelled rows, straight from the texts: no vocabulary is
    sent or joined. Rows with a null label are left out; a null text counts as a document."""
    rows = train.where(F.col(label).isNotNull()).select(F.col(label).alias("c"), word_hashes(F.col(text)).alias("_tokens"))
    per_class = rows.groupBy("c").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("_tokens")).alias("tokens")).orderBy("c").collect()
    total = sum(r["docs"] for r in per_class)
    figures = rows.select("c", F.explode("_tokens").alias("h")).groupBy("c", "h").agg(F.count(F.lit(1)).alias("count")).checkpoint()
    return WordModel([r["c"] for r in per_class], [math.log(r["docs"] / total) for r in per_class],
                     [math.log(r["tokens"] + id_space) for r in per_class], figures, figures.count())


def _sent_gains(rows: DataFrame, model: WordModel) -> DataFrame:
    """``rows`` with ``_n`` tokens and ``_gain``, per class the sum of ln(count + 1), summed where the
    rows lie; the figures are sent along."""
    found = model.figures.select(F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("c")).alias("c"), "h", "count").toArrow()
    hashes, place = np.unique(found.column("h").to_numpy(), return_inverse=True)
    logs = np.zeros((len(hashes), len(model.classes)))
    logs[place, found.column("c").to_numpy() - 1] = np.log(found.column("count").to_numpy() + 1.0)
    sent = rows.sparkSession.sparkContext.broadcast((hashes, logs))
    others = [c for c in rows.columns if c != "_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, logs = sent.value
        width = logs.shape[1]
        for part, tokens, offs in token_slices(batches, "_tokens"):
            n = np.diff(offs)
            row, gain = np.repeat(np.arange(len(n)), n), np.zeros((len(n), width))
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
                hit = hashes[at] == tokens
                for c in range(width):
                    gain[:, c] = np.bincount(row[hit], weights=logs[at[hit], c], minlength=len(n))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * width), pa.array(gain.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(n.astype(np.int64)), lists], [*others, "_n", "_gain"])

    schema = StructType([*[rows.schema[c] for c in others], *StructType.fromDDL("_n bigint, _gain array<double>").fields])
    return rows.mapInArrow(run, schema)


def _joined_gains(rows: DataFrame, model: WordModel) -> DataFrame:
    """The same by a join of each row's distinct words with the figures. A word's figures are one
    row, salted, so that a word of every text is not one task's."""
    salts = 32
    tagged = rows.withColumn("_row", F.monotonically_increasing_id()).checkpoint()  # fixes the row numbers
    kinds = F.array(*[F.lit(c) for c in model.classes])
    gain = F.log(F.col("count") + 1.0)
    figures = model.figures.select("h", (F.array_position(kinds, F.col("c")) - 1).alias("c"), gain.alias("g")).select(
        "h", "c", "g", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    tokens = (tagged.select("_row", F.explode("_tokens").alias("h")).groupBy("_row", "h").agg(F.count(F.lit(1)).alias("k"))
              .withColumn("salt", F.pmod("_row", F.lit(salts)).cast("int")))
    sums = (tokens.join(figures, ["h", "salt"]).groupBy("_row", "c").agg(F.sum(F.col("k") * F.col("g")).alias("s"))
            .groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("c", "s"))).alias("_of")))
    gains = F.array(*[F.coalesce(F.try_element_at("_of", F.lit(c).cast("bigint")), F.lit(0.0)) for c in range(len(model.classes))])
    return (tagged.join(sums, "_row", "left")
            .withColumn("_n", F.size("_tokens").cast("bigint")).withColumn("_gain", gains).drop("_row", "_of", "_tokens"))


def score_words(docs: DataFrame, model: WordModel, text: str = "sentence", keep: Sequence[str] = ("idx", "sentence", "label"),
                label: str | None = None, shipped: int = MAX_SHIPPED_SCORES) -> DataFrame:
    """``keep`` columns, ``scores`` (per class ``log prior + sum of ln(count + 1) - tokens * log size``),
    ``pred`` (the first class with the highest score) and, with a ``label`` column among ``keep``,
    the row's cross-entropy ``loss`` (null for a class the model lacks).

    One row per row of ``docs``, in one pass over its texts: up to ``shipped`` figures are sent to
    the tasks, more are joined. The figures grow with the labelled rows of the fit, not with
    the documents that are scored.
    """
    keep = list(keep)
    rows = docs.select(*keep, word_hashes(F.col(text)).alias("_tokens"))
    ways: Callable = _sent_gains if model.words * len(model.classes) <= shipped else _joined_gains
    found = ways(rows, model)
    scores = F.array(*[F.lit(p) + F.get(F.col("_gain"), i) - F.col("_n").cast("double") * F.lit(z)
                       for i, (p, z) in enumerate(zip(model.priors, model.sizes))])
    kinds = F.array(*[F.lit(c) for c in model.classes])
    out = found.withColumn("scores", scores).withColumn("pred", F.get(kinds, argmax_index(F.col("scores"))))
    if label:
        truth = F.array_position(kinds, F.col(label).cast(docs.schema[label].dataType)) - 1
        out = out.withColumn("loss", -F.get(array_log_softmax(F.col("scores")), truth.cast("int")))
    return out.drop("_n", "_gain")


def predictions_table(scored: DataFrame, mode: str = "validation") -> DataFrame:
    """``Sentence, GroundTruth, Prediction`` (validation) or ``Sentence, Prediction`` (test)."""
    cols = [F.col("sentence").alias("Sentence")]
    if mode == "validation":
        cols.append(F.col("label").alias("GroundTruth"))
    cols.append(F.col("pred").alias("Prediction"))
    return scored.select("idx", *cols)
