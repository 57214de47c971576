"""Substring dedup by level-wise doubling of repeated word windows.

A window of ``4 * base`` words (20 by default) that occurs twice repeats its sub-windows
too, so candidates are sought at ``base`` words and only what repeats is extended to
twice the length: 5, then 10, then 20.

* Every 20-word window has one *anchor*: its 5-word sub-window of least hash (leftmost
  among ties). Consecutive windows with one anchor form a *segment*. The choice depends
  on the words alone, so equal windows have equal anchors at equal offsets, and one row
  per segment, not per word, is enough to find them all.
* Equal segments are collapsed to their first occurrence; every other occurrence is
  removed at once. A task first collapses its own, so a passage that a third of all
  documents share is about one row per task in the shuffle.
* Level 5: segments whose anchor words also stand in another segment. Level 10: those
  whose anchor, doubled to the left or the right, still repeats. Level 20: the single
  windows of these, each judged against its first occurrence.

Counts are taken by aggregation and joined back, so no group has to fit a task. The text
is shuffled once; both readers of it share the exchange. Hashes are 64 bits each, and a
segment or window is identified by two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from quarry.llm.store import splittable
from quarry.llm.textops import Words, joined_hashes, mix, signed, slices, window_hashes

#: ``at`` packs the first window, the number of windows and the distance to the anchor (32,
#: 16 and 16 bits), so rows stay short and order by position. Nothing is nullable: every
#: reader of the segments then has the same plan below its exchange, which Spark reuses.
_SEGMENT = StructType([StructField("doc", LongType(), False), StructField("at", LongType(), False), StructField("h5", IntegerType(), False),
                       StructField("hseg", LongType(), False)])
_EXTENDED = StructType([StructField("doc", LongType(), False), StructField("s0", LongType(), False), StructField("lead", IntegerType(), False),
                        StructField("h5", IntegerType(), False), StructField("left10", LongType()), StructField("right10", LongType()),
                        StructField("w20", ArrayType(LongType(), False), False)])
#: in place of the distance: a run of segments that the same task has met earlier
_OWN_COPY = 0xFFFF


def _first_window(at: Column) -> Column:
    return F.shiftright(at, 32)


def _windows(at: Column) -> Column:
    return F.shiftright(at, 16).bitwiseAND(F.lit(0xFFFF))


def _lead(at: Column) -> Column:
    return at.bitwiseAND(F.lit(0xFFFF))


def _span(first: Column, length: Column | int) -> Column:
    """A word range as one long: 24 bits of length."""
    return F.shiftleft(first.cast("bigint"), 24).bitwiseOR(length if isinstance(length, Column) else F.lit(length))


class _Slice:
    """Windows of a slice of texts at ``base``, ``2 * base`` and ``4 * base`` words, as arrays
    over all words of the slice; those that would leave their text are never looked at."""

    def __init__(self, words: Words, base: int):
        self.words, self.base, self.size = words, base, 4 * base
        h = words.hash
        self.w5 = window_hashes(h, base)
        n10, n20 = max(0, len(h) - 2 * base + 1), max(0, len(h) - 4 * base + 1)
        self.w10 = joined_hashes(self.w5[:n10], self.w5[base:base + n10], base)
        self.w20 = joined_hashes(self.w10[:n20], self.w10[2 * base:2 * base + n20], 2 * base)
        self.w5 = mix(self.w5)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, last window, anchor) as word positions in the slice."""
        w, size = self.words, self.size
        if len(self.w20) == 0:
            empty = np.empty(0, dtype=np.int64)
            return empty, empty, empty
        at = np.arange(len(self.w5))
        span, reach = 1, size - self.base + 1  # sub-windows in a window
        while span < reach:  # leftmost minimum of `reach` neighbours, by doubling
            step = min(span, reach - span)
            left, right = at[:len(at) - step], at[step:]
            at = np.where(self.w5[right] < self.w5[left], right, left)
            span += step
        starts = np.flatnonzero(w.row[:len(self.w20)] == w.row[size - 1:])
        if len(starts) == 0:
            return starts, starts, starts
        anchor = at[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        return starts[first], starts[last], anchor[first]


def _short(h: np.ndarray) -> np.ndarray:
    """The upper 32 bits as int32."""
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"))


def _segments(texts: DataFrame, base: int) -> DataFrame:
    """One row per segment: document, packed position, hashes. Neighbouring segments that a task
    has met in an earlier document, or earlier in the same, are known to be copies; they
    make one row together, marked ``_OWN_COPY``, with a hash of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_doc = np.empty(0, np.uint64), np.empty(0, np.int64)  # posted by this task, 16 bytes a segment
        for batch in batches:
            parts = []
            for rows, data, offs in slices(iter([batch]), "_text"):
                w = Words(data, offs)
                s = _Slice(w, base)
                lo, hi, anchor = s.segments()
                doc = rows.column("doc").to_numpy(zero_copy_only=False)[w.row[lo]]
                n = hi - lo + 1
                seg = mix(s.w20[lo] + mix(s.w20[hi] + n.astype(np.uint64)))
                parts.append((doc, (lo - w.first[w.row[lo]]) << 32 | n << 16 | (anchor - lo), _short(s.w5[anchor]), seg))
            if not parts:
                continue
            doc, at, h5, seg = (np.concatenate(x) for x in zip(*parts))
            own = np.zeros(len(doc), dtype=bool)
            order = np.lexsort((at, doc, h5, seg))
            own[order[1:]] = (seg[order[1:]] == seg[order[:-1]]) & (h5[order[1:]] == h5[order[:-1]])
            both = mix(seg ^ h5.view(np.uint32))
            if len(known):
                at_known = np.minimum(np.searchsorted(known, both), len(known) - 1)
                own |= (known[at_known] == both) & (known_doc[at_known] < doc)
            known, known_doc = np.concatenate((known, both[~own])), np.concatenate((known_doc, doc[~own]))
            order = np.lexsort((known_doc, known))
            known, known_doc = known[order], known_doc[order]
            s0, n = at >> 32, at >> 16 & 0xFFFF
            head = np.ones(len(doc), dtype=bool)  # of a run of neighbouring copies, or any other segment
            head[1:] = ~(own[1:] & own[:-1] & (doc[1:] == doc[:-1]) & (s0[1:] == s0[:-1] + n[:-1]) & (s0[1:] >> 14 == s0[:-1] >> 14))
            heads = np.flatnonzero(head)
            n = np.add.reduceat(n, heads) if len(heads) else n
            doc, at, h5, seg, own = doc[heads], at[heads], h5[heads], seg[heads], own[heads]
            at = np.where(own, at >> 32 << 32 | n << 16 | _OWN_COPY, at)
            seg = np.where(own, mix(doc.astype(np.uint64) + mix(at.astype(np.uint64))), seg)
            yield pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(at), pa.array(h5), signed(seg)], ["doc", "at", "h5", "hseg"])

    return texts.mapInArrow(run, _SEGMENT)


def _extended(candidates: DataFrame, base: int) -> DataFrame:
    """Level 10 and 20 hashes of candidate segments: one row per segment with its doubled
    anchors (``left10``, ``right10``; null where that window is not inside the segment) and
    the hashes of its windows. ``candidates``: doc, _text, segs (at, h5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in slices(batches, "_text"):
            w = Words(data, offs)
            s = _Slice(w, base)
            lists = rows.column("segs")
            per_row = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            fields = lists.flatten()
            at = fields.field("at").to_numpy(zero_copy_only=False)
            s0, n, lead = at >> 32, at >> 16 & 0xFFFF, at & 0xFFFF
            row = np.repeat(np.arange(rows.num_rows), per_row)
            lo = w.first[row] + s0
            inside = lo + n - 1 + 4 * base <= w.first[row + 1]  # a repeated key with another text
            row, s0, n, lead, lo = row[inside], s0[inside], n[inside], lead[inside], lo[inside]
            h5 = fields.field("h5").to_numpy(zero_copy_only=False)[inside]
            a = lo + lead
            has_left, has_right = lead >= base, lead + 2 * base <= n - 1 + 4 * base
            left = np.where(has_left, s.w10[np.maximum(a - base, 0)] if len(a) else 0, np.uint64(0))
            right = np.where(has_right, s.w10[np.minimum(a, max(0, len(s.w10) - 1))] if len(a) else 0, np.uint64(0))
            ends = np.cumsum(n)
            every = np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n) + np.repeat(lo, n)
            doc = rows.column("doc").to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc.astype(np.int64)), pa.array(s0), pa.array(lead.astype(np.int32)), pa.array(h5),
                 pa.array(mix(left).view(np.int64), mask=~has_left), pa.array(mix(right).view(np.int64), mask=~has_right),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), signed(mix(s.w20[every])))],
                ["doc", "s0", "lead", "h5", "left10", "right10", "w20"])

    return candidates.mapInArrow(run, _EXTENDED)


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``groups``, an aggregate of them by ``keys``; a hot key splits."""
    other = groups.select(splittable(keys[0]).alias("_k"), *[F.col(k).alias(f"_{k}") for k in keys[1:]],
                          *[c for c in groups.columns if c not in keys])
    same = splittable(keys[0]) == F.col("_k")
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return rows.join(other, same).drop("_k", *[f"_{k}" for k in keys[1:]])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """(doc, spans): per document the word ranges (`_span`) covered by windows whose words also
    start earlier (smaller key, or same document further left).

    ``window`` must be a multiple of 4. Documents without such a window are not listed.
    """
    return _spans(_texts(docs, key, text), _texts(docs, key, text), window)


def _spans(texts: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """`repeated_spans` of ``texts`` (doc, _text). ``rows`` are the same with all columns that the
    caller joins the spans to: both joins then read one exchange of the text."""
    if window < 4 or window % 4:
        raise ValueError("window must be a multiple of 4")
    base = window // 4
    # a common segment's group has about one row per task: its other copies are marked
    group = Window.partitionBy("h5", "hseg")
    seen = _segments(texts, base).withColumn("first", F.min(F.struct("doc", "at")).over(group))
    is_first = (_lead(F.col("at")) != _OWN_COPY) & (F.col("first") == F.struct("doc", "at"))
    later = seen.where(~is_first).select("doc", _span(_first_window(F.col("at")), _windows(F.col("at")) + (window - 1)).alias("span"))

    # level 5
    firsts = seen.where(is_first).select("h5", "doc", "at")
    shared5 = firsts.groupBy("h5").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h5")
    level5 = _joined(firsts, shared5, ["h5"]).groupBy("doc").agg(F.collect_list(F.struct("at", "h5")).alias("segs"))

    # level 10
    extended = _extended(rows.join(level5, "doc"), base)
    # windows with offset <= lead - base hold the left doubling, the others the right one;
    # each goes along with the doubling that decides on it
    split = F.greatest(F.col("lead") - base + 1, F.lit(0))
    side = lambda i, h, start, w20: F.struct(F.lit(i).alias("i"), F.col(h).alias("h10"), start.alias("at"), w20.alias("w20"))
    ten = extended.withColumn("side", F.explode(F.filter(F.array(
        side(0, "left10", F.col("s0"), F.slice("w20", F.lit(1), split)),
        side(1, "right10", F.col("s0") + split, F.slice("w20", split + 1, F.size("w20")))),
        lambda x: x["h10"].isNotNull() & (F.size(x["w20"]) > 0)))).select("doc", "h5", "side.*")
    shared10 = ten.groupBy("h5", "i", "h10").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    level10 = _joined(ten, shared10, ["h10", "h5", "i"])

    # level 20
    windows = (level10.select("doc", "h5", "at", F.posexplode("w20").alias("o", "h20"))
               .select("h5", "h20", "doc", (F.col("at") + F.col("o")).alias("at")))
    firsts20 = windows.groupBy("h5", "h20").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    again = (_joined(windows, firsts20.select("h5", "h20", "first"), ["h20", "h5"])
             .where((F.col("first.doc") != F.col("doc")) | (F.col("first.at") != F.col("at")))
             .select("doc", _span(F.col("at"), window).alias("span")))
    return later.unionByName(again).groupBy("doc").agg(F.collect_list("span").alias("spans"))


def _kept(rows: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, layout: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words per row, removed per row, kept bytes, their offsets) of a slice. Kept words are
    joined by one space, or, with ``layout``, keep the white space that follows them."""
    w = Words(data, offs)
    lists = rows.column("spans")
    per_row = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    spans = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(rows.num_rows), per_row)
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    for place, sign in ((spans >> 24, 1), ((spans >> 24) + (spans & 0xFFFFFF), -1)):
        np.add.at(cover, np.minimum(w.first[row] + place, w.first[row + 1]), sign)
    index = np.flatnonzero(np.cumsum(cover)[:-1] <= 0)
    n_words = np.diff(w.first)
    n_kept = np.bincount(w.row[index], minlength=rows.num_rows)
    start, end = w.start[index], w.end[index]
    if layout:  # a row that loses nothing stays byte for byte
        end = np.minimum(np.append(w.start, len(data))[index + 1], offs[w.row[index] + 1])
        whole = n_kept == n_words
        cut = ~whole[w.row[index]]
        rows_at = np.concatenate((w.row[index][cut], np.flatnonzero(whole)))
        start, end = np.concatenate((start[cut], offs[:-1][whole])), np.concatenate((end[cut], offs[1:][whole]))
        source = data
    else:
        rows_at = w.row[index]
        last = np.ones(len(index), dtype=bool)
        last[:-1] = w.row[index][1:] != w.row[index][:-1]
        source = np.append(data, np.uint8(0x20))
        source[end[~last]] = 0x20
        end = end + ~last
    marks = np.zeros(len(source) + 1, dtype=np.int32)
    np.add.at(marks, start, 1)
    np.add.at(marks, end, -1)
    sizes = np.bincount(rows_at, weights=end - start, minlength=rows.num_rows).astype(np.int64)
    return n_words, n_words - n_kept, source[np.cumsum(marks)[:len(source)] > 0], np.append(0, np.cumsum(sizes))


def _cut(docs: DataFrame, key: str, text: str, window: int, columns: list[str], layout: bool) -> DataFrame:
    """(doc, n_words, n_removed, kept_text, columns...) for every row of ``docs``."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"), *columns)
    keyed = rows.where("doc is not null")
    joined = keyed.join(_spans(_texts(docs, key, text), keyed, window), "doc", "left")
    keyless = rows.where("doc is null").withColumn("spans", F.lit(None).cast(joined.schema["spans"].dataType))
    joined = joined.unionByName(keyless)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            n_words, n_removed, kept, at = _kept(part, data, offs, layout)
            texts = pa.LargeStringArray.from_buffers(len(n_words), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes()))
            if layout:
                texts = pc.if_else(part.column("_text").is_valid(), texts, pa.scalar(None, pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64)), texts.cast(pa.string()),
                 *[part.column(c) for c in columns]], ["doc", "n_words", "n_removed", "kept_text", *columns])

    schema = "doc bigint, n_words bigint, n_removed bigint, kept_text string"
    return joined.mapInArrow(run, ", ".join([schema, *[f"`{c}` {t}" for c, t in docs.dtypes if c in columns]]))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """(key, n_words, n_removed, kept_text) for every row: the words of the text without those
    in a window of ``window`` words that also starts earlier, joined by one space.

    Words are runs of other bytes than space and U+0009..U+000D. A null or empty text has
    no words and an empty ``kept_text``. A row with a null key is returned whole and is
    nobody's earlier copy. Rows that repeat a key are taken as one document: none of them
    is earlier than the other. Texts shorter than the window stay whole. Other columns
    are not carried; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)[key]
    done = _cut(docs, key, text, window, [], False)
    return done.select(F.col("doc").cast(kind).alias(key), "n_words", "n_removed", "kept_text")


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """The rows of ``docs`` with all their columns, repeated windows cut out of ``text`` as by
    `remove_repeats` but with the layout of what stays; texts without a repeat are
    unchanged, and rows that lose all their words are left out."""
    other = [c for c in docs.columns if c not in (key, text)]
    clash = {c: f"_c{i}" for i, c in enumerate(other)}
    renamed = docs.select(key, text, *[F.col(c).alias(clash[c]) for c in other])
    kind = dict(docs.dtypes)[key]
    done = _cut(renamed, key, text, window, list(clash.values()), True).where("n_removed = 0 or n_removed < n_words")
    back = {v: k for k, v in clash.items()}
    made = done.select(F.col("doc").cast(kind).alias(key), F.col("kept_text").alias(text), *[F.col(v).alias(k) for v, k in back.items()])
    return made.select(docs.columns)
