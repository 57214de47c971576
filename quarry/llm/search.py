"""Ranked lexical search: every item's best documents, by a hybrid of term-at-a-time and
document-at-a-time evaluation.

1. One pass over the whole texts keeps, per document, its number of terms and the
   frequencies of the items' terms (a forward index, written). Words of no item never leave
   the scan.
2. Counts of documents and terms give the weights; only sums reach the driver.
3. Every task turns the documents it reads into shards of posting lists. For an item, the
   short lists of a shard are summed term at a time into accumulators. These are then one
   more iterator, bounded by their largest sum, among the long lists, which are walked
   document block by document block: a block whose bounds cannot reach the item's tenth
   best score is skipped, and inside a block the lists with the smallest bounds are only
   probed for documents that the others leave in the race.
4. Tasks hand on their best documents, and a window takes the best of these.

Items are the stated query set; they go through in blocks of about ``BLOCK_TERMS`` distinct
terms, so what is sent to the tasks has a fixed bound however many items there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.textops import LOWER_AZ, Words, signed, slices

#: everything in ASCII but letters and digits; other bytes belong to terms
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

#: (item, term) pairs of a block of items
BLOCK_TERMS = 500_000
#: postings that a task inverts at a time
SHARD_POSTINGS = 2_000_000
#: documents of a shard that are bounded, skipped or scored together
SPAN = 1024
#: a list with fewer than one in SHORT of a shard's documents is short
SHORT = 32
#: a document id in a task: rank 1 puts null ids after all others
_ID = np.dtype([("score", np.int64), ("null", np.int8), ("doc", np.int64)])


def _counted(w: Words, vocabulary: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in ``vocabulary``, occurrences) of the vocabulary's terms, by row and place."""
    if not len(vocabulary):
        return (np.empty(0, np.int64),) * 3
    place = np.minimum(np.searchsorted(vocabulary, w.hash), len(vocabulary) - 1)
    hit = vocabulary[place] == w.hash
    cell, times = np.unique(w.row[hit] * len(vocabulary) + place[hit], return_counts=True)
    return cell // len(vocabulary), cell % len(vocabulary), times


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term, repeats): the hashed terms of every item; rows of one key count together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            w = Words(data, offs, SEPARATOR, LOWER_AZ)
            row, place, times = _counted(w, (known := np.unique(w.hash)), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(row)), signed(known[place]), pa.array(times.astype(np.int64))],
                                             ["item", "term", "repeats"])

    rows = items.select(F.col(key).cast("bigint").alias("item"), F.col(text).alias("_text")).distinct()
    return rows.mapInArrow(run, "item bigint, term bigint, repeats bigint").groupBy("item", "term").agg(F.sum("repeats").alias("repeats"))


def forward_index(docs: DataFrame, vocabulary: np.ndarray, key: str, text: str) -> DataFrame:
    """(doc, n, terms, times) of every document with a term: ``n`` terms with repeats, and the
    places and frequencies of those in ``vocabulary`` (sorted hashes, of bounded number)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            w = Words(data, offs, SEPARATOR, LOWER_AZ)
            row, place, times = _counted(w, sent.value, part.num_rows)
            at = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (place, times)]
            n = np.diff(w.first).astype(np.int64)
            whole = pa.RecordBatch.from_arrays([part.column("doc"), pa.array(n), *lists], ["doc", "n", "terms", "times"])
            yield whole.filter(pa.array(n > 0))

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, "doc bigint, n bigint, terms array<int>, times array<int>")


def document_frequencies(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` terms. Tasks count what they read; only sums move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            seen += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(seen[held])], ["term", "docs"])

    found = index.select("terms").mapInArrow(run, "term int, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    df = np.zeros(size, dtype=np.int64)
    df[found.column("term").to_numpy()] = found.column("docs").to_numpy()
    return df


class Shard:
    """Posting lists of some documents: per term the documents (ascending places) and impacts."""

    def __init__(self, docs: np.ndarray, null: np.ndarray, of: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int):
        order = np.argsort(term, kind="stable")  # postings come by document
        self.docs, self.null = docs, null
        self.of, self.impact = of[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(size + 1))
        self.spans = np.arange(0, len(docs) + SPAN, SPAN)

    def length(self, term: np.ndarray) -> np.ndarray:
        return self.first[term + 1] - self.first[term]

    def postings(self, term: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first[term], self.first[term + 1]
        return self.of[a:b], self.impact[a:b] * repeats

    def bounds(self, of: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cuts, largest value) of a list per span of documents."""
        cut = np.searchsorted(of, self.spans)
        top = np.zeros(len(cut) - 1, dtype=np.int64)
        some = cut[1:] > cut[:-1]
        top[some] = np.maximum.reduceat(value, cut[:-1][some]) if some.any() else 0
        return cut, top


def accumulators(shard: Shard, terms: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: (documents, summed impacts) of the given lists."""
    lists = [shard.postings(t, r) for t, r in zip(terms, repeats)]
    of = np.concatenate([x for x, _ in lists]) if lists else np.empty(0, np.int64)
    value = np.concatenate([x for _, x in lists]) if lists else np.empty(0, np.int64)
    order = np.argsort(of, kind="stable")
    of, value = of[order], value[order]
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.empty(0, np.int64)
    return of[starts], np.add.reduceat(value, starts) if len(starts) else value


class Best:
    """An item's best documents so far: score descending, doc_id ascending, null ids last."""

    def __init__(self, top: int):
        self.top, self.rows = top, np.empty(0, dtype=_ID)

    @property
    def floor(self) -> int:
        """No document below this score can enter."""
        return int(self.rows["score"][-1]) if len(self.rows) == self.top else 1

    def offer(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        new = np.empty(len(score), dtype=_ID)
        new["score"], new["null"], new["doc"] = score, null, doc
        rows = np.concatenate((self.rows, new))
        self.rows = rows[np.lexsort((rows["doc"], rows["null"], -rows["score"]))[:self.top]]


def rank_in_shard(shard: Shard, terms: np.ndarray, repeats: np.ndarray, best: Best) -> None:
    """Enter the shard's documents into an item's ``best`` (see the module's step 3)."""
    length = shard.length(terms)
    short = length * SHORT < len(shard.docs)
    summed = accumulators(shard, terms[short], repeats[short])
    lists = [summed, *(shard.postings(t, r) for t, r in zip(terms[~short], repeats[~short]))]
    lists = [x for x in lists if len(x[0])]
    if not lists:
        return
    cuts, tops = map(np.stack, zip(*(shard.bounds(*x) for x in lists)))
    floor = best.floor
    if len(summed[1]) >= best.top:  # a partial sum never exceeds its document's score
        floor = max(floor, int(np.partition(summed[1], -best.top)[-best.top]))
    reach = tops.sum(axis=0)
    for span in range(len(reach)):
        if reach[span] < floor:
            continue
        base = span * SPAN
        order = np.argsort(tops[:, span], kind="stable")
        below = np.cumsum(tops[order, span])
        score = np.zeros(SPAN, dtype=np.int64)
        first = int(np.searchsorted(below, floor))  # lists before it can't lift a document alone
        for i in order[first:]:
            a, b = cuts[i, span], cuts[i, span + 1]
            score[lists[i][0][a:b] - base] += lists[i][1][a:b]
        left = np.flatnonzero(score)
        for j in range(first - 1, -1, -1):
            left = left[score[left] + below[j] >= floor]
            if not len(left):
                break
            i = order[j]
            a, b = cuts[i, span], cuts[i, span + 1]
            of, value = lists[i][0][a:b] - base, lists[i][1][a:b]
            at = np.searchsorted(of, left)
            at[at == len(of)] = 0
            hit = of[at] == left if len(of) else np.zeros(len(left), dtype=bool)
            score[left[hit]] += value[at[hit]]
        left = left[score[left] >= floor]
        if len(left):
            best.offer(score[left], shard.null[base + left], shard.docs[base + left])
            floor = max(floor, best.floor)


def _ranked(index: DataFrame, asked: list[tuple], keys: pa.Array, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of every asked item."""
    sent = index.sparkSession.sparkContext.broadcast((asked, keys, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, keys, weights = sent.value
        best = [Best(top) for _ in asked]

        def flush(parts: list[pa.RecordBatch]) -> None:
            whole = pa.Table.from_batches(parts).combine_chunks()
            n, lists = whole.column("n").to_numpy(), [whole.column(c).chunk(0) for c in ("terms", "times")]
            term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            of = np.repeat(np.arange(len(n)), np.diff(lists[0].offsets.to_numpy()))
            m = 25 + (75 * n * n_docs) // n_terms
            doc = whole.column("doc").combine_chunks()
            null = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int8)
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
            shard = Shard(doc.fill_null(0).to_numpy(zero_copy_only=False), null, of, term, impact, len(weights))
            for (terms, repeats), entered in zip(asked, best):
                rank_in_shard(shard, terms, repeats, entered)

        parts, size = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
                size += len(batch.column("terms").flatten())
            if size >= SHARD_POSTINGS:
                flush(parts)
                parts, size = [], 0
        if parts:
            flush(parts)
        item = np.repeat(np.arange(len(best)), [len(b.rows) for b in best])
        rows = np.concatenate([b.rows for b in best]) if best else np.empty(0, dtype=_ID)
        yield pa.RecordBatch.from_arrays(
            [keys.take(pa.array(item)), pa.array(rows["doc"].copy(), mask=rows["null"] == 1), pa.array(rows["score"].copy())],
            ["item_id", "doc_id", "score"])

    return index.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def _blocks(terms: DataFrame, size: int) -> Iterator[pa.Table]:
    """The items' terms in blocks of about ``size`` rows; an item is never cut."""
    total = terms.count()
    many = max(1, math.ceil(total / size))
    block = F.pmod(F.xxhash64("item"), F.lit(many))
    for b in range(many if total else 0):
        found = terms.where(block == b).toArrow()
        if found.num_rows:
            yield found.combine_chunks()


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0.

    Terms are runs of ASCII letters, digits and non-ASCII characters of the whole text, A-Z
    lower-cased, compared by a 64-bit hash. Equal scores rank by ascending doc_id, null ids
    last; rows that repeat a doc_id are documents of their own. Items without terms, and
    items whose terms no document has, give no rows; rows that share an item_id are one
    item of all their different texts; a null item_id is an item. Null or empty texts have
    no terms. An empty table of either kind gives no rows. A very long text is worked on
    alone; one item must fit into a task. Other columns are not carried.
    """
    spark = docs.sparkSession
    terms = written(item_terms(items, item_key, item_text), "item-terms")
    found = None
    for block in _blocks(terms, block_terms):
        hashes = block.column("term").to_numpy().view(np.uint64)
        vocabulary = np.unique(hashes)
        index = written(forward_index(docs, vocabulary, key, text), "forward-index")
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_frequencies(index, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], dtype=np.int64)
        codes = block.column("item").combine_chunks().dictionary_encode("encode")
        place, repeats = np.searchsorted(vocabulary, hashes), block.column("repeats").to_numpy()
        item = codes.indices.to_numpy(zero_copy_only=False)
        told = weights[place] > 0
        order = np.argsort(item[told], kind="stable")
        cut = np.searchsorted(item[told][order], np.arange(1, len(codes.dictionary)))
        asked = list(zip(np.split(place[told][order], cut), np.split(repeats[told][order], cut)))
        part = written(_ranked(index, asked, codes.dictionary, weights, n_docs, n_terms, top), "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    # an item has `top` rows a task: shares of them are cut down first
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    found = found.withColumn("_r", F.row_number().over(share)).where(F.col("_r") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")
