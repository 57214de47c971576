"""MinHash near-duplicates by a signature-coordinate inverted join.

1. One pass makes every document's set of word shingles: its size, a 128-bit set
   fingerprint and a signature of ``BINS`` coordinates (one permutation, binned: the least
   hash in each bin). Documents with equal sets form a class; the one with the least key
   stands for it.
2. Class members are posted under each (coordinate, value). A pair of similarity t or more
   differs in at most `allowed` coordinates, so it agrees within the ``allowed + 1`` rarest
   of either member. Values that a single document has can't agree and are only counted;
   a document with more than ``allowed`` of them is skipped.
3. Every member of a prefix list meets the list's leader (the one with the fewest lone
   coordinates). Pairs with enough equal coordinates are confirmed on the full sets, and
   the links give components.
4. The rest: members of lists that still hold several components are posted once more,
   under the rarest of their shingles that a link can't miss, and only pairs of different
   components that can still reach the threshold from their positions are formed, matched
   and confirmed. That leaves out no link that could join two components, and it never
   pairs the members of a group with each other.

The only loss is that of the signature: a pair at the threshold differs in more than
`allowed` coordinates with a probability below 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.store import splittable, written
from quarry.llm.textops import LOWER_AZ, WORD_BASE, Words, mix, signed, slices, window_hashes

BINS = 64
#: standard deviations of the binomial mismatch count that the match threshold leaves room for
MARGIN = 5.0
#: document ids that are sent to the tasks (16 bytes each) to pick their texts
SENT_IDS = 2_000_000
_BIN_BITS = BINS.bit_length() - 1


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; a link at ``100 * intersection >= percent * union``."""

    words: int = 5
    percent: int = 80

    def allowed(self, n: Column) -> Column:
        """Most coordinates in which a linked partner of a set of ``n`` shingles may differ:
        each shingle in one set only spoils one coordinate at most, and among many
        shingles the count is at most binomial."""
        t = self.percent / 100
        union = F.least(F.lit(float(BINS)), n / F.lit(t))
        chance = F.ceil(union * (1 - t) + F.sqrt(union * (t * (1 - t))) * MARGIN)
        sure = F.floor(n * (100 - self.percent) / F.lit(self.percent))
        return F.least(chance, sure).cast("int")


def _sets(w: Words, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every distinct shingle, sorted by row and hash."""
    h = w.hash
    n = len(h) - size + 1
    row = shingle = np.empty(0, dtype=np.int64)
    if n > 0:
        shingle = mix(window_hashes(h, size) + np.uint64(size))
        inside = w.row[:n] == w.row[size - 1:]
        row, shingle = w.row[:n][inside], shingle[inside]
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = np.zeros(len(short), dtype=np.uint64)
    for i in range(size - 1):  # the whole sequence of a short text is its one shingle
        has = counts[short] > i
        whole[has] = whole[has] * WORD_BASE + h[w.first[short[has]] + i]
    row = np.concatenate((row, short))
    shingle = np.concatenate((shingle.astype(np.uint64), mix(whole + counts[short].astype(np.uint64))))
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    return row[new], shingle[new]


def signatures(docs: DataFrame, like: Likeness, key: str, text: str) -> DataFrame:
    """(doc, n, fp1, fp2, sig) per row with a key: set size, fingerprint, coordinates (-1: the
    bin is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            rows = part.num_rows
            row, shingle = _sets(Words(data, offs, fold=LOWER_AZ), rows, like.words)
            at = np.searchsorted(row, np.arange(rows + 1))
            prints = []
            for seed in (0x632BE59BD9B4E019, 0x8CB92BA72F3D8DD7):
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(shingle ^ np.uint64(seed)), dtype=np.uint64)))
                prints.append(sums[at[1:]] - sums[at[:-1]])
            g = mix(shingle + np.uint64(0xE7037ED1A0B428DB))
            sig = np.full(rows * BINS, 0x7FFFFFFF, dtype=np.int64)
            cell = row * BINS + (g >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
            np.minimum.at(sig, cell, ((g << np.uint64(_BIN_BITS)) >> np.uint64(33)).astype(np.int64))
            sig[sig == 0x7FFFFFFF] = -1
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BINS), pa.array(sig.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(np.diff(at).astype(np.int64)), *map(signed, prints), lists],
                                             ["doc", "n", "fp1", "fp2", "sig"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, "doc bigint, n bigint, fp1 bigint, fp2 bigint, sig array<int>")


def _confirmed(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (x, y) whose full shingle sets are similar enough."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(iter([batch]), "tx"):
                row, shingle = _sets(Words(data, offs, fold=LOWER_AZ), part.num_rows, like.words)
                lo = 0
                for other, data2, offs2 in slices(iter([part]), "ty"):
                    n = other.num_rows
                    row2, shingle2 = _sets(Words(data2, offs2, fold=LOWER_AZ), n, like.words)
                    a, b = np.searchsorted(row, [lo, lo + n])
                    # equal (row, shingle) of both sides meet next to each other
                    rows = np.concatenate((row[a:b] - lo, row2))
                    both = np.concatenate((shingle[a:b], shingle2))
                    order = np.lexsort((both, rows))
                    rows, both = rows[order], both[order]
                    twice = rows[1:][(rows[1:] == rows[:-1]) & (both[1:] == both[:-1])]
                    inter = np.bincount(twice, minlength=n)
                    union = np.bincount(rows, minlength=n) - inter
                    good = pa.array((100 * inter >= like.percent * union) & (inter > 0))
                    yield other.select(["x", "y"]).filter(good)
                    lo += n

    withtexts = (pairs.join(texts.select(F.col("doc").alias("x"), F.col("_text").alias("tx")), "x")
                 .join(texts.select(F.col("doc").alias("y"), F.col("_text").alias("ty")), "y"))
    return withtexts.select("x", "y", "tx", "ty").mapInArrow(judge, "x bigint, y bigint")


def _matching(pairs: DataFrame, reps: DataFrame, like: Likeness) -> DataFrame:
    """Distinct pairs (x, y) that agree in as many coordinates as a link may need."""
    side = lambda p: reps.select(F.col("doc").alias(p), F.col("n").alias(f"n{p}"), F.col("sig").alias(f"s{p}"))
    joined = pairs.select("x", "y").distinct().join(side("x"), "x").join(side("y"), "y")
    equal = F.aggregate(F.zip_with("sx", "sy", lambda a, b: F.when((a == b) & (a >= 0), 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    filled = F.aggregate(F.zip_with("sx", "sy", lambda a, b: F.when((a >= 0) | (b >= 0), 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    room = F.least(like.allowed(F.col("nx")), like.allowed(F.col("ny")))
    return joined.where(filled - equal <= room).select("x", "y")


def _prefix_lists(elements: DataFrame, facts: DataFrame) -> DataFrame:
    """Postings (doc, n, room, filled, lone, c, at): each document under the ``room + 1`` rarest
    of its ``filled`` elements, less the ``lone`` ones that only it has. ``elements``: (doc, c),
    ``facts``: (doc, n, room, filled)."""
    common = elements.groupBy("c").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1").select(splittable("c").alias("k"), "docs")
    mine = elements.join(common, splittable("c") == F.col("k")).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("docs", "c"))).alias("shared"))
    lone = F.col("filled") - F.size("shared")
    return (facts.join(mine, "doc").where(lone <= F.col("room"))
            .select("doc", "n", "room", "filled", lone.alias("lone"),
                    F.posexplode(F.slice("shared", F.lit(1), (F.col("room") + 1 - lone).cast("int"))).alias("i", "e"))
            .select("doc", "n", "room", "filled", "lone", F.col("e.c").alias("c"), (F.col("lone") + F.col("i")).alias("at")))


def _rest(x: str, y: str) -> Column:
    """Most elements that two postings of a list can share, the list's being their rarest one."""
    return F.least(F.col(f"{x}.filled") - F.col(f"{x}.at"), F.col(f"{y}.filled") - F.col(f"{y}.at"))


def _sizes_fit(x: str, y: str, like: Likeness) -> Column:
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return F.least(nx, ny) * 100 >= F.greatest(nx, ny) * like.percent


def _shingles(texts: DataFrame, like: Likeness) -> DataFrame:
    """(doc, c) per distinct shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            row, shingle = _sets(Words(data, offs, fold=LOWER_AZ), part.num_rows, like.words)
            yield pa.RecordBatch.from_arrays([part.column("doc").take(pa.array(row)), signed(shingle)], ["doc", "c"])

    return texts.mapInArrow(run, "doc bigint, c bigint")


def _fetched(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc, _text) whose ``doc`` is in ``ids``: up to ``SENT_IDS`` ids are sent to
    the scan, so that other texts stay where they are; more are joined."""
    ids = written(ids.select("doc").distinct(), "wanted")
    return written(docs.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "doc"), "texts")


def _size_class(n: Column, like: Likeness) -> Column:
    """Sets whose classes differ by more than one can't be a link."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / like.percent))


def _other_components(texts: DataFrame, facts: DataFrame, labels: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (x, y) of ``labels`` (doc, component) in different components that can be a link,
    by the exact prefix filter on their full sets. Lists are cut by size class, and a posting
    that can't reach the threshold with any member of a list's class is dropped before pairs
    are formed: members of a large list that share much, but not enough, never meet."""
    t = like.percent
    own = facts.join(labels, "doc").select("doc", "n", "component")
    exact = own.select("doc", "n", (F.col("n") - F.ceil(F.col("n") * t / 100)).alias("room"), F.col("n").alias("filled"))
    shingles = _shingles(texts.join(labels.select("doc"), "doc", "left_semi"), like)
    posts = _prefix_lists(shingles, exact).join(labels, "doc").select("c", "component", F.struct("doc", "n", "filled", "at").alias("p"))
    posts = written(posts, "shingle-postings")
    sizes = posts.groupBy("c", "component").agg(F.count(F.lit(1)).alias("k"))
    major = (sizes.groupBy("c").agg(F.max(F.struct("k", "component")).alias("m"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select(splittable("c").alias("k"), F.col("m.component").alias("major")))
    several = posts.join(major, splittable("c") == F.col("k")).drop("k")
    # each list's greatest component meets the others, but not itself
    rest = F.col("p.filled") - F.col("p.at")
    own_class = _size_class(F.col("p.n"), like)
    left = several.where("component <> major").select("c", F.col("component").alias("cx"), F.col("p").alias("x"), rest.alias("rx"),
                                                      F.explode(F.array(own_class - 1, own_class, own_class + 1)).alias("size"))
    right = several.select("c", F.col("component").alias("cy"), "major", F.col("p").alias("y"), rest.alias("ry"), own_class.alias("size"))
    reach = lambda side, r: side.groupBy("c", "size").agg(F.min(F.col(f"{'x' if r == 'rx' else 'y'}.n")).alias("least"), F.max(r).alias("most")).select(
        splittable("c").alias("kc"), F.col("size").alias("ks"), "least", "most")
    hopeful = lambda n, r: F.least(F.col(r), F.col("most")) * (100 + t) >= (F.col(n) + F.col("least")) * t
    near = lambda side, other: side.join(other, (splittable("c") == F.col("kc")) & (F.col("size") == F.col("ks")))
    left = near(left, reach(right, "ry")).where(hopeful("x.n", "rx")).select("c", "size", "cx", "x")
    left = written(left, "left-postings")
    right = near(right, reach(left.withColumn("rx", F.col("x.filled") - F.col("x.at")), "rx")).where(hopeful("y.n", "ry"))
    enough = _rest("x", "y") * (100 + t) >= (F.col("x.n") + F.col("y.n")) * t
    once = (F.col("cy") == F.col("major")) | (F.col("x.doc") < F.col("y.doc"))
    return (left.join(right.select("c", "size", "cy", "major", "y"), ["c", "size"])
            .where((F.col("cx") != F.col("cy")) & once & enough & _sizes_fit("x", "y", like))
            .select(F.least("x.doc", "y.doc").alias("x"), F.greatest("x.doc", "y.doc").alias("y")))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``.

    Words are lower-cased (A-Z) runs of other bytes than space and U+0009..U+000D; a text
    with fewer words than a shingle has their whole sequence as its one shingle. Texts
    that are null, empty or without words have 0 shingles and are linked with nothing, and
    so is a row with a null key (its component is null). Rows that repeat a key are one
    document if their texts agree. Other columns are not carried; an empty table gives no
    rows. Keys are integers.
    """
    kind = dict(docs.dtypes)[key]
    sets = written(signatures(docs, like, key, text), "signatures")
    # one member of each class of equal sets
    reps = (sets.where("n > 0 and doc is not null").groupBy("n", "fp1", "fp2")
            .agg(F.min("doc").alias("doc"), F.first("sig").alias("sig")))
    reps = written(reps, "classes")
    coords = reps.select("doc", F.posexplode("sig").alias("bin", "value")).where("value >= 0").select(
        "doc", (F.col("bin") * F.lit(1 << 32) + F.col("value")).alias("c"))
    facts = reps.select("doc", "n", like.allowed(F.col("n")).alias("room"), F.size(F.filter("sig", lambda v: v >= 0)).alias("filled"))
    posts = written(_prefix_lists(coords, facts), "postings")
    texts = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("_text"))
    both = lambda pairs: pairs.select(F.explode(F.array("x", "y")).alias("doc"))

    member = F.struct("lone", "doc", "n", "filled", "room", "at")
    leaders = posts.groupBy("c").agg(F.min(member).alias("y"), F.count(F.lit(1)).alias("members")).where("members > 1")
    leaders = leaders.select(splittable("c").alias("k"), "y")
    enough = _rest("x", "y") >= F.greatest(F.col("x.filled") - F.col("x.room"), F.col("y.filled") - F.col("y.room"))
    to_leader = (posts.select("c", member.alias("x")).join(leaders, splittable("c") == F.col("k"))
                 .where((F.col("x.doc") != F.col("y.doc")) & enough & _sizes_fit("x", "y", like))
                 .select(F.least("x.doc", "y.doc").alias("x"), F.greatest("x.doc", "y.doc").alias("y")))
    ends = [F.col("x").alias("a"), F.col("y").alias("b")]
    matched = written(_matching(to_leader, reps, like), "matched")
    links = written(_confirmed(matched, _fetched(texts, both(matched)), like).select(*ends), "links")
    parts = components(links)

    # the rest: members of lists that hold several components
    labelled = written(posts.join(parts.withColumnRenamed("id", "doc"), "doc", "left")
                       .select("c", "doc", F.coalesce("component", "doc").alias("component")), "labelled")
    several = labelled.groupBy("c").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select(splittable("c").alias("k"))
    open_docs = written(labelled.join(several, splittable("c") == F.col("k")).select("doc", "component").distinct(), "open")
    texts = _fetched(texts, open_docs)
    matched = _matching(_other_components(texts, facts, open_docs, like), reps, like)
    more = written(_confirmed(matched, texts, like).select(*ends), "links")
    parts = components(links.unionByName(more))

    classes = reps.join(parts.select(F.col("id").alias("doc"), "component"), "doc", "left").select(
        "n", "fp1", "fp2", F.coalesce("component", "doc").alias("component"))
    found = sets.drop("sig").join(classes, ["n", "fp1", "fp2"], "left")
    return found.select(F.col("doc").cast(kind).alias(key), F.col("n").alias("n_shingles"),
                        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).cast(kind).alias("component_id"))
