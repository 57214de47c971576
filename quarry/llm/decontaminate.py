"""Benchmark decontamination by template canonicalisation.

Numbers, names and units are replaced by typed placeholders, so a question whose values
were changed keeps its template. Which words are names can't be told from one text (any
word may open a sentence, a copy may be wrapped otherwise or lower-cased), so there are
three template forms of every text. Windows of ``WINDOW`` template tokens of the benchmark
are hash-joined with those of the corpus; each joined window also carries the values behind
its placeholders. A re-parameterised copy replaces every value by one other value
throughout (a number by one for each word it counts), so windows with another value than
the rest of their alignment don't count.

Only corpus windows whose bit is set in a bitmap of the benchmark's hashes leave the scan
(``BITMAP_BITS`` bits, whatever the benchmark's size; more hashes only let more through to
the exact join). Items shorter than a window are one window of their own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.licenses import plain_words
from quarry.llm.store import written
from quarry.llm.textops import LOWER_AZ, Words, mix, signed, slices, span_hashes, window_hashes

WINDOW = 8
#: least words of a window that are no placeholder, for it to match with other values
LITERALS = 4
EXACT = np.uint64(0x9FB21C651E98DF25)
#: least share of an item's windows that must stand in a text on near alignments
COVERAGE = 0.3
BITMAP_BITS = 1 << 24
#: least share of a role's windows that have its most frequent value
AGREED = 2 / 3
#: alignments that differ by so many tokens and an eighth of the item's are of one passage
NEAR_SHIFT = 8
#: items of fewer tokens are also posted in windows of ``SHORT`` tokens ...
SHORT_ITEM = 64
SHORT = 5
#: ... and found as well if so much of their tokens stands in matched windows on near alignments
NEARLY = 0.8

#: fixed values: unit words, recognised after a number
UNITS = """mm cm m km inch inches in ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs
pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour
hours day days week weeks month months year years hz khz mhz ghz kb mb gb tb w kw kwh v volt volts amp amps ohm pa kpa bar mph kmh
kph percent degree degrees celsius fahrenheit kelvin cent cents dollar dollars euro euros usd eur gbp""".split()

_PLACEHOLDER = {name: mix(np.array([i + 1], dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))[0] for i, name in enumerate(("number", "name", "unit"))}
_DIGITISH = np.zeros(256, dtype=bool)
_DIGITISH[[*range(48, 58), *b".,:/%-"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[*b".!?:;", 0x0A]] = True


def _unit_hashes() -> np.ndarray:
    joined = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
    return np.sort(Words(joined, np.array([0, len(joined)])).hash)


_UNIT_HASHES = _unit_hashes()


def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower case of the same UTF-8 length, is upper, is lower) by code point up to U+FFFF."""
    low = np.arange(1 << 16, dtype=np.uint32)
    upper, lower = np.zeros(1 << 16, dtype=bool), np.zeros(1 << 16, dtype=bool)
    for c in range(1 << 16):
        ch = chr(c)
        upper[c], lower[c] = ch.isupper(), ch.islower()
        if upper[c] and len(ch.lower()) == 1 and len(ch.lower().encode()) == len(ch.encode()):
            low[c] = ord(ch.lower())
    return low, upper, lower


_LOWER, _IS_UPPER, _IS_LOWER = _letters()


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, upper, lower): the flags stand at the first byte of a letter."""
    out = LOWER_AZ[data]
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    for at, width in ((np.flatnonzero((data >= 0xC2) & (data < 0xE0)), 2), (np.flatnonzero((data >= 0xE0) & (data < 0xF0)), 3)):
        if len(at):
            code = data[at].astype(np.uint32) & (0x1F if width == 2 else 0x0F)
            for k in range(1, width):
                code = code << 6 | data[at + k] & 0x3F
            upper[at], lower[at] = _IS_UPPER[code], _IS_LOWER[code]
            low = _LOWER[code]
            for k in range(width - 1, 0, -1):
                out[at + k] = 0x80 | low & 0x3F
                low = low >> 6
            out[at] = (0xC0 if width == 2 else 0xE0) | low
    return out, upper, lower


#: scripts written without spaces: a character is a word (ranges of code points)
UNSEGMENTED = ((0x0E00, 0x0E7F), (0x0E80, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF),
               (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F))
WIDE_PUNCTUATION = ((0x3000, 0x3004), (0x3008, 0x303F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
WIDE_STOPS = (0x3002, 0xFF01, 0xFF1A, 0xFF1B, 0xFF1F, 0xFF61)
_SPLIT = np.zeros(1 << 16, dtype=np.uint8)  # 1 a word of its own, 2 no part of a word, 3 also ends a sentence
for _kind, _ranges in ((1, UNSEGMENTED), (2, WIDE_PUNCTUATION), (3, [(c, c) for c in WIDE_STOPS])):
    for _lo, _hi in _ranges:
        _SPLIT[_lo:_hi + 1] = _kind


def split_words(w: Words, stops: np.ndarray) -> None:
    """Cut the words of ``w`` around each character of an unsegmented script, drop wide
    punctuation, and mark in ``stops`` the bytes at which such a sentence ends."""
    data = w.data
    at = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    code = (data[at].astype(np.uint32) & 0x0F) << 12 | (data[at + 1].astype(np.uint32) & 0x3F) << 6 | data[at + 2] & 0x3F
    kind = _SPLIT[code]
    rare = np.flatnonzero(data == 0xF0)  # the ideographs beyond U+FFFF
    rare = rare[data[rare + 1] >= 0xA0]
    if not kind.any() and not len(rare):
        return
    stops[at[kind == 3]] = True
    cuts = np.unique(np.concatenate((at[kind > 0], at[kind > 0] + 3, rare, rare + 4)))
    inside = np.searchsorted(w.start, cuts, "right") - 1
    cuts = cuts[(inside >= 0) & (cuts > w.start[inside]) & (cuts < w.end[inside])]
    start, end = np.union1d(w.start, cuts), np.union1d(w.end, cuts)
    row = w.row[np.searchsorted(w.start, start, "right") - 1]
    keep = ~np.isin(start, at[kind > 1])
    w.start, w.end, w.row = start[keep], end[keep], row[keep]


@dataclass
class Form:
    """One template form of the texts of a slice. Per token: ``row``, ``token`` and ``value`` hash,
    ``role`` (what has to keep to one value: a number with the word it counts, else the
    value itself), ``slot`` (is a placeholder), ``opens``. ``before[i]``: words before token ``i`` that
    the first form takes otherwise."""

    row: np.ndarray
    token: np.ndarray
    value: np.ndarray
    role: np.ndarray
    slot: np.ndarray
    opens: np.ndarray
    before: np.ndarray


def bit_set(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = (h >> np.uint64(40)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def template_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end, hash, number, unit, capital, opens, breaks) per word, and the lower-cased
    bytes: ``capital`` a capital and then a lower-case letter, ``opens`` first of a
    sentence, a line or a text, ``breaks`` first of a sentence, a paragraph or a text."""
    w = Words(data, offs)
    low, upper, lower = folded(data)
    w.data = low
    ends = _STOP[data]
    split_words(w, ends)
    row, start, end, h = plain_words(w)
    odd = np.concatenate(([0], np.cumsum(~_DIGITISH[data])))
    lead = data[start]
    number = (lead >= 48) & (lead <= 57) & (odd[end] == odd[start])
    after_number = np.zeros(len(row), dtype=bool)
    after_number[1:] = number[:-1] & (row[1:] == row[:-1])
    unit = after_number & np.isin(h, _UNIT_HASHES)
    stops = np.concatenate(([0], np.cumsum(ends)))
    lines = np.concatenate(([0], np.cumsum(data == 0x0A)))
    opens, breaks = np.ones(len(row), dtype=bool), np.ones(len(row), dtype=bool)
    other = row[1:] != row[:-1]
    stop, line = stops[start[1:]] - stops[end[:-1]], lines[start[1:]] - lines[end[:-1]]
    opens[1:] = other | (stop > 0)
    breaks[1:] = other | (stop > line) | (line > 1)
    second = start + np.where(lead < 0xC2, 1, np.where(lead < 0xE0, 2, 3))
    capital = upper[start] & (second < end) & lower[np.minimum(second, len(data) - 1)] if len(row) else np.zeros(0, dtype=bool)
    return row, start, end, h, number, unit, capital, opens, breaks, low


def template_forms(data: np.ndarray, offs: np.ndarray, known: np.ndarray) -> list[Form]:
    """The texts of a slice in three template forms.

    A number is a word of digits and their separators; a unit is a unit word after a
    number. Names: in the first form capitalised words that don't begin a sentence or a
    line, in the second one all capitalised words, in the third one the words of the
    bitmap ``known``, in any case. A run of names in a sentence is one token.
    """
    row, start, end, h, number, unit, capital, opens, breaks, low = template_words(data, offs)
    follows = np.zeros(len(row), dtype=np.uint64)
    follows[:-1] = np.where(unit[1:], _PLACEHOLDER["unit"], h[1:])
    forms: list[Form] = []
    first: tuple[np.ndarray, np.ndarray] | None = None
    for name in (capital & ~opens, capital & ~unit, bit_set(known, h) & ~number & ~unit):
        token, value = h.copy(), h.copy()
        for flag, kind in ((number, "number"), (unit, "unit"), (name, "name")):
            token[flag] = _PLACEHOLDER[kind]
        # names in a row are one token, its value that of the whole run
        inner = np.zeros(len(row), dtype=bool)
        inner[1:] = name[1:] & name[:-1] & ~breaks[1:]
        first = first or (token, inner)
        keep = np.flatnonzero(~inner)
        last = np.append(keep[1:], len(row)) - 1
        multi = np.flatnonzero(last > keep)
        if len(multi):
            value[keep[multi]] = span_hashes(low, start[keep[multi]], end[last[multi]])
        role = np.where(number, mix(value + follows * np.uint64(3)), value)
        differs = np.concatenate(([0], np.cumsum((token != first[0]) | (inner != first[1]))))
        forms.append(Form(row[keep], token[keep], value[keep], role[keep], (number | unit | name)[keep], opens[keep], differs[np.append(keep, len(row))]))
    return forms


def _windows(texts: DataFrame, lengths: list[int], known: np.ndarray, bitmap: np.ndarray | None) -> DataFrame:
    """(id, at, len, h, tokens, exact, slots, roles) per window of ``lengths`` tokens of every form.
    A window without enough literal words is ``exact``: its hash is that of the words
    themselves. One of fewer than ``LITERALS`` tokens, which could stand anywhere, is only
    taken if sentence or line borders stand before and after it. Of the texts to be searched, those that pass ``bitmap``, a window
    that two forms share once; without a bitmap, of the items: windows that are whole texts
    of that length, have the first (greatest) length, or the ``SHORT`` one in texts below
    ``SHORT_ITEM`` tokens. ``slots``, ``roles``: value and role hashes of the placeholders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            for i, form in enumerate(template_forms(data, offs, known)):
                yield found(part, form, bitmap is None or i == 0)

    def found(part: pa.RecordBatch, form: Form, whole: bool) -> pa.RecordBatch:
        row, slot = form.row, form.slot
        first = np.searchsorted(row, np.arange(part.num_rows + 1))
        size = np.diff(first)
        literal = np.concatenate(([0], np.cumsum(~slot)))
        slots_before = np.concatenate(([0], np.cumsum(slot)))
        alone = np.append(form.opens, True)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))]
        for n in lengths:
            if len(row) < n:
                continue
            exact = literal[n:] - literal[:-n] < LITERALS
            h = mix(np.where(exact, window_hashes(form.value, n) + EXACT, window_hashes(form.token, n)) + np.uint64(n))
            good = row[n - 1:] == row[:len(row) - n + 1]
            if n < LITERALS:
                good &= alone[:-n] & alone[n:]
            if bitmap is not None:
                at = np.flatnonzero(good if whole else good & (form.before[n:] > form.before[:-n]))
                at = at[bit_set(bitmap, h[at])]
            else:
                at = np.flatnonzero(good)
                if n < WINDOW:
                    at = at[(size[row[at]] == n) | (n == SHORT) & (size[row[at]] >= WINDOW) & (size[row[at]] < SHORT_ITEM)]
            out.append((at, np.full(len(at), n), h[at], exact[at]))
        at, n, h, exact = (np.concatenate(x) for x in zip(*out))
        lo, hi = slots_before[at], slots_before[at + n]
        ends = np.cumsum(hi - lo)
        flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        lists = [pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(x[slot].view(np.int64)[flat]))
                 for x in (form.value, form.role)]
        return pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(row[at])), pa.array((at - first[row[at]]).astype(np.int64)),
             pa.array(n.astype(np.int32)), signed(h), pa.array(size[row[at]].astype(np.int32)), pa.array(exact), *lists],
            ["id", "at", "len", "h", "tokens", "exact", "slots", "roles"])

    return texts.mapInArrow(run, "id bigint, at bigint, len int, h bigint, tokens int, exact boolean, slots array<bigint>, roles array<bigint>")


def _lengths(benchmark: DataFrame, known: np.ndarray) -> list[int]:
    """``WINDOW``, then ``SHORT`` and the token counts of items shorter than a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            for form in template_forms(data, offs, known):
                yield pa.RecordBatch.from_arrays([pa.array(np.bincount(form.row, minlength=part.num_rows))], ["n"])

    short = benchmark.mapInArrow(run, "n bigint").where(F.col("n").between(1, WINDOW - 1)).distinct().collect()
    return [WINDOW, *sorted({SHORT, *(r.n for r in short)}, reverse=True)]


def _names(benchmark: DataFrame) -> DataFrame:
    """(h) of the words that stand as names in the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offs in slices(batches, "_text"):
            _, _, _, h, _, unit, capital, opens, _, _ = template_words(data, offs)
            yield pa.RecordBatch.from_arrays([signed(np.unique(h[capital & ~opens & ~unit]))], ["h"])

    return benchmark.mapInArrow(run, "h bigint")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bits of the column ``h``: at most BITMAP_BITS / 32 words come to the driver."""
    bit = F.shiftrightunsigned("h", 40)
    words = (hashes.select(F.shiftright(bit, 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(31)).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    bitmap = np.zeros(BITMAP_BITS // 32, dtype=np.uint32)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return bitmap.view(np.uint8)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """(key, item_key, coverage, windows, first_token, reparameterised): one row per text and
    item of which at least ``coverage`` of the windows stand in the text on alignments near
    each other with consistent values, or, for items below ``SHORT_ITEM`` tokens, at least
    ``NEARLY`` of the tokens in windows of ``WINDOW`` or ``SHORT`` tokens.

    ``reparameterised`` tells that some value differs. Null and empty texts, and rows with a
    null key on either side, have no rows. Windows with fewer than ``LITERALS`` literal words
    match only word by word; ``coverage`` is the greater of the shares of all windows and
    of those that can match with other values. An item of fewer than ``LITERALS`` tokens
    is found where it is a line or a sentence of its own. Rows that repeat a key count as one.
    Other columns are not carried. Keys are integers.
    """
    kinds = dict(docs.dtypes)[key], dict(benchmark.dtypes)[item_key]
    side = lambda df, k, t: df.where(F.col(k).isNotNull()).select(F.col(k).cast("bigint").alias("id"), F.col(t).alias("_text"))
    items = side(benchmark, item_key, item_text)
    known = _bitmap(_names(items))
    lengths = _lengths(items, known)
    wanted = _windows(items, lengths, known, None)
    found = _windows(side(docs, key, text), lengths, known, _bitmap(wanted))
    b = wanted.distinct().select(F.col("id").alias("item"), F.col("at").alias("iat"), "len", "h", "tokens", "exact", F.col("slots").alias("islots"), F.col("roles").alias("iroles"))
    # its main windows are the longest ones; ``free`` of them can match with other values
    total = (b.groupBy("item", "len", "iat").agg(F.min("exact").alias("exact"), F.max("tokens").alias("tokens"))
             .groupBy("item", "len").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("exact")).alias("free"), F.max("tokens").alias("tokens")).groupBy("item")
             .agg(F.max("len").alias("main"), F.max_by("n", "len").alias("total"), F.max_by("free", "len").alias("free"), F.max("tokens").alias("tokens")))
    # written, so that the corpus is scanned once
    hits = written(found.drop("tokens", "exact", "roles").join(b.drop("tokens"), ["h", "len"]).where(F.size("slots") == F.size("islots"))
            .select("id", "item", (F.col("at") - F.col("iat")).alias("shift"), "iat", "len", "exact", F.arrays_zip(F.col("iroles").alias("r"), F.col("islots").alias("b"), F.col("slots").alias("d")).alias("pairs")), "benchmark-hits")
    # what each role of an alignment goes to (at most the item's placeholders): the value of most
    # of its windows; windows with another value, or with a role that has none, don't count
    agreed = (hits.select("id", "item", "shift", F.explode("pairs").alias("p")).groupBy("id", "item", "shift", "p.r", "p.d").agg(F.count(F.lit(1)).alias("k"))
              .groupBy("id", "item", "shift", "r").agg(F.max_by("d", F.struct("k", "d")).alias("d"), (F.max("k") / F.sum("k")).alias("most"))
              .where(F.col("most") >= AGREED)
              .groupBy("id", "item", "shift").agg(F.map_from_entries(F.collect_list(F.struct("r", "d"))).alias("agreed")))
    fits = (hits.join(agreed, ["id", "item", "shift"], "left")
            .where(F.coalesce(F.forall("pairs", lambda p: F.col("agreed")[p["r"]] == p["d"]), F.lit(False)))
            .select("id", "item", "shift", "iat", "len", "exact", F.exists("pairs", lambda p: p["b"] != p["d"]).alias("other")))
    # an added or missing word shifts the rest of a passage: alignments near each other add up, in
    # two grids of bands, so that any ``reach`` neighbouring shifts lie in one band
    reach = NEAR_SHIFT + F.floor(F.col("tokens") / 8)
    bands = fits.join(total, "item").select(
        "*", F.explode(F.array(F.floor(F.col("shift") / (2 * reach)) * 2, F.floor((F.col("shift") + reach) / (2 * reach)) * 2 + 1)).alias("band"))
    # a window that is repeated on one side only counts once
    count = lambda flag: F.least(*(F.size(F.collect_set(F.when(flag, x))) for x in (F.col("iat"), F.col("iat") + F.col("shift"))))
    covered = lambda at: F.size(F.array_distinct(F.flatten(F.collect_set(
        F.when(F.col("tokens") < SHORT_ITEM, F.expr(f"sequence({at}, {at} + len - 1)"))))))
    main = F.col("len") == F.col("main")
    near = (bands.groupBy("id", "item", "band", "tokens", "total", "free").agg(
        count(main).alias("n"), count(main & ~F.col("exact")).alias("templates"), covered("iat").alias("iall"), covered("iat + shift").alias("dall"),
        F.min(F.col("iat") + F.col("shift")).alias("first"), F.max("other").alias("other"))
        .withColumn("share", F.greatest(F.col("n") / F.col("total"), F.try_divide(F.col("templates"), F.col("free"))))
        .withColumn("near", F.least("iall", "dall") / F.col("tokens")))
    best = (near.where((F.col("share") >= coverage) | (F.col("near") >= NEARLY))
            .groupBy("id", "item").agg(F.max(F.struct("share", "near", "n", (-F.col("first")).alias("first"), "other")).alias("m")))
    return best.select(F.col("id").cast(kinds[0]).alias(key), F.col("item").cast(kinds[1]).alias(item_key), F.col("m.share").alias("coverage"),
                       F.col("m.n").alias("windows"), (-F.col("m.first")).alias("first_token"), F.col("m.other").alias("reparameterised"))
