"""HTML main text by a site style tree.

The pages of one host are merged into a tree of elements: a node is an element path (tags
with their class words, digits dropped). Its presentation is the sequence of child tags a
page shows there, its content the texts it holds. Both are measured by entropy over the
host's pages: a node that looks alike and says the same on many pages has a low
importance, and its branch is removed from every page, unless a page has no other text.
Pages with the same text are one page of evidence. The counts are Spark aggregations
(host, path, feature), so a host with a third of all pages is summed like any other.

A host with fewer than ``MIN_PAGES`` pages of a node gives no evidence to judge it by, and
rotating adverts look important on any host. So the vocabulary of HTML decides as well:
what it names as no article text (menus, forms, scripts, page headers and footers, and
elements whose class, id or role says so) is cut, and if a page marks its article
(``article`` or ``main``) only that is taken. Running text of the marked article
(paragraphs, headings, lists, tables, quotes) is never judged by entropy: sites do
publish one text twice.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.urls import url_host

MIN_PAGES = 10
THRESHOLD = 0.4
#: removed nodes that are sent to every task (8 bytes each and a host name)
BROADCAST_NODES = 200_000
#: weight of a node's content against its presentation
CONTENT_WEIGHT = 0.9

# fixed values: element names and name parts of the HTML vocabulary
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
CUT = RAW | frozenset("head nav footer aside form button select option menu dialog object audio video canvas label fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul hr""".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
CUT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu
nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices popup modal
overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments reply replies
respond disqus widget toolbar pagination pager skip copyright complementary contentinfo search""".split())
#: parts that say nothing of an element's content: with one of CUT_NAMES they make a compound (ad-slot, share-buttons, site-footer)
STRUCTURE = frozenset("""area articles bar big block body bottom box btn button buttons cell center col column container desktop
fixed floating form group holder icon icons inline inner item items large left link links list main media mobile outer page panel post
posts primary right row secondary section site slot small space sticky stories text thread toggle tools top unit us view wrap wrapper
zone js wp google""".split())
#: ids that mark an element inside a marked article as cut, where ids are heading slugs
ARTICLE_IDS = frozenset("comments respond disqus disqus_thread sidebar breadcrumbs newsletter-signup cookie-banner".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAME = frozenset("html body main article".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s\"'>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_NUMBERS = re.compile(r"\b\d+\b")


@dataclass
class Element:
    tag: str
    path: str
    cut: bool
    article: bool
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    """One block of text: its element path, whether the vocabulary cuts it, whether it is in a
    marked article, whether it is running text."""

    path: str
    cut: bool
    article: bool
    running: bool
    text: str


def _attributes(text: str) -> dict[str, str]:
    """Lower-cased attribute values of a tag by name; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return found


def _marked(name: str, marks: frozenset[str]) -> bool:
    """Whether a name is one of ``marks``, or a compound of them and STRUCTURE words."""
    parts = {_DIGITS.sub("", p) for p in re.split(r"[_\-:]+", name)}
    if not parts.isdisjoint(("post", "entry", "article")):
        marks = marks - {"header"}
    return not parts.isdisjoint(marks) and all(p in marks or p in STRUCTURE or len(p) < 2 for p in parts)


def _names(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[str, bool]:
    """(class words without digits, whether a name or attribute marks the element as cut). The
    header of an article is part of it, that of a page is not."""
    cut = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    marks = CUT_NAMES - {"header"} if in_article else CUT_NAMES
    named = [*attributes.get("class", "").split(), *attributes.get("role", "").split()]
    slug = attributes.get("id", "").strip()
    if in_article:
        cut |= slug in ARTICLE_IDS
    elif tag not in HEADINGS:
        named.append(slug)
    return _DIGITS.sub("", attributes.get("class", "")), cut or any(_marked(n, marks) for n in named)


def parse(page: str) -> tuple[list[Block], dict[str, str]]:
    """(text blocks in page order, child tags per element path) of one page."""
    stack = [Element("", "", False, False)]
    blocks: list[Block] = []
    styles: dict[str, str] = {}
    pieces: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            at = next(e for e in reversed(stack) if e.tag in BLOCKS or not e.tag)
            blocks.append(Block(at.path, stack[-1].cut, stack[-1].article, at.tag in RUNNING, text))

    def close(depth: int) -> None:
        while len(stack) > depth:
            e = stack.pop()
            if e.tag in BLOCKS:
                styles[e.path] = ",".join(e.children)

    pos, end = 0, len(page)
    while pos < end:
        m = _TAG.search(page, pos)
        if m is None:
            pieces.append(page[pos:])
            break
        if m.start() > pos:
            pieces.append(page[pos:m.start()])
        pos = max(m.end(), m.start() + 1)
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag in BLOCKS:
                flush()
            if depth:
                if any(e.tag in BLOCKS or e.cut != stack[depth - 1].cut for e in stack[depth:]):
                    flush()
                close(depth)
            continue
        if tag in BLOCKS:
            flush()
            if tag != "body":  # a paragraph ends where another block begins
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCKS), 0)
                if depth and (stack[depth].tag == "p" or tag == stack[depth].tag and tag in CLOSED_BY_SAME):
                    close(depth)
        elif tag == "br":
            pieces.append(" ")
        if tag in VOID:
            continue
        up = stack[-1]
        attributes = _attributes(m[3])
        words, named = _names(tag, attributes, up.article)
        article = up.article or tag in ("article", "main") or not {"main", "article"}.isdisjoint(attributes.get("role", "").split())
        cut = up.cut or tag in CUT or named and tag not in ("body", "html") or tag == "header" and not up.article
        if cut and not up.cut:
            flush()
        name = f"{tag}.{words}" if words else tag
        if tag in BLOCKS:
            up_block = next(e for e in reversed(stack) if e.tag in BLOCKS or not e.tag)
            up_block.children.append(tag)
            path = f"{up_block.path}/{name}"
        else:
            path = up.path
        if m[3].endswith("/") and tag in RAW:
            continue
        stack.append(Element(tag, path, cut, article))
        if tag in RAW:  # its content is no markup
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            flush()
            stack.pop()
            pos = stop.end() if stop else end
    flush()
    close(1)
    return blocks, styles


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def branches(path: str) -> Iterator[str]:
    """The paths of the elements around a block, inside out, up to the page's frame."""
    while path and path.rpartition("/")[2].partition(".")[0] not in FRAME:
        yield path
        path = path.rpartition("/")[0]


def taken(blocks: list[Block]) -> list[Block]:
    """The blocks that the vocabulary leaves: of the marked article if there is one."""
    left = [b for b in blocks if not b.cut]
    return [b for b in left if b.article] or left


def _body(blocks: list[Block]) -> int:
    """Hash of a page's text as the vocabulary leaves it, without numbers (dates, counters)."""
    return _hash("\n".join(_NUMBERS.sub("", b.text) for b in taken(blocks)))


def _features(pages: DataFrame) -> DataFrame:
    """(host, path, style, feature), one row per distinct page body of a host, node and distinct
    feature; running text of a marked article is left out. Copies of a page are one page
    of evidence: the host repeats itself there, but not its frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, features = [], []
            for page in batch.column("_html").to_pylist():
                blocks, styles = parse(page or "")
                found = set()
                for b in blocks:
                    if b.article and b.running and not b.cut:
                        continue
                    content = _hash(b.text)
                    for path in branches(b.path):  # a block is content of every element around it
                        node = _hash(path)
                        found.add((node, False, content))
                        found.add((node, True, _hash(styles.get(path, ""))))
                bodies.append(_body(blocks))
                features.append([{"path": p, "style": k, "feature": f} for p, k, f in sorted(found)])
            row = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.bool_()), ("feature", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(bodies, pa.int64()), pa.array(features, row)], ["host", "body", "found"])

    each = pages.select("host", "_html").mapInArrow(run, "host string, body bigint, found array<struct<path: bigint, style: boolean, feature: bigint>>")
    return each.groupBy("host", "body").agg(F.min("found").alias("found")).select("host", F.inline("found"))


def node_importance(features: DataFrame) -> DataFrame:
    """(host, path, pages, importance): 1 - the mean entropy of the contents over the pages,
    weighted with the entropy of the presentations; both relative to ln(pages)."""
    counts = features.groupBy("host", "path", "style", "feature").agg(F.count(F.lit(1)).alias("k"))
    ln = F.log(F.col("k").cast("double"))
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("style"), F.col("k"))).alias("pages"),
        F.sum(F.when(F.col("style"), F.col("k") * ln)).alias("shown"),
        F.avg(F.when(~F.col("style"), ln)).alias("said"))
    most = F.log(F.col("pages").cast("double"))
    presentation = 1 - F.col("shown") / (F.col("pages") * most)
    content = 1 - F.col("said") / most
    return nodes.where("pages > 1").select(
        "host", "path", "pages", (presentation * (1 - CONTENT_WEIGHT) + content * CONTENT_WEIGHT).alias("importance"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) for every row of ``pages``: the blocks of the main text, white space
    inside a block turned into one space, joined by a newline; empty if there is none.

    Null or empty HTML gives an empty text. A null url, or one without a host, belongs to
    the host ''. Unclosed and stray tags are tolerated. Repeated rows are pages like
    others. Other columns are not carried; an empty table gives no rows.
    """
    kind, url_kind = dict(pages.dtypes)[key], dict(pages.dtypes)[url]
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), url_host(F.col(url)).alias("host"), F.col(html).alias("_html"))
    low = written(node_importance(_features(rows)).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < THRESHOLD))
                  .groupBy("host").agg(F.collect_set("path").alias("low")), "low-branches")
    nodes, hosts = low.agg(F.sum(F.size("low")), F.count(F.lit(1))).first()
    if (nodes or 0) + hosts <= BROADCAST_NODES:
        low = F.broadcast(low)  # beyond that the pages are dealt by host; AQE splits a hot one
    judged = rows.join(low, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, low in zip(batch.column("_html").to_pylist(), batch.column("low").to_pylist()):
                gone = set(low or ())

                def removed(b: Block, gone=gone) -> bool:
                    if not gone or b.article and b.running:
                        return False
                    return any(_hash(path) in gone for path in branches(b.path))

                left = taken(parse(page or "")[0])
                texts.append("\n".join(b.text for b in [b for b in left if not removed(b)] or left))  # never the whole text
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())], [key, url, "text"])

    return judged.select("_id", "_url", "_html", "low").mapInArrow(run, f"`{key}` {kind}, `{url}` {url_kind}, text string")
