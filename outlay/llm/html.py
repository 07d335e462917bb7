"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of tokens: words score positive, tags negative, and the contiguous row of tokens with the largest sum
is the content region; one linear scan finds it. The weights come from labelled pages, which are pages that
mark their content themselves with an ``article`` or ``main`` element (of several the one with the most words):

* A tag weighs minus ``WORD_SHARE`` and minus a bar times the share of its uses outside the content, the mean of the shares on the labelled pages that have it.
  The bar is the one of ``BARS`` whose regions agree best with the marked content, by the sum over the labelled pages of the F1 of their words; of bars
  within ``NEAR`` of the best sum the least one. Each page counts alike in both sums, whatever its length, so a single page has one vote.
* A name (a class, id or role, as a whole word of the attribute) has the share of the words of its elements that lie outside the content, again a mean over pages,
  shrunk towards 0 by one page. Elements of a name whose share is over one half are boilerplate, wherever they stand: their words and tags weigh nothing and
  are not returned, so adverts inside the content go as well. At most ``NAMES_KEPT`` names are kept, the most frequent of them.

Two lists stand in where the labels cannot tell, as marked content holds adverts, forms and comments too: elements of ``ASIDES`` and names of ``NOTICES`` are boilerplate from
the start. No element is boilerplate that holds the marked content or, on a page without any, more than half of the words, so wrappers with such names lose nothing; a ``header`` inside the content
belongs to it. Without labelled pages the tags of ``FENCES`` cost ``BAR`` and the others ``WORD_SHARE``.

What ``HIDDEN`` elements hold is never text. Blocks of the region are the runs of text
between block tags and ``br``; character references are decoded, white space inside a block becomes one blank, empty blocks vanish, and
blocks are joined by a line feed. Of regions with equal sums the first one counts, and the longest of those.

Null and empty pages give an empty text, as do pages without words. Pages are read whole in time linear in their
length. A block tag closes an open ``p``, an end tag closes what is open inside its element, and what no end tag closes runs to the end
of its parent. Repeated rows and null ids are kept; extra columns are left out.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.tables import pick, slices

# HTML's elements by their role.
HIDDEN = frozenset("script style noscript template head title button select textarea iframe svg canvas object audio video".split())
ASIDES = frozenset("nav header footer aside form dialog menu".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li "
    "main ol option p pre section summary table tbody td tfoot th thead tr ul fieldset legend".split()
) | HIDDEN | ASIDES
MARKS = ("article", "main")
FENCES = frozenset("body div html nav ul ol li a article main header footer aside form table".split()) | HIDDEN | ASIDES
# Names of notices, adverts, sidebars, menus and comments; a name is one of these only as a whole.
NOTICES = frozenset(
    "ad ads advert advertisement adverts advertising banner banners sponsor sponsored promo promos promotion cookie cookies cookie-banner cookie-notice "
    "cookie-consent consent notice popup modal newsletter subscribe sidebar side-bar menu navbar nav navigation breadcrumb breadcrumbs comment comments "
    "comment-list comment-section disqus disqus_thread share sharing social related related-posts footer header masthead complementary contentinfo search".split()
)
TOKEN = re.compile(
    r"<!--(?:.*?)(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMED = ("class", "id", "role")
INLINE = frozenset("a abbr b bdi bdo cite code data dfn del em font i img input ins kbd label mark q s samp small span strong sub sup time tt u var wbr meta link".split())
TAGS = BLOCKS | FENCES | INLINE
CLOSED_BY_NEXT = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tbody thead tfoot select body html article main section div".split())
WORD_SHARE, BAR = 0.01, 60.0
BARS = tuple(2.0**k for k in range(17))
NEAR = 0.01
NAMES_KEPT = 200_000
UNIT = 1 << 20  # shares are summed as whole numbers of this part, so the order of the rows does not matter


@dataclass
class Element:
    """An element's tag, names and parent, and the tokens from its start tag to where it closes."""

    tag: str
    names: frozenset[str]
    parent: int
    start: int
    end: int = 0


@dataclass
class Weights:
    """The weight of each tag ("" for the others), and the names whose elements are boilerplate beyond ``NOTICES``."""

    tags: dict[str, float]
    names: frozenset[str] = frozenset()
    lists: bool = True


def _names(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    found = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        if key.lower() in NAMED:
            found.update(next(filter(None, values), "").lower().split())
    return frozenset(found)


class Page:
    """A page's tokens (tag or text), the element of each, and the elements."""

    def __init__(self, page: str | None):
        self.tags: list[str] = []
        self.texts: list[str] = []
        self.owner: list[int] = []
        self.elements: list[Element] = []
        self._read(page or "")
        n = len(self.tags)
        for e in self.elements:
            e.end = e.end or n
        self.words = np.array([len(t.split()) for t in self.texts], np.int64)
        self.before = np.concatenate([[0], np.cumsum(self.words)])

    def _read(self, page: str) -> None:
        open_: list[int] = []
        hidden = 0
        at = 0

        def close(depth: int) -> None:
            nonlocal hidden
            for i in open_[depth:]:
                self.elements[i].end = len(self.tags)
                hidden -= self.elements[i].tag in HIDDEN
            del open_[depth:]

        def put(tag: str, text: str) -> None:
            self.tags.append(tag)
            self.texts.append("" if hidden else text)
            self.owner.append(open_[-1] if open_ else -1)

        while True:
            m = TOKEN.search(page, at)
            text = page[at : m.start()] if m else page[at:]
            if text:
                put("", text)
            if not m:
                return
            at = m.end()
            tag = (m.group(2) or "").lower()
            if not tag:
                continue
            if m.group(1):
                depth = next((d for d in range(len(open_) - 1, -1, -1) if self.elements[open_[d]].tag == tag), None)
                put(tag, "")
                if depth is not None:
                    close(depth)
                continue
            if tag in BLOCKS and tag != "br" or tag in CLOSED_BY_NEXT:
                # An open p, or the item before this one, ends here; not beyond the list or block that holds it.
                ends = (*CLOSED_BY_NEXT.get(tag, ()), "p")
                for d in range(len(open_) - 1, -1, -1):
                    inner = self.elements[open_[d]].tag
                    if inner in ends:
                        close(d)
                        break
                    if inner in SCOPES:
                        break
            if tag not in VOID:
                self.elements.append(Element(tag, _names(m.group(3)), open_[-1] if open_ else -1, len(self.tags)))
                open_.append(len(self.elements) - 1)
                hidden += tag in HIDDEN
            put(tag, "")
            if tag in RAW:
                end = _end_of(tag).search(page, at)
                at = end.start() if end else len(page)

    def held(self, e: Element) -> int:
        return int(self.before[e.end] - self.before[e.start])

    def mark(self) -> Element | None:
        """The element that the page marks as its content: of the first kind of mark that it has, the one with the most words."""
        for tag in MARKS:
            found = [e for e in self.elements if e.tag == tag]
            if found:
                return max(found, key=lambda e: (self.held(e), -e.start))
        return None

    def boilerplate(self, weights: Weights) -> np.ndarray:
        """Whether each token lies in an element that is boilerplate."""
        mark, total = self.mark(), int(self.before[-1])
        out = np.zeros(len(self.tags), bool)
        for e in self.elements:
            listed = weights.lists and (e.tag in ASIDES or not e.names.isdisjoint(NOTICES))
            if not listed and e.names.isdisjoint(weights.names) or e.tag in MARKS or e.tag in ("html", "body"):
                continue
            if mark is None:
                spared = 2 * self.held(e) > total
            else:
                spared = e.start <= mark.start and e.end >= mark.end or (e.tag == "header" and mark.start < e.start < mark.end)
            if spared:
                continue
            out[e.start : e.end] = True
        return out


@lru_cache(maxsize=32)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def tag_uses(page: Page) -> dict[str, float] | None:
    """Of a labelled page: for each tag the share of its uses that are outside the content."""
    mark = page.mark()
    if mark is None:
        return None
    uses, outside = Counter(), Counter()
    for i, tag in enumerate(page.tags):
        if tag:
            uses[tag] += 1
            outside[tag] += not mark.start < i < mark.end
    return {tag: outside[tag] / n for tag, n in uses.items()}


def name_uses(page: Page) -> dict[str, float]:
    """Of a labelled page: for each name the share of the words of its elements that are outside the content."""
    mark = page.mark()
    if mark is None:
        return {}
    held, outside = Counter(), Counter()
    for e in page.elements:
        words = page.held(e) if e.names else 0
        if words:
            common = max(0, int(page.before[min(e.end, mark.end)] - page.before[max(e.start, mark.start)]))
            for name in e.names:
                held[name] += words
                outside[name] += words - common
    return {name: outside[name] / n for name, n in held.items()}


def agreement(page: Page, weights: Weights) -> np.ndarray | None:
    """Of a labelled page whose content has words: for each bar the F1 of the words in the best region against the marked content."""
    mark = page.mark()
    if mark is None:
        return None
    skipped = page.boilerplate(weights)
    n_words = np.where(skipped, 0, page.words)
    content = n_words[mark.start : mark.end].sum()
    if not content:
        return None
    is_tag = np.array([bool(t) for t in page.tags]) & ~skipped
    fixed = n_words - np.where(is_tag, WORD_SHARE, 0.0)
    scaled = np.where(is_tag, [weights.tags.get(tag, 0.0) for tag in page.tags], 0.0)
    before = np.concatenate([[0], np.cumsum(n_words)])
    out = np.empty(len(BARS))
    for k, bar in enumerate(BARS):
        sums = np.concatenate([[0.0], np.cumsum(fixed - bar * scaled)])
        lowest = np.minimum.accumulate(sums)
        end = int((sums - lowest).argmax())
        start = int(sums[: end + 1].argmin())
        common = max(0, before[min(end, mark.end)] - before[max(start, mark.start)])
        out[k] = 2 * common / (before[end] - before[start] + content)
    return out


def learn_weights(pages: DataFrame) -> Weights:
    """The weights from all labelled pages.

    Two passes: the shares of tags and names, then the bar. Sums are made in the tasks first; the driver gets a row for each tag of HTML, one for each
    bar, and the names that are boilerplate, ``NAMES_KEPT`` at most. Made-up tags count as "".
    """
    source = pick(pages, "html")

    def count(batches):
        sums, uses = Counter(), Counter()

        def out():
            keys = sorted(uses)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([k for k, _ in keys], pa.string()), "key": pa.array([k for _, k in keys], pa.string()),
                "outside": pa.array([sums[k] for k in keys], pa.int64()), "n": pa.array([uses[k] for k in keys], pa.int64()),
            })
            sums.clear()
            uses.clear()

        for part in slices(batches, "html"):
            for text in part.column(0).to_pylist():
                page = Page(text)
                for tag, share in (tag_uses(page) or {}).items():
                    if tag in TAGS:
                        sums["tag", tag] += round(share * UNIT)
                        uses["tag", tag] += 1
                for name, share in name_uses(page).items():
                    sums["name", name] += round(share * UNIT)
                    uses["name", name] += 1
            if len(uses) > 200_000:
                yield from out()
        yield from out()

    counted = (
        source.mapInArrow(count, "kind string, key string, outside long, n long").groupBy("kind", "key")
        .agg(F.sum("outside").alias("outside"), F.sum("n").alias("n"))
    )
    often = counted.filter((F.col("kind") == "name") & (2 * F.col("outside") > (F.col("n") + 1) * UNIT)).orderBy(F.desc("n"), "key").limit(NAMES_KEPT)
    found = counted.filter("kind = 'tag'").unionByName(often).collect()
    shares = {r["key"]: r["outside"] / r["n"] / UNIT for r in found if r["kind"] == "tag"}
    names = frozenset(r["key"] for r in found if r["kind"] == "name")
    if not shares:
        return Weights({"": -WORD_SHARE} | {tag: -BAR for tag in FENCES})
    learned = Weights(shares, names)

    def judge(batches):
        sums = np.zeros(len(BARS), np.int64)
        for part in slices(batches, "html"):
            for text in part.column(0).to_pylist():
                if (found := agreement(Page(text), learned)) is not None:
                    sums += np.rint(found * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"bar": np.array(BARS), "agreement": sums})

    judged = source.mapInArrow(judge, "bar double, agreement long").groupBy("bar").agg(F.sum("agreement").alias("agreement"))
    sums = {r["bar"]: r["agreement"] for r in judged.collect()}
    bar = min(b for b, n in sums.items() if n >= (1 - NEAR) * max(sums.values()))
    return Weights({"": -WORD_SHARE} | {tag: -WORD_SHARE - bar * share for tag, share in shares.items()}, names)


def region(values: np.ndarray) -> tuple[int, int]:
    """Start and end of the values with the largest sum; (0, 0) if no sum is above 0. Of equal sums the first, and the longest of those."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(values.tolist()):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(text: str | None, weights: Weights) -> str:
    page = Page(text)
    skipped = page.boilerplate(weights)
    other = weights.tags.get("", 0.0)
    tags = np.array([weights.tags.get(tag, other) if tag else 0.0 for tag in page.tags], float)
    start, end = region(np.where(skipped, 0.0, page.words + tags))
    blocks, held = [], []
    for tag, words, skip in [*zip(page.tags[start:end], page.texts[start:end], skipped[start:end].tolist(), strict=True), ("p", "", False)]:
        if tag in BLOCKS:
            block = " ".join(references.unescape("".join(held)).split())
            if block:
                blocks.append(block)
            held = []
        elif not tag and not skip:
            held.append(words)
    return "\n".join(blocks)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row."""
    source = pick(pages, "page_id", "url", "html")

    def run(batches):
        for part in slices(batches, "html"):
            texts = [main_text(page, weights) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def digests(pages: DataFrame) -> DataFrame:
    return extract(pages, learn_weights(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
