"""Main text of HTML pages by a maximum-scoring subsequence of tokens.

A page is read as tags and runs of words. A tag scores negative; a word scores positive, unless one of its open elements is boilerplate. One
linear scan finds the contiguous region with the largest sum (ties: the first, shortest). Its text, without words that score negative, is
the result.

An element's verdict sums the log-odds of its features: its tag name, if HTML gives it a meaning for this, each class, id and role word with
it, and the parts of these words (``site-footer`` has two, which count half). Plain structure, text and inline tags have no verdict of their
own: that one page template sets its text in ``p`` says nothing of another. A boilerplate verdict holds for all that is inside, but for an
element (no text or inline one) whose own evidence for content is as strong. Inside an element with a verdict for content, tags cost little;
where such elements have most of a page's words, words outside them count little.

Weights come from labelled pages: pages with exactly one ``article`` or ``main`` element label their words as inside or outside it; a bounded
sample (about ``FIT_PAGES`` pages) gives each feature its log-odds. These are blended with a prior - what HTML says of the tag, and short lists
of common words for boilerplate and for content - by the number of different places (parents with their classes) in which the feature was
seen, not by its words: one template is one piece of evidence, however many pages have it. Words that tell a state (``has-sidebar``) are no
features; ``html`` and ``body`` have no verdict, nor has an element with nearly all of the page's words: a mark that holds for the whole page
tells nothing, and neither do listed words on an element around the page's ``h1`` or ``main``. Scripts, styles, controls and the like hold no
text for readers and never count.

Reading is linear in the page's length, however tags are nested or left open. Character references are decoded, white space inside a block
becomes one space, blocks are trimmed and joined by two newlines, empty blocks go. Null html is empty html. Equal pages get equal texts;
other columns of the input are kept, those of the same name replaced.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm import _shared

FIT_PAGES = 2_000
#: A feature counts if at least this share of the labelled pages has it.
MIN_SHARE = 0.005
WORD_SCORE = 1.0
#: A word or tag of boilerplate: it is never part of the result, so it need not split a region that goes on behind it.
SKIPPED_WORD_SCORE = -0.05
#: A tag that content has, any other tag, and one that the labelled pages don't have but text often does.
CONTENT_TAG_SCORE, TAG_SCORE, TEXT_TAG_SCORE = -0.02, -1.0, -0.3
#: A word outside the elements for content that have this share of a page's words.
OUTSIDE_WORD_SCORE, OUTSIDE = 0.1, 0.5
#: Sums from which an element is content, and up to which it is boilerplate; and the largest weight of one feature either way.
GOOD, BAD, MOST = 2.0, -2.0, 5.0
#: Different places in which a feature was seen that count as much as its prior.
PLACES = 1.0
#: An element with this share of a page's words has no verdict.
WHOLE = 0.9

# fixed values: elements that hold no text for readers, that hold raw text, that never have an end tag, and that stand inside a line
NEVER = frozenset("head script style noscript template button select textarea iframe object svg canvas".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figcaption td th tr table tbody".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Priors: elements that HTML says are content and that it says are not, and words in a class or id that often mark boilerplate.
CONTENT = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form dialog menu".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments respond consent cookie cookies disclaimer "
    "footer header masthead menu nav navbar navigation newsletter notice pagination popup modal promo promotion related recommended share sharing "
    "sidebar social sponsor sponsored subscribe subscription toolbar widget disqus replies".split()
)
TEXT_MARKS = frozenset("content article story entry post prose".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_MARK = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_STATE = re.compile(r"(?:has|no|with|without|is)[-_]")


def tokens(page: str) -> Iterator[tuple[str, str, tuple]]:
    """(kind, name or text, marks): kind 'open', 'close' or 'text'. Raw elements come as open and close without their text. A quote after
    an equals sign runs to the next one of its kind, if there is one; a tag that never ends reaches to the page's end."""
    at, begin, n = 0, 0, len(page)
    gone: set[str] = set()  # what no place further on has

    def find(what: str, i: int) -> int:
        if what in gone:
            return -1
        i = page.find(what, i)
        if i < 0:
            gone.add(what)
        return i

    while at < n:
        at = find("<", at)
        if at < 0:
            break
        closing = page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + closing)
        special = page.startswith(("!", "?"), at + 1)
        if name is None and not special:
            at += 1
            continue
        if at > begin:
            yield "text", page[begin:at], ()
        if special:
            comment, data = page.startswith("<!--", at), page.startswith("<![CDATA[", at)
            end = find("-->" if comment else "]]>" if data else ">", at + (4 if comment else 2))
            if data:
                yield "text", _html.escape(page[at + 9 : end if end >= 0 else n]), ()
            begin = at = n if end < 0 else end + (3 if comment or data else 1)
            continue
        end = name.end()
        while True:
            stop = _STOP.search(page, end) if ">" not in gone else None
            if stop is None:
                gone.add(">")
                end = n
                break
            end = stop.end()
            if stop[0] == ">":
                break
            if page[name.end() : stop.start()][-40:].rstrip().endswith("="):
                close = find(stop[0], end)
                if close >= 0:
                    end = close + 1
        attributes = page[name.end() : end]
        name = name[0].lower()
        begin = at = end
        if closing:
            yield "close", name, ()
            continue
        yield "open", name, tuple(x.lower() for q in _MARK.findall(attributes) for x in "".join(q).split()) if "=" in attributes else ()
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            begin = at = n if close is None else close.end()
            yield "close", name, ()
    if begin < n:
        yield "text", page[begin:], ()


#: Elements that an opening tag of these ends, as HTML leaves their end tags out; and those at which the search for one ends.
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_BARRIERS = {
    "p": frozenset("button td th li div article main section aside nav footer header blockquote".split()),
    "list": frozenset("ul ol menu".split()),
    "cell": frozenset("table tr".split()),
    "row": frozenset("table".split()),
    "terms": frozenset("dl".split()),
    "inline": _CLOSES_P | {"li", "td"},
}
_ENDS = {**{x: [("p", "p")] for x in _CLOSES_P}, "li": [("li", "list")], "td": [("td", "cell"), ("th", "cell")], "th": [("td", "cell"), ("th", "cell")], "tr": [("td", "cell"), ("th", "cell"), ("tr", "row")], "dt": [("dt", "terms"), ("dd", "terms")], "dd": [("dt", "terms"), ("dd", "terms")]}


class _Open:
    """The open elements, and where those of each name and each kind of barrier stand: closing one is a look-up."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)

    def _kinds(self, name: str):
        return [name, *(f"#{k}" for k, names in _BARRIERS.items() if name in names)]

    def push(self, name: str, element: int) -> None:
        for k in self._kinds(name):
            self.places[k].append(len(self.stack))
        self.stack.append((name, element))

    def close(self, name: str, barrier: str | None = None) -> None:
        """End the innermost element of this name, if no barrier stands inside it, and all elements in it."""
        if not self.places[name] or barrier is not None and self.places[f"#{barrier}"] and self.places[f"#{barrier}"][-1] > self.places[name][-1]:
            return
        at = self.places[name][-1]
        while len(self.stack) > at:
            gone, _ = self.stack.pop()
            for k in self._kinds(gone):
                self.places[k].pop()

    def innermost(self) -> int:
        return self.stack[-1][1] if self.stack else 0


def parse(page: str) -> tuple[list[tuple[str, tuple, int]], list[tuple[str, str, int]]]:
    """Elements (name, marks, parent), the first one standing for the page, and the page's tokens (kind, value, innermost element)."""
    elements: list[tuple[str, tuple, int]] = [("", (), 0)]
    out, now = [], _Open()
    for kind, value, marks in tokens(page):
        if kind == "open":
            for name, barrier in _ENDS.get(value, ()):
                now.close(name, barrier)
            if value in VOID:
                out.append((kind, value, now.innermost()))
                continue
            elements.append((value, marks, now.innermost()))
            now.push(value, len(elements) - 1)
            out.append((kind, value, len(elements) - 1))
        else:
            out.append((kind, value, now.innermost()))
            if kind == "close":
                now.close(value, "inline" if value in INLINE else None)
    return elements, out


def features(name: str, marks: tuple) -> list[tuple[str, float]]:
    """An element's features and their shares: its name, and for each mark the mark with the name, or else the mark's parts."""
    out = [(name, 1.0)]
    for m in marks:
        if _STATE.match(m):
            continue
        parts = _PART.findall(m)
        out.append((f"{name}.{m}", 1.0))
        out += [(f"#{p}", 1.0 if p == m else 1 / len(parts)) for p in parts]
    return out


def label_counts(page: str) -> Counter | None:
    """(feature, inside) -> words, ('#', feature) -> 1 and ('@', feature, parent with its marks) -> 1, if the page labels itself; else none."""
    elements, items = parse(page)
    if sum(name in CONTENT for name, _, _ in elements) != 1:
        return None
    # words of each element, outside and inside the label: those in its inner elements included
    n, inside = [[0, 0] for _ in elements], [False]
    for name, _, parent in elements[1:]:
        inside.append(inside[parent] or name in CONTENT)
    for kind, value, e in items:
        if kind == "text":
            n[e][inside[e]] += len(value.split())
    out: Counter = Counter()
    for e in range(len(elements) - 1, 0, -1):
        name, marks, parent = elements[e]
        if name in NEVER or not sum(n[e]):
            continue
        for k in (0, 1):
            n[parent][k] += n[e][k]
        if name not in ("html", "body"):
            for f, _ in features(name, marks):
                out[f, False] += n[e][0]
                out[f, True] += n[e][1]
                out["#", f] = 1
                out["@", f, " ".join([elements[parent][0], *sorted(elements[parent][1])])] = 1
    return out


def _prior(feature: str) -> float:
    if feature[0] == "#":
        return -MOST if feature[1:] in MARKS else MOST - 1 if feature[1:] in TEXT_MARKS else 0.0
    return MOST - 1 if feature in CONTENT else -MOST if feature in ASIDE else 0.0


class Weights:
    """Log-odds of content for features, and in how many different places each was seen (one, if it isn't said)."""

    def __init__(self, odds: dict[str, float], places: dict[str, int] | None = None):
        self.odds, self.places = odds, places or {}

    def _odds(self, feature: str, prior: float) -> float:
        if feature not in self.odds:
            return prior
        k = self.places.get(feature, 1)
        return (k * max(-MOST, min(MOST, self.odds[feature])) + PLACES * prior) / (k + PLACES)

    def element(self, name: str, marks: tuple, around: bool) -> float:
        """The sum of an element's features; a mark's parts are the prior of the mark. ``around``: it has the page's h1 or main inside, so
        listed words don't make it boilerplate."""
        total = self._odds(name, _prior(name)) if name in CONTENT or name in ASIDE else 0.0
        mark, parts = None, 0.0
        for f, share in [*features(name, marks)[1:], ("", 0.0)]:
            if f[:1] == "#":
                listed = _prior(f)
                listed = 0.0 if around and listed < 0 or share < 1 and listed > 0 else listed  # post-comments are no post
                parts += share * self._odds(f, listed)
                continue
            total += 0.0 if mark is None else self._odds(mark, parts)
            mark, parts = f, 0.0
        return total

    def words(self, elements: list, counts: list[int]) -> tuple[list[float], list[bool]]:
        """The score of a word in each element, and whether the element is in one with a verdict for content; counts: words in each
        element, those inside others included."""
        around = [False] * len(elements)
        for e in range(len(elements) - 1, 0, -1):
            if around[e] or elements[e][0] in ("h1", "main"):
                around[elements[e][2]] = True
        strength, good = [0.0], [False]  # of the boilerplate verdict that holds (0: none)
        kinds: dict = {}
        for e in range(1, len(elements)):
            name, marks, parent = elements[e]
            held, inside = strength[parent], good[parent]
            if name in NEVER:
                held, inside = math.inf, False
            elif name not in ("html", "body") and (marks or name not in TEXT and name not in INLINE) and counts[e] < WHOLE * counts[0]:
                kind = (name, marks, around[e])
                if kind not in kinds:
                    kinds[kind] = self.element(*kind)
                x = kinds[kind]
                if x <= BAD:
                    held, inside = max(held, -x), False
                elif x >= GOOD and x >= held and name not in TEXT and name not in INLINE:
                    held, inside = 0.0, True
            strength.append(held)
            good.append(inside)
        return [SKIPPED_WORD_SCORE if s else WORD_SCORE for s in strength], good

    def tag(self, name: str) -> float:
        """Score of a start or end tag outside the elements that have a verdict for content."""
        if name in INLINE or name in VOID or name in CONTENT or self.odds.get(name, 0.0) > 0:
            return CONTENT_TAG_SCORE
        return TEXT_TAG_SCORE if name in TEXT else TAG_SCORE


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> Weights:
    """Weights from the pages that label themselves. Nothing to learn from leaves the priors."""
    _shared.tune(pages.sparkSession)
    rows = pages.select(F.col(html_col).cast("string").alias("html"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("h")).where("html is not null")
    n = rows.count()
    rows = rows.where(F.col("h") < int(min(1, FIT_PAGES / max(n, 1)) * (1 << 30))).select("html")

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                found = label_counts(page)
                if found is not None:
                    total.update(found)
                    total["#", "*"] += 1
        items = [(k[1], 2, None, v) if k[0] == "#" else (k[1], 3, k[2], 1) if k[0] == "@" else (k[0], int(k[1]), None, v) for k, v in total.items()]
        if items:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*items), (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["context", "kind", "place", "n"])

    # a row a feature, kind and place
    seen = rows.mapInArrow(count, "context string, kind long, place string, n long").groupBy("context", "kind", "place").agg(F.sum("n").alias("n"))
    of = lambda k, a: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n") if k < 3 else F.lit(1))), F.lit(0)).alias(a)
    counts = _shared.settle(seen.groupBy("context").agg(of(0, "outside"), of(1, "inside"), of(2, "pages"), of(3, "places")), "html-contexts")
    top = counts.where("context = '*'").first()
    if top is None:
        return Weights({})
    # contexts in MIN_SHARE of a bounded number of pages: a bounded list
    kept = counts.where((F.col("context") != "*") & (F.col("pages") >= max(2, MIN_SHARE * top["pages"]))).collect()
    out_all, in_all = sum(r["outside"] for r in kept) + 1, sum(r["inside"] for r in kept) + 1
    odds = {r["context"]: math.log((r["inside"] + 0.5) / in_all) - math.log((r["outside"] + 0.5) / out_all) for r in kept}
    return Weights(odds, {r["context"]: r["places"] for r in kept})


def extract(page: str | None, weights: Weights) -> str:
    """The page's main text."""
    if not page:
        return ""
    elements, tokens_ = parse(page)
    sizes = [len(value.split()) if kind == "text" else 0 for kind, value, _ in tokens_]
    counts = [0] * len(elements)
    for n, (_, _, e) in zip(sizes, tokens_):
        if elements[e][0] not in NEVER:
            counts[e] += n
    for e in range(len(elements) - 1, 0, -1):
        if elements[e][0] not in NEVER:
            counts[elements[e][2]] += counts[e]
    scores, good = weights.words(elements, counts)
    marked = sum(n for n, (_, _, e) in zip(sizes, tokens_) if good[e] and scores[e] > 0)
    if marked and marked >= OUTSIDE * sum(n for n, (_, _, e) in zip(sizes, tokens_) if scores[e] > 0):
        scores = [OUTSIDE_WORD_SCORE if s > 0 and not g else s for s, g in zip(scores, good)]
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, (n, (kind, value, e)) in enumerate(zip(sizes, tokens_)):
        if total <= 0:
            total, start = 0.0, i
        total += scores[e] * n if kind == "text" else SKIPPED_WORD_SCORE if scores[e] < 0 else CONTENT_TAG_SCORE if good[e] else weights.tag(value)
        if total > best:
            best, begin, end = total, start, i + 1
    blocks, current = [], []
    for kind, value, e in tokens_[begin:end]:
        if kind != "text" and value not in INLINE:
            blocks.append("".join(current))
            current = []
        elif kind == "text" and scores[e] > 0:
            current.append(value)
        elif value == "br":
            current.append(" ")
    blocks.append("".join(current))
    blocks = [" ".join(_html.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """The rows of ``pages`` with text and n_chars (code points) in place of the html column."""
    spark = pages.sparkSession
    _shared.tune(spark)
    shared = spark.sparkContext.broadcast(weights)
    pages = pages.drop("text", "n_chars")
    place = pages.columns.index(html_col)

    def task(batches):
        for batch in batches:
            texts = [extract(p, shared.value) for p in batch.column(place).to_pylist()]
            rest = [i for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*(batch.schema.names[i] for i in rest), "text", "n_chars"])

    schema = T.StructType([*pages.drop(html_col).schema.fields]).add("text", "string").add("n_chars", "long")
    return pages.mapInArrow(task, schema)
