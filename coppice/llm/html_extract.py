"""Main text of web pages as the maximum-scoring run of words and tags.

A page becomes a sequence of words and tags. A word scores positive, a tag negative; the
weights come from labelled pages: those whose markup names their article (one
``<article>``, or else one ``<main>``), where it is known which words and tags lie inside.
A word's weight depends on where it stands (nearest block, its class names, in a link or
not), a tag's on its name and class names. One linear scan finds the best contiguous
run.

What of the run is article text is a decision of its own. Elements that hold none by
their kind (scripts, menus, forms and the like) or that are hidden are left out; they
cost the scan next to nothing, so short paragraphs behind them stay. An element with a
class name, id or role such as "comments" or "cookie-banner" is judged by its words:
names of adverts, notices and comments leave it out where there is other text to speak
of, names that wrappers bear as well ("widget", "header") only where the other text is
longer and labelled pages did not teach that the article holds such elements. A page
whose whole text is in one wrapper keeps it, whatever its name.

On a page that names its article the words outside score negative and the tags inside
nothing: the run is the article, and no list or short paragraph at its end is lost.

White space and block limits are single spaces; inline tags join what stands beside
them. Character references are decoded. All steps are linear in the page.

Edge cases: a null or empty page, one without words, or one whose best run is not
positive gives the empty text. Markup that breaks off is read to its end. Ties go to the
earliest and then the longest run. Repeated rows are treated alike; rows without an id
are kept; columns of other names are not read. Without labelled pages, so also of an empty
table, the weights are the starting ones; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import slices, text_or_empty

#: At most so many labelled pages are read for the weights, those with the smallest crc32 of the id.
SAMPLE_PAGES = 4_000
# Kinds of HTML elements.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section summary table ul".split()
)
BOILERPLATE = frozenset(
    "nav header footer aside form button select option input menu dialog script style noscript template iframe title head "
    "svg canvas object embed textarea label".split()
)
ARTICLE = ("article", "main")
# Class names, ids and roles of elements that seldom hold article text.
#: Adverts, notices, comments and the like: left out where the page has other text to speak of.
NEVER_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus gdpr newsletter notice notification pagination popup promo promoted promotion replies reply respond "
    "sidebar signup sponsor sponsored subscribe subscription".split()
)
#: Names that wrappers of whole pages bear as well.
SELDOM_TEXT_NAMES = frozenset(
    "banner disclaimer footer header masthead menu modal nav navbar navigation recommended related search share sharing "
    "skip social tags toolbar topbar widget complementary contentinfo".split()
)
#: What follows such a name in a longer one of the same meaning.
NAME_ENDINGS = frozenset(
    "area bar block box bottom container footer form inner item items left link links list message module outer panel right "
    "section slot thread top unit wrap wrapper".split()
)
#: Names of elements that hold the text.
TEXT_NAMES = frozenset("article content entry main post story text".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>[^<>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*+)*+)(?:>|\Z|(?=<))|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"(?i)(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
HIDDEN = re.compile(r"(?i)(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)")
WORD_IN_NAME = re.compile(r"[A-Za-z]+")
NAME_PARTS = re.compile(r"[^A-Za-z]+")

#: Elements that are never without article text.
NEVER_DROPPED = frozenset(("html", "body", *ARTICLE))
#: Of these not even the tags cost anything.
FREE = frozenset(RAW)

#: Marks the kinds of words that stand in an element with a boilerplate name.
NAMED = " under a name"
#: Other words that make it safe to leave out an element with a name of ``NEVER_TEXT_NAMES``.
OTHER_WORDS = 25
#: A named article is taken for the page's text if it has so many words or this share of them.
ARTICLE_WORDS, ARTICLE_SHARE = 50, 0.25


@dataclass
class Piece:
    """A tag (``name`` set) or a stretch of text with its place."""

    kind: str  # what the weight depends on
    text: str = ""
    name: str = ""
    words: int = 0
    dropped_since: int = -1  # the piece that opens the innermost element without text around it
    region: int = -1  # the innermost element with a boilerplate name around it


@dataclass
class Region:
    """An element with a boilerplate name."""

    kind: str
    start: int  # the piece that opens it
    around: int  # the next region around it
    never_text: bool
    own: int = 0  # words in it and in no region within
    words: int = 0


@dataclass
class Article:
    name: str
    start: int  # the piece that opens it
    end: int  # the piece that closes it
    region: int  # the region that it opens or stands in


@dataclass
class Page:
    pieces: list[Piece]
    regions: list[Region]
    articles: list[Article]


@dataclass
class _Open:
    name: str
    kind: str
    block: str  # kind of the nearest block
    dropped_since: int
    region: int
    link: bool
    article: Article | None = None


def boilerplate_name(name: str) -> frozenset[str] | None:
    """Which of the two lists a class name, id or role belongs to, if any.

    Longer names count if they begin with a listed one and only endings of the same meaning follow: "comment-list"
    does, "comments-open" and "has-sidebar" don't.
    """
    first, *rest = NAME_PARTS.split(name.strip("-_"))
    names = NEVER_TEXT_NAMES if first in NEVER_TEXT_NAMES else SELDOM_TEXT_NAMES if first in SELDOM_TEXT_NAMES else None
    if names and all(not part or part in NAME_ENDINGS or part in NEVER_TEXT_NAMES or part in SELDOM_TEXT_NAMES for part in rest):
        return NEVER_TEXT_NAMES if not NEVER_TEXT_NAMES.isdisjoint(rest) else names
    return None


def _attributes(rest: str) -> tuple[str, frozenset[str] | None, bool]:
    """Words of class names, ids and roles in order, the list that one of them belongs to, and whether the element is hidden."""
    if "=" not in rest:
        return "", None, bool(HIDDEN.search(rest))
    found = [(a or b or c).lower() for a, b, c in NAMES.findall(rest)]
    words = {w for name in found for w in WORD_IN_NAME.findall(name)}
    tokens = [token for name in found for token in name.split()]
    listed = {boilerplate_name(token) for token in tokens} - {None}
    if not TEXT_NAMES.isdisjoint(tokens):
        listed.clear()
    return ".".join(sorted(words)), max(listed, key=lambda names: names is NEVER_TEXT_NAMES, default=None), bool(HIDDEN.search(rest))


def parse(page: str) -> Page:
    """Tags and stretches of text in order, with the elements around them that matter."""
    out: list[Piece] = []
    regions: list[Region] = []
    articles: list[Article] = []
    stack = [_Open("", "", "", -1, -1, False)]
    places: dict[str, list[int]] = {}  # where on the stack elements of a name stand
    at = 0

    def text(start: int, end: int) -> None:
        if start < end:
            top = stack[-1]
            raw = page[start:end]
            words = 0 if raw.isspace() else raw.strip().count(" ") + 1
            decoded = html.unescape(raw) if "&" in raw else raw
            out.append(Piece(f"word {top.block}{' link' * top.link}{NAMED * (top.region >= 0)}", decoded, "", words, top.dropped_since, top.region))

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            gone = stack.pop()
            places[gone.name].pop()
            if gone.article:
                gone.article.end = len(out)

    sign = page.find("<")
    while sign >= 0:
        m = TAG.match(page, sign)
        if not m:  # a sign in the text
            sign = page.find("<", sign + 1)
            continue
        text(at, sign)
        at = m.end()
        sign = page.find("<", at)
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            there = places.get(name)
            closed = stack[there[-1]] if there else None
            if closed:
                close_to(there[-1])
            inner, top = closed or stack[-1], stack[-1]
            out.append(Piece(f"tag /{closed.kind if closed else name}", "", name, 0, inner.dropped_since, inner.region))
            continue
        if name in PARAGRAPH_ENDS:
            if places.get("p"):
                close_to(places["p"][-1])
        elif name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1].name == name:
            close_to(len(stack) - 1)
        names, listed, hidden = _attributes(m["rest"]) if m["rest"] else ("", None, False)
        top = stack[-1]
        kind = f"{name}.{names}" if names else name
        here = len(out)
        dropped, region = top.dropped_since, top.region
        if name not in VOID:
            if name not in NEVER_DROPPED and (hidden or name in BOILERPLATE):
                dropped = here
            if listed and (name == "article" or name not in NEVER_DROPPED):
                regions.append(Region(kind, here, region, listed is NEVER_TEXT_NAMES))
                region = len(regions) - 1
        out.append(Piece(f"tag {kind}", "", name, 0, dropped, region))
        if name in VOID or m["rest"].endswith("/") and name not in RAW:
            continue
        opened = _Open(name, kind, top.block if name in INLINE else kind, dropped, region, top.link or name == "a")
        if name in ARTICLE:
            opened.article = Article(name, here, -1, region)
            articles.append(opened.article)
        places.setdefault(name, []).append(len(stack))
        stack.append(opened)
        if name in RAW:
            ended = re.compile(rf"(?i)</{name}(?=[\s/>])|\Z").search(page, at)
            at = ended.start()
            sign = page.find("<", at)
    text(at, len(page))
    close_to(1)
    return Page(out, regions, articles)


def named_article(page: Page) -> Article | None:
    """The article that the markup names: the only one, the only one outside elements with boilerplate names, or the only ``<main>``."""
    articles = [a for a in page.articles if a.name == "article"]
    for found in (articles, [a for a in articles if a.region < 0], [a for a in page.articles if a.name == "main"]):
        if len(found) == 1:
            return found[0]
    return None


@dataclass(frozen=True)
class Weights:
    """Weights by kind; a kind that was never seen gets the starting weight of its name."""

    learnt: dict[str, float] = field(default_factory=dict)

    def word(self, piece: Piece) -> float:
        known = self.learnt.get(piece.kind)
        if known is None:
            known = 0.5 if " link" in piece.kind else 1.0
        return piece.words * known

    def tag(self, piece: Piece) -> float:
        known = self.learnt.get(piece.kind)
        if known is not None:
            return known
        name = piece.name
        if name in FREE:
            return 0.0
        if name in INLINE or name in ("br", "img", "wbr"):
            return -0.1
        if name in ("p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "figure", "figcaption", "table", "tbody", "tr", "td", "th", "hr"):
            return -0.25 if piece.kind.startswith("tag /") else -0.5
        if name in BOILERPLATE:
            return -1.0
        return -6.0 if name in (*ARTICLE, "body", "html") else -2.5


def without_text(page: Page, weights: Weights, start: int, end: int) -> tuple[list[bool], list[bool]]:
    """Of the pieces from ``start`` to ``end``, whether each is left out, and which regions are.

    Only elements that are opened there count, so wrappers of an article don't.
    """
    regions = page.regions
    for region in regions:
        region.own = region.words = 0
    clean = 0
    for piece in page.pieces[max(start, 0) : end]:
        if piece.words and piece.dropped_since <= start:
            if piece.region >= 0 and regions[piece.region].start > start:
                regions[piece.region].own += piece.words
            else:
                clean += piece.words
    for region in reversed(regions):  # inner ones come after those around them
        region.words += region.own
        if region.around >= 0:
            regions[region.around].words += region.words
    out = [False] * len(regions)
    others = [clean] * len(regions)  # words that stand beside or around a region and stay
    for k, region in enumerate(regions):
        if not start < region.start < end:
            continue
        around = region.around if region.around >= 0 and regions[region.around].start > start else -1
        if around >= 0:
            others[k] = others[around] + regions[around].own
            out[k] = out[around]
        if region.never_text:
            out[k] |= others[k] >= OTHER_WORDS or 2 * others[k] >= region.words
        else:
            out[k] |= others[k] >= region.words and weights.learnt.get(f"name {region.kind}", 0.0) <= 0
    left = [p.dropped_since > start or (p.region >= 0 and out[p.region]) for p in page.pieces[max(start, 0) : end]]
    return left, out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the greatest sum, end exclusive; empty if no sum is positive."""
    best, found = 0.0, (0, 0)
    start, total = 0, 0.0
    for k, score in enumerate(scores):
        if total <= 0:
            start, total = k, 0.0
        total += score
        if total > best:
            best, found = total, (start, k + 1)
    return found


def extract(text: str, weights: Weights) -> str:
    """The main text of a page."""
    page = parse(text)
    listed = page.pieces
    article = named_article(page)
    left, _ = without_text(page, weights, -1, len(listed))
    if article:
        inner, _ = without_text(page, weights, article.start, article.end)
        inside = sum(p.words for p, out in zip(listed[article.start : article.end], inner) if not out)
        whole = sum(p.words for p, out in zip(listed, left) if not out)
        if inside and (inside >= ARTICLE_WORDS or inside >= ARTICLE_SHARE * whole):
            left[article.start : article.end] = inner
        else:
            article = None
    scores = []
    for k, piece in enumerate(listed):
        if article and article.start <= k < article.end:
            score = 0.0 if piece.name or left[k] else piece.words * max(0.01, weights.word(piece) / max(1, piece.words))
        elif left[k]:
            # The tags at the limits of what is left out cost something, what is in it nothing.
            limit = piece.name and piece.name not in FREE and not (k and left[k - 1] and k + 1 < len(left) and left[k + 1])
            score = -1.0 if limit else 0.0
        elif piece.name:
            score = weights.tag(piece)
        else:
            score = -float(piece.words) if article else weights.word(piece)
        scores.append(score)
    start, end = best_run(scores)
    out = []
    for piece, gone in zip(listed[start:end], left[start:end]):
        if piece.name:
            if piece.name not in INLINE:
                out.append(" ")
        elif not gone:
            out.append(piece.text)
    return " ".join("".join(out).split())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each kind stands inside and outside the article of labelled pages."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text in batch["html"].to_pylist():
            page = parse(text)
            article = named_article(page)
            if not article:
                continue
            for k, piece in enumerate(page.pieces):
                if piece.dropped_since >= 0:
                    continue
                inside = article.start < k < article.end
                counts.setdefault(piece.kind, [0, 0])[inside] += 1 if piece.name else piece.words
                if piece.words and piece.region >= 0:
                    counts.setdefault(f"name {page.regions[piece.region].kind}", [0, 0])[inside] += piece.words
    columns = [list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]]
    arrays = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))]
    yield pa.RecordBatch.from_arrays(arrays, ["kind", "inside", "outside"])


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from pages with one ``<article>``, or else one ``<main>``; counts are summed per task first.

    The sample bounds what reaches the driver: one row for each kind of its words and tags.
    """
    page = text_or_empty(html_col)
    article, main = (F.regexp_count(page, F.lit(f"(?i)<{name}[\\s>]")) for name in ARTICLE)
    rows = pages.select(F.col(id_col).alias("id"), page.alias("html"), ((article == 1) | (article == 0) & (main == 1)).alias("one"))
    labelled = rows.where("one").orderBy(F.crc32(F.col("id").cast("string").cast("binary")), "id").select("id").limit(sample_pages)
    sample = rows.join(F.broadcast(labelled.distinct()), "id").where("one").select("html")
    counts = sample.mapInArrow(_count, "kind string, inside long, outside long")
    counts = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    learnt = {}
    for row in counts.collect():
        odds = math.log((row["inside"] + 0.5) / (row["outside"] + 0.5))
        if row["kind"].startswith(("word", "name")):
            # Words score by how surely their place is article text: 1 at best, negative elsewhere.
            learnt[row["kind"]] = max(-1.0, min(1.0, odds))
        else:
            learnt[row["kind"]] = min(-0.05, max(-20.0, 4 * min(odds, 0.0)))
    return Weights(learnt)


def extract_column(weights: Weights, html_col: str = "html"):
    @F.arrow_udf("string")
    def main_text(pages: pa.Array) -> pa.Array:
        return pa.array([extract(page, weights) for page in pages.to_pylist()], pa.string())

    return main_text(text_or_empty(html_col))


def main_texts(pages: DataFrame, weights: Weights, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col, text`` for every row."""
    return pages.select(id_col, extract_column(weights, html_col).alias("text"))
