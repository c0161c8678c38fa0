"""HTML extraction by consensus: the pages of a host agree on where their text stands.

Each page scores its containers by the text in their paragraphs, links counted
against, and votes for the path of its best one, or of the article or main element
around that: tags and classes from the root down, numbers generalised.  Spark counts votes per host, and every page is extracted again
from the paths that won on its host; a page that has none of them keeps its own best.
What is no part of an article is told by elements, roles and names; a name that only has
a word of that kind in it (``related-work``) counts where the element is also short or
mostly links.
Pages are parsed as browsers do in outline: paragraphs, items and cells that were not
closed end where they must, stray end tags and unfinished tags are passed over.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.session import settle

#: A path wins on a host if it has at least this share of the votes; it holds a page's text if that has this share of the text of the page's own best.
SHARE, FAIR = 0.2, 0.1
#: An element of a doubtful name goes with fewer characters than this, or half of them in links.
SHORT = 40

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas select noframes".split())
NOISE_TAGS = RAW | frozenset("nav header footer aside form button dialog menu fieldset input head".split())
NOISE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertisements advertising adbox adslot banner banners breadcrumb breadcrumbs comment comments commentlist
    consent cookie cookies copyright disclaimer disqus dialog footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter
    notice notices notification notifications pager pagination popup promo promos promoted promotion recommended related replies reply respond share
    sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription tagcloud toolbar topbar warning widget widgets alert""".split()
)
#: Words that leave a name's meaning to its other words.
NEUTRAL_WORDS = frozenset(
    """area article author bar block body bottom box button buttons col column container content count desktop entry fixed global group inner item
    items left link links list main meta mobile outer page panel post posts primary reader right row secondary section site sticky title top user
    wrap wrapper""".split()
)
#: Names of noise that an article may give to a passage of its own.
DOUBTFUL_NAMES = frozenset({"warning"})
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Elements that hold a passage rather than an article.
PASSAGES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption tr tbody thead tfoot table ul ol dl figure figcaption".split())
#: Elements that an opening one of the key ends, up to those of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_OUTER = frozenset("html body main article".split())
_WEIGHT = {"article": 2.5, "main": 1.5}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))|(?<![=\w])(hidden)(?![=\w])", re.S)
_DIGITS = re.compile(r"\d+")
_SPLIT_WORDS = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    tag: str
    label: str
    parent: int
    noise: bool
    link: bool
    passage: bool
    doubtful: bool = False
    score: float = 0.0


@dataclass
class Page:
    """Elements in order of opening, and blocks of text: owner, text, characters in links."""

    elements: list[Element] = field(default_factory=lambda: [Element("", "", -1, False, False, False)])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, i: int) -> str:
        labels = []
        while i > 0:
            labels.append(self.elements[i].label)
            i = self.elements[i].parent
        return ">".join(reversed(labels))

    def best(self) -> int | None:
        """The container of highest score, of equal ones the first to open; or what is around it.

        That is the article or main element, if there is one, else the nearest container with
        an h1, if the container has none and what is added is not mostly links.
        """
        top = max(range(len(self.elements)), key=lambda i: (self.elements[i].score, -i))
        if self.elements[top].score <= 0:
            return None
        around = top
        while around > 0 and self.elements[around].tag not in _WEIGHT:
            around = self.elements[around].parent
        return around if around > 0 else self._with_heading(top)

    def _with_heading(self, top: int) -> int:
        """``top``, or the nearest container around it, below the body, that has an h1."""
        around = top
        while around > 0 and self.elements[around].tag not in _OUTER:
            inside = self._inside({around})
            if any(e.tag == "h1" and inside[i] and not e.noise for i, e in enumerate(self.elements)):
                own = self._inside({top})
                more = [(len(text), linked) for owner, text, linked in self.blocks if inside[owner] and not own[owner]]
                return around if 2 * sum(linked for _, linked in more) <= sum(n for n, _ in more) else top
            around = self.elements[around].parent
        return top

    def _inside(self, roots: set[int]) -> dict[int, bool]:
        inside: dict[int, bool] = {-1: False}
        for i, element in enumerate(self.elements):
            inside[i] = i in roots or inside[element.parent]
        return inside

    def text(self, roots: set[int]) -> str:
        """Blocks inside any of the elements, in page order."""
        inside = self._inside(roots)
        return "\n".join(text for owner, text, _ in self.blocks if inside[owner])

    def judge(self) -> None:
        """Elements of doubtful names that are short or mostly links go; what stays is credited to containers."""
        if any(e.doubtful for e in self.elements):
            sizes = [[0, 0] for _ in self.elements]
            for owner, text, linked in self.blocks:
                while owner >= 0:
                    sizes[owner][0] += len(text)
                    sizes[owner][1] += linked
                    owner = self.elements[owner].parent
            for element, (size, linked) in zip(self.elements, sizes, strict=True):
                over = element.parent >= 0 and self.elements[element.parent].noise
                element.noise |= over or (element.doubtful and (size < SHORT or 2 * linked >= size))
            self.blocks = [block for block in self.blocks if not self.elements[block[0]].noise]
        for owner, text, linked in self.blocks:
            _credit(self.elements, owner, max(0, len(text) - 2 * linked))


def _named(name: str) -> tuple[bool, bool]:
    """Whether a class or id is a name of noise, and whether it may be one."""
    words = {w.lower() for w in _SPLIT_WORDS.split(name) if w and not w.isdigit()}
    if not words & NOISE_WORDS:
        return False, False
    sure = words <= NOISE_WORDS | NEUTRAL_WORDS and not words <= DOUBTFUL_NAMES
    return sure, not sure


def _describe(tag: str, rest: str) -> tuple[str, bool, bool]:
    """An element's label in a path, whether its attributes mark it as no part of a text, and whether they may."""
    if not rest.strip():
        return tag, False, False
    told = {}
    for m in _ATTRIBUTE.finditer(rest):
        told[(m[1] or m[5]).lower()] = m[2] or m[3] or m[4] or ""
    classes = html.unescape(told.get("class", "")).split()
    names = [_named(name) for name in [*classes, told.get("id", "")]]
    noise = any(sure for sure, _ in names) or told.get("role", "").lower() in NOISE_ROLES or "hidden" in told
    noise |= told.get("aria-hidden", "").lower() == "true" or "display:none" in told.get("style", "").replace(" ", "").lower()
    label = ".".join([tag, *sorted({_DIGITS.sub("#", c.lower()) for c in classes})])
    return label, noise and tag not in _OUTER, any(maybe for _, maybe in names) and tag not in _OUTER


def parse(source: str) -> Page:
    """A page's outline.  Text in noise is left out of the blocks."""
    page = Page()
    elements, stack = page.elements, [0]
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                owner = next(i for i in reversed(stack) if elements[i].tag not in INLINE)
                page.blocks.append((owner, text, linked))
        linked = 0

    def close(place: int) -> None:
        flush()
        del stack[place:]

    def place_of(tags: set[str], until: set[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if elements[stack[k]].tag in tags:
                return k
            if elements[stack[k]].tag in until:
                return 0
        return 0

    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.search(source, at)
        until = m.start() if m else size
        if until > at and not elements[stack[-1]].noise:
            text = source[at:until]
            held.append(text)
            if elements[stack[-1]].link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, ending, rest = tag.lower(), m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        if ending:
            if tag in INLINE:
                k = next((k for k in range(len(stack) - 1, 0, -1) if elements[stack[k]].tag == tag or elements[stack[k]].tag not in INLINE), 0)
                if k and elements[stack[k]].tag == tag:
                    del stack[k:]
            elif k := next((k for k in range(len(stack) - 1, 0, -1) if elements[stack[k]].tag == tag), 0):
                close(k)
            continue
        if tag in VOID:
            if tag in ("br", "wbr", "hr"):
                held.append(" " if tag == "br" else "")
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
            continue
        if tag not in INLINE:
            flush()
            if k := place_of({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "main"}):
                close(k)
            if tag in _ENDS and (k := place_of(*_ENDS[tag])):
                close(k)
            if tag in ("html", "body") and any(elements[i].tag == tag for i in stack):
                continue
            if tag == "body" and (k := place_of({"head"}, set())):
                close(k)
        over = elements[stack[-1]]
        label, marked, doubtful = _describe(tag, rest)
        noise = over.noise or marked or tag in NOISE_TAGS
        elements.append(Element(tag, label, stack[-1], noise, over.link or tag == "a", tag in PASSAGES or tag in INLINE, doubtful))
        stack.append(len(elements) - 1)
    flush()
    page.judge()
    return page


def _credit(elements: list[Element], owner: int, value: int) -> None:
    """A block counts for the container it stands in, and half for the one around that."""
    share = 1.0
    while owner > 0 and share >= 0.5:
        element = elements[owner]
        if not element.passage:
            element.score += value * share * _WEIGHT.get(element.tag, 1.0)
            share /= 2
        owner = element.parent


def extract(page: Page, paths: list[str]) -> str:
    """Text of the first of the paths under which the page has a fair share of text, else of its own best container, else of all."""
    found: dict[str, set[int]] = {}
    if paths:
        wanted = {p.rpartition(">")[2] for p in paths}
        for i, element in enumerate(page.elements):
            if element.label in wanted and not element.noise:
                found.setdefault(page.path(i), set()).add(i)
    best = page.best()
    own = page.text({0 if best is None else best})
    for path in paths:
        if path in found and (text := page.text(found[path])) and len(text) >= FAIR * len(own):
            return text
    return own


def host_of(url: Column) -> Column:
    """A URL's host in lower case; empty for null or where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, scores = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            page = parse(source.as_py() or "")
            best = page.best()
            if best is not None:
                hosts.append(host)
                paths.append(page.path(best))
                scores.append(page.elements[best].score)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["host", "path", "score"])


def winning_paths(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths) of ``pages`` (host, html): the most voted first."""
    votes = pages.select("host", "html").mapInArrow(_vote_rows, "host string, path string, score double")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.round(F.sum("score")).cast("long").alias("score"))
    of_host = Window.partitionBy("host")
    fit = counted.withColumn("all", F.sum("votes").over(of_host)).where(F.col("votes") >= share * F.col("all"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), F.col("path").alias("path"))))
    return fit.groupBy("host").agg(ranked["path"].alias("paths"))


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, paths in zip(batch.column("html"), batch.column("paths"), strict=True):
            texts.append(extract(parse(source.as_py() or ""), paths.as_py() or []))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row.

    Character references are decoded, white space inside a block is one blank, and blocks
    follow each other by line feeds in page order.

    Defined cases.  A null or empty page, or one without text outside noise, gives an
    empty text.  Rows without a URL share one host, the empty one.  Rows that repeat vote
    as often.  Pages of a host whose votes are split too far keep their own best container.
    """
    kind = dict(pages.dtypes)[id_col]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    # stored, so that its size on disk tells Spark how to join: a host may have any share of the pages
    winners = settle(winning_paths(rows))
    joined = rows.join(winners, "host", "left").select("id", "url", "html", "paths")
    return joined.mapInArrow(_text_rows, f"id {kind}, url string, text string, n_chars bigint").withColumnRenamed("id", id_col)
