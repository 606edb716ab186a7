"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score positive and tags negative; words in
links score by how often they stand in articles, those beside other words of their block
apart from those in blocks of links only. Where a page marks one article, its tags cost
nothing and what is around it scores negative, so the region is the article from its first
word to its last. Elements that are page furniture, or that
a class, id or role calls so, are left out and stand as one tag, so that an advert costs an
article little. A class, id or role alone does not take out what holds the page: see
``article`` and ``main_text``. Such an element's name scores in the scan instead. The weights are
log-likelihood ratios counted over the labelled pages: those that mark one article of their
own (``article`` or ``main``). A linear scan finds the contiguous region with the greatest
sum, whose text is the page's main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre search section summary table tbody td tfoot th thead title tr ul".split())
INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i img ins kbd label mark q ruby s samp small span strong sub "
    "sup time tt u var wbr".split())
TEXT_BLOCK = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tr td th tbody thead tfoot caption figure figcaption "
    "hr br img".split())
# Elements whose end tag may be left out, and what opens where they end.
CLOSED_BY = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
             "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}}
CLOSES = {name: {o for o, by in CLOSED_BY.items() if name in by} for by in CLOSED_BY.values() for name in by}
# Furniture: elements, and words of class, id and role that name it.
FURNITURE = frozenset(
    "head script style nav header footer aside noscript iframe template button select textarea svg canvas "
    "object menu dialog title".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "notice alert sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer comment "
    "comments reply replies respond share sharing social related recommended newsletter subscribe subscription popup "
    "modal overlay widget toolbar pagination pager login signup search skip disclaimer copyright complementary "
    "contentinfo".split())
# Of these one is enough; the others may stand in names of content, such as related-work.
SURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent sidebar "
    "navbar navigation breadcrumb breadcrumbs masthead topbar comment comments newsletter subscribe subscription popup "
    "modal pagination pager login signup".split())
# What may stand beside the others in names of furniture.
NEUTRAL = frozenset(
    "a an and area article articles bar block body bottom box button buttons card col column container content entry for "
    "footer group head has icon icons info inner is item items js left link links list main more new no of off on open "
    "outer page panel post posts right row section site slot story stories text the title to top unit us with wrap "
    "wrapper".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/]++)(?:\s*+=\s*+("[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s]++))?""")

LEAST_COST = -0.01  # no tag scores more
# Scores of tags that the labelled pages don't have: formatting, blocks of text, others.
UNSEEN_INLINE, UNSEEN_TEXT, UNSEEN = -0.01, -0.1, -1.0
MOST = 8.0  # no score is further from zero
FURNITURE_COST = -0.5  # one piece of furniture costs no more
PLAIN, LINK, PIECE, NAMED = "words", "words in links", "furniture", "furniture's name"
LISTED = "words of blocks of links"
# Scores of a word in a link that the labelled pages don't have, and the least of any word
# in a marked article.
UNSEEN_LINK, UNSEEN_LISTED, LEAST_WORD = 0.5, -0.25, 0.05
# Elements that no class, id or role makes furniture.
NEVER = frozenset("html body main article".split())


@dataclass
class Token:
    kind: str  # of words, a tag's name, PIECE or NAMED
    text: str | None  # None for tags and furniture
    words: int


@dataclass
class Element:
    """A form, or an element that class, id or role call furniture: its first token, the
    place after its last one, its words outside links, and whether its names leave no doubt."""
    start: int
    end: int
    words: int
    sure: bool = True


CUT = Token(PIECE, None, 0)  # an element left out by its class, id or role


def _attributes(raw: str) -> dict[str, str]:
    """Values by name of a tag's attributes; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), (value[1:].rstrip(value[0]) if value[:1] in ('"', "'") else value).lower())
    return found


def _hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or given.get("aria-hidden") == "true"


def _names_furniture(given: dict[str, str]) -> str:
    """Whether names call an element furniture: "" if not, "sure" or "maybe"."""
    found = ""
    for name in (n for x in ("class", "id", "role") if x in given for n in given[x].split()):
        parts = {p for p in re.split(r"[^a-z0-9]+", name) if p}
        if parts & SURE_NAMES or parts & NAMES and all(
                p in NAMES or p in NEUTRAL or any(c.isdigit() for c in p) for p in parts):
            return "sure"
        if parts & NAMES:
            found = "maybe"
    return found


def _sort_links(out: list[Token]) -> None:
    """Words in links of blocks without other words are LISTED."""
    begin, plain = 0, False
    for i, token in enumerate([*out, Token("end", None, 0)]):
        if token.text is None and token.kind.lstrip("/") not in INLINE:
            if not plain:
                for other in out[begin:i]:
                    if other.kind == LINK:
                        other.kind = LISTED
            begin, plain = i + 1, False
        elif token.kind == PLAIN and token.words:
            plain = True


def tokens(page: str) -> tuple[list[Token], list[Element]]:
    """Words and tags of a page in order; comments are left out, furniture and hidden
    elements stand as one token, and character references are decoded. Raw text (scripts
    and such) reaches up to its end tag. What is furniture by class, id or role only has all
    its tokens and is listed, in the order of opening."""
    out: list[Token] = []
    listed: list[Element] = []
    plain = 0  # words outside links so far
    # Name, furniture, link, listed element; the second and third include what is around.
    opened: list[tuple[str, bool, bool, Element | None]] = []
    names: Counter[str] = Counter()  # of what is open: looked at before the stack is walked
    at, size, last = 0, len(page), page.rfind(">")

    def add_text(raw: str) -> None:
        nonlocal plain
        furniture, link = opened[-1][1:3] if opened else (False, False)
        if raw and not furniture:
            text = html.unescape(raw)
            out.append(Token(LINK if link else PLAIN, text, len(text.split())))
            plain += 0 if link else out[-1].words

    def close(element: Element | None) -> None:
        if element:
            element.end, element.words = len(out), plain - element.words

    while at < size:
        found = _TAG.search(page, at) if at <= last or "<!" in page[at:] or "<?" in page[at:] else None
        if not found:
            add_text(page[at:])
            break
        add_text(page[at:found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:  # a comment or declaration
            continue
        if found[1] or found[4]:
            inside, element = bool(opened) and opened[-1][1], None
            if names[name]:
                while True:
                    closed, _, _, element = opened.pop()
                    names[closed] -= 1
                    if closed == name:
                        break
                    close(element)
            if not inside:
                out.append(Token("/" + _known(name), None, 0))
            close(element)
            continue
        attributes = found[3] or found[6] or ""
        if any(names[o] for o in CLOSES.get(name, ())):
            for i in range(len(opened) - 1, -1, -1):
                other = opened[i][0]
                if other in CLOSES[name]:
                    names.subtract(o[0] for o in opened[i:])
                    for o in opened[i:]:
                        close(o[3])
                    del opened[i:]
                    break
                if other not in INLINE:
                    break
        around, link = opened[-1][1:3] if opened else (False, False)
        given = _attributes(attributes) if attributes and not around else {}
        furniture = around or name in FURNITURE or _hidden(given)
        element = None
        named = _names_furniture(given) if not furniture and name not in NEVER else ""
        if named or name == "form" and not furniture:
            listed.append(element := Element(len(out), size, plain, name == "form" or named == "sure"))
        if not around:
            out.append(Token(PIECE if furniture else _known(name), None, 0))
        if name in VOID:
            close(element)
            continue
        opened.append((name, furniture, link or name == "a", element))
        names[name] += 1
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            add_text(page[at:end.start() if end else size])
            at = end.start() if end else size
    for o in opened:
        close(o[3])
    _sort_links(out)
    return out, listed


def _known(name: str) -> str:
    return name if name in BLOCK or name in INLINE or name in VOID else "other"


def marked_region(page: list[Token]) -> tuple[int, int] | None:
    """First and last token inside the page's only article, if it marks just one."""
    for name in ("article", "main"):
        starts = [i for i, t in enumerate(page) if t.kind == name]
        ends = [i for i, t in enumerate(page) if t.kind == "/" + name]
        if len(starts) == len(ends) == 1 and starts[0] < ends[0]:
            return starts[0] + 1, ends[0]
    return None


def cut(page: list[Token], listed: list[Element], spare) -> tuple[list[Token], list[int]]:
    """The page without the listed elements, but for those to ``spare``, and the place of
    each token before. What is spared keeps its tokens and gets one more for its name."""
    out, places, at = [], [], 0
    for element in listed:
        if element.start < at:
            continue
        spared = spare(element)
        end = element.start + 1 if spared else element.start
        out += page[at:end]
        places += range(at, end)
        out.append(Token(NAMED, None, 0) if spared else CUT)
        places.append(element.start)
        at = end if spared else element.end
    return out + page[at:], [*places, *range(at, len(page))]


def _plain(page: list[Token], start: int = 0, end: int | None = None) -> int:
    return sum(t.words for t in page[start:end] if t.kind == PLAIN)


def article(page: list[Token], listed: list[Element]) -> tuple[list[Token], tuple[int, int] | None]:
    """The page without furniture, and its marked article in it, if there is one.

    Of a page that marks its article (before or after furniture by name is cut) these listed
    elements stay: those around the article, and of those in it the ones with most of its
    words and the ones whose names leave a doubt. Of other pages those with most of the
    page's words stay. Words in links do not count.
    """
    if not listed:
        return page, marked_region(page)
    words = _plain(page)
    most = cut(page, listed, lambda e: 2 * e.words > words)
    mark = marked_region(page)
    for found, places in () if mark else (most, cut(page, listed, lambda e: False)):
        if region := marked_region(found):
            # An opening tag's name token has the place of the tag.
            mark = places[region[0] - 1] + 1, places[region[1]]
            break
    if not mark:
        return most[0], None
    inner = _plain(page, *mark)
    start, end = mark
    found, places = cut(page, listed, lambda e: e.start < start and e.end > end
                        or start <= e.start and e.end <= end and (2 * e.words > inner or not e.sure))
    first = next(i for i, place in enumerate(places) if place >= start - 1) + 1
    return found, (first, next(i for i in range(first, len(places)) if places[i] >= end))


def _pages(batch, column):
    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py().decode("utf-8", "replace")


def learn(pages: DataFrame) -> dict[str, float]:
    """Score of every kind of token, from all labelled pages.

    Each task sends its counts; the kinds are a fixed list, so what reaches the driver is
    a few hundred rows at most.
    """
    def count(batches):
        inside: dict[str, int] = {}
        outside: dict[str, int] = {}
        for batch in batches:
            for page in _pages(batch, 0):
                found, region = article(*tokens(page))
                if region:
                    for i, token in enumerate(found):
                        where = inside if region[0] <= i < region[1] else outside
                        where[token.kind] = where.get(token.kind, 0) + (1 if token.text is None else token.words)
                        if token is CUT:  # its name is learnt from what was cut by it too
                            where[NAMED] = where.get(NAMED, 0) + 1
        kinds = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(kinds, pa.string()), "inside": pa.array([inside.get(k, 0) for k in kinds], pa.int64()),
            "outside": pa.array([outside.get(k, 0) for k in kinds], pa.int64())})

    counts = (pages.where("html is not null").select("html").mapInArrow(count, "kind string, inside long, outside long")
              .groupBy("kind").agg(F.sum("inside"), F.sum("outside")).collect())
    all_in, all_out = (1 + sum(r[i] for r in counts) for i in (1, 2))
    scores = {}
    for kind, inside, outside in counts:
        ratio = float(np.log((inside + 0.5) / all_in) - np.log((outside + 0.5) / all_out))
        scores[kind] = float(np.clip(ratio, -MOST, MOST))
        if kind not in (PLAIN, LINK, LISTED):
            scores[kind] = min(scores[kind], LEAST_COST)
    scores[PLAIN] = float(np.clip(scores.get(PLAIN, 1.0), 0.1, 1.0))
    scores[PIECE] = max(scores.get(PIECE, FURNITURE_COST), FURNITURE_COST)
    return scores


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """Start and end of the contiguous run with the greatest positive sum; of equal ones
    the first, and of those the longest. (0, 0) if no sum is positive."""
    if not len(scores):
        return 0, 0
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    lowest = np.minimum.accumulate(sums)
    gain = sums[1:] - lowest[:-1]
    best = gain.max()
    if best <= 0:
        return 0, 0
    end = int(np.flatnonzero(gain >= best)[0]) + 1
    start = int(np.flatnonzero(sums[:end] <= lowest[end - 1])[0])
    return start, end


def unseen(kind: str) -> float:
    name = kind.lstrip("/")
    if kind == PLAIN:
        return 1.0
    if kind == PIECE:
        return FURNITURE_COST
    if kind in (LINK, LISTED):
        return UNSEEN_LINK if kind == LINK else UNSEEN_LISTED
    return UNSEEN_INLINE if name in INLINE else UNSEEN_TEXT if name in TEXT_BLOCK else UNSEEN


def scan(found: list[Token], weights: dict[str, float], mark: tuple[int, int] | None = None) -> list[Token]:
    """The region with the greatest sum. In a marked article tags cost nothing and every
    word counts; around it nothing does."""
    scores = np.array([weights[t.kind] if t.kind in weights else unseen(t.kind) for t in found])
    scores *= np.array([1 if t.text is None else t.words for t in found])
    if mark and any(t.words for t in found[slice(*mark)]):
        inside = np.zeros(len(found), bool)
        inside[slice(*mark)] = True
        words = np.array([t.words for t in found])
        scores = np.where(inside, np.where(words > 0, np.maximum(scores, LEAST_WORD * words), 0.0),
                          -1.0 - words)
    start, end = best_region(scores)
    return found[start:end]


def main_text(page: str, weights: dict[str, float]) -> str:
    every, listed = tokens(page)
    found, mark = article(every, listed)
    region = scan(found, weights, mark)
    # Names are not believed of elements beside which the region is small: the largest and
    # those not far behind take part in a second scan, the others stay furniture.
    words, largest = _plain(region), max((e.words for e in listed), default=0)
    if not mark and largest > 2 * words:
        region = scan(cut(every, listed, lambda e: e.words > 2 * words and 2 * e.words > largest)[0], weights)
    parts = []
    for token in region:
        if token.text is not None:
            parts.append(token.text)
        elif token.kind.lstrip("/") not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (the main text, empty if there is
    none) and n_chars (its code points).

    ``weights`` are learnt from ``pages`` unless given; without any labelled page plain
    words score one and tags as ``unseen`` says. A null or empty html has no text. Repeated rows give
    repeated rows; an empty table gives none; other columns are not read.
    """
    weights = learn(pages) if weights is None else weights

    def texts(batches):
        for batch in batches:
            found = [main_text(page, weights) for page in _pages(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.coalesce("html", F.lit("")).alias("html"))
    return narrow.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
