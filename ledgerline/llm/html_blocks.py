"""HTML extraction by line-block distribution.

Markup is stripped to one line per block; a line's weight is the length of its
text. Lines of page furniture (navigation, headers, footers, sidebars, notices,
adverts, forms, comments) are taken out, so they end no segment; menus weigh
nothing: outside articles, runs of linked list lines whose texts are labels of
less than ``LABEL_WORDS`` words on average and that no sentence introduces, and
any such run on a page with an article. Weights are summed over windows of ``WINDOW`` consecutive lines.
A surge point is a line with weight whose window sum reaches the page's bound;
the segment runs to the dive point, where a window of lines weighs nothing. The
lines with weight between surge and dive are the main text.

The bound is ``SURGE``, or ``SHARE`` of the page's heaviest window where that is
less. Lines of an article (``article``, ``main``) have the bound as a bonus, so
any text in one surges; windows end at its edges, and on such a page the text
outside has to reach ``RIVAL`` of the heaviest window, and ``SURGE``.

Pages are parsed in tasks over Arrow batches, one page at a time, in time linear
in its length; nothing larger than a page is held.

Defined cases: null and empty pages, and pages without a letter or digit in
their text, give an empty text; long pages are read whole; unclosed and cut-off markup ends at the end
of the page; repeated rows are parsed one by one; an empty table gives an
empty result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
SHARE = 0.25    # of the heaviest window, the bound of a page of little text
RIVAL = 0.5     # of the heaviest window, the bound outside an article
LABEL_WORDS = 4  # linked list lines of fewer words are labels of a menu

# Elements whose content is never text of the page.
RAW = ("script", "style")
HIDDEN = frozenset(
    "head title template noscript svg iframe object canvas math audio video select option "
    "textarea button datalist".split())
# Elements of page furniture.
FURNITURE = frozenset("nav footer aside form dialog menu".split())
# Words of class, id and role that name page furniture wherever they stand.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation "
    "menu breadcrumb breadcrumbs footer sidebar aside cookie cookies gdpr popup newsletter comments "
    "disqus complementary contentinfo pagination pager login signup".split())
# Words that name furniture or a topic of the text.
DOUBTFUL_WORDS = frozenset(
    "banner header consent notice notices modal overlay subscribe subscription comment discussion "
    "respond reply replies share sharing social related recommended widget search".split())
# The ones that are content when they stand alone inside an article.
TOPICS = frozenset("banner header notice notices discussion respond search consent related".split())
# Words that make a doubtful one the name of a part of the page.
WIDGETS = frozenset(
    "bar box button buttons form icon icons link links list posts post articles stories thread count "
    "counter panel popup tools".split())
# Words that change nothing about a name.
PLACES = frozenset(
    "site page main top bottom left right global primary secondary mobile area section wrapper wrap "
    "container block inner outer entry article item items holder".split())
# Words of names that stand for the content's own parts.
CONTENT_PARTS = frozenset("post posts article articles stories".split())
# Places that are written in one word with what stands there.
GLUED_PLACES = frozenset("site page main top bottom left right side area section wrapper wrap "
                         "container block".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that turn such a name into one of the content's own.
NOT_FURNITURE = frozenset("with has no content".split())
# Elements that start and end a line.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
ARTICLE = frozenset(("article", "main"))
LISTS = frozenset("ul ol dl dir menu".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)"
                    r"(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?"
                        r"|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)")
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*(?:>|\Z)", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W_]")


def _attributes(text: str) -> Iterator[tuple[str, str]]:
    """Names, in lower case, with their values; a name without one has ''."""
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            value = m[2] or ""
            yield m[1].lower(), value.strip(value[:1]) if value[:1] in ("'", '"') else value


def _split_name(word: str) -> set[str]:
    """The two words of a name written as one (``commentlist``), where one of
    them names furniture and the other one its kind or place; else the word."""
    names, others = FURNITURE_WORDS | DOUBTFUL_WORDS, WIDGETS | GLUED_PLACES
    if word not in names | WIDGETS | PLACES:
        for i in range(2, len(word) - 1):
            a, b = word[:i], word[i:]
            if a in names and b in others or a in others and b in names:
                return {a, b}
    return {word}


def _names_furniture(name: str, token: str, tag: str, in_article: bool) -> bool:
    """Whether a class, an id or a role names furniture. Outside an article
    any sure word does; inside one, and for doubtful words, the whole token
    has to be such a name, for an id may be the slug of a heading."""
    words = {x for w in re.split(r"[^a-z0-9]+", token) if w for x in _split_name(w)}
    if words & NOT_FURNITURE or name == "id" and tag in HEADINGS:
        return False
    sure, doubtful = words & FURNITURE_WORDS, words & DOUBTFUL_WORDS
    if sure and not in_article:
        return True
    rest = {w for w in words - sure - doubtful if not w.isdigit()}
    if not (sure or doubtful) or rest - WIDGETS - PLACES - GLUED_PLACES:
        return False
    if not sure and doubtful == {"header"}:
        rest -= CONTENT_PARTS       # the head of an article is no widget
    if sure or rest & WIDGETS or len(doubtful) > 1:
        return True
    if name == "role":
        return not (in_article and doubtful == {"header"})
    if in_article:
        return name == "class" and not doubtful & TOPICS
    return name == "class" or tag != "section"


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body") or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for name, value in _attributes(attributes):
        value = value.lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true":
            return True
        if name in ("class", "id", "role") and tag not in ARTICLE and any(
                _names_furniture(name, x, tag, in_article) for x in value.split()):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int, bool, bool, bool]]:
    """(text, characters inside links, furniture, inside an article, inside a
    list) per line."""
    lines: list[tuple[str, int, bool, bool, bool]] = []
    buffer: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []    # open elements: tag, furniture, hidden
    depths: dict[str, list[int]] = {}           # where the open elements of a tag stand in it
    blocks: list[int] = []                      # where the open blocks stand in it
    furniture = hidden = articles = links = lists = 0
    at = 0

    def end_line() -> None:
        nonlocal buffer, linked
        text = _SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        lines.append((text, linked, furniture > 0, articles > 0, lists > 0))
        buffer, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not hidden:
            buffer.append(text)
            if links:
                linked += len(text.strip())

    def close() -> None:
        nonlocal furniture, hidden, articles, links, lists
        entry = stack.pop()
        depths[entry[0]].pop()
        if entry[0] in BLOCKS:
            blocks.pop()
        furniture -= entry[1]
        hidden -= entry[2]
        articles -= entry[0] in ARTICLE
        links -= entry[0] == "a"
        lists -= entry[0] in LISTS

    for m in iter(lambda: _TOKEN.search(page, at), None):
        add(page[at:m.start()])
        at = m.end()
        if m[1] is not None:
            add(html.escape(m[1], quote=False))
        if not m[3]:
            continue
        tag, ends = m[3].lower(), m[2] == "/"
        if tag in BLOCKS:
            end_line()
        if ends:
            depth = depths[tag][-1] if depths.get(tag) else None
            # an inline end tag does not close the blocks around it
            if depth is not None and (tag in BLOCKS or tag in HIDDEN or not blocks
                                      or blocks[-1] <= depth):
                while len(stack) > depth:
                    close()
        elif tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[4].endswith("/"):
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack \
                    and stack[-1][0] == tag:
                close()         # these end where the next of their kind begins
            entry = (tag, _is_furniture(tag, m[4], articles > 0), tag in HIDDEN)
            depths.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS:
                blocks.append(len(stack))
            stack.append(entry)
            furniture += entry[1]
            hidden += entry[2]
            articles += tag in ARTICLE
            links += tag == "a"
            lists += tag in LISTS
    tail = page[at:]
    add(tail if not tail.startswith("<") else "")
    end_line()
    return lines


def _segments(weights: list[int], bound: float, window: int) -> Iterator[int]:
    """Places of the lines with weight between surge and dive points."""
    on = False
    for i, w in enumerate(weights):
        total = sum(weights[i:i + window])
        on = total > 0 if on else w > 0 and total >= bound
        if on and w:
            yield i


def weighted_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, weight, inside an article) of the lines that are no furniture."""
    # lines that hold nothing at all are layout, furniture is no distance
    rows = [(text, inside, listed and not inside and 2 * linked > len(text))
            for text, linked, off, inside, listed in lines_of(page) if text and not off]
    marked = any(inside for _, inside, _ in rows)
    lines: list[tuple[str, int, bool]] = []
    for in_list, run in groupby(rows, key=lambda x: x[2]):
        group = list(run)
        before = lines[-1] if lines else ("", 0, False)
        introduced = before[0].endswith(":") and len(before[0].split()) >= LABEL_WORDS
        menu = in_list and (marked or not introduced and
                            sum(len(x[0].split()) for x in group) < LABEL_WORDS * len(group))
        lines += [(text, 0 if menu else len(text), inside) for text, inside, _ in group]
    return lines


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Text between the surge and dive points of the line weights."""
    lines = weighted_lines(page or "")
    if not any(w and _WORD.search(text) for text, w, _ in lines):
        return ""
    runs = [list(run) for _, run in groupby(lines, key=lambda x: x[2])]
    peak = max(sum(w for _, w, _ in run[i:i + window]) for run in runs for i in range(len(run)))
    marked = any(inside for _, _, inside in lines)
    bound = max(surge, RIVAL * peak) if marked else min(surge, SHARE * peak)
    out: list[str] = []
    for run in runs:
        weights = [w + math.ceil(bound) * inside for _, w, inside in run]
        out += [run[i][0] for i in _segments(weights, bound, window)]
    return "\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url",
                  markup: str = "html") -> DataFrame:
    """Main text of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                        F.col(markup).alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, "
                                     "text string, n_chars long")
