"""Main text of web pages: flat text blocks, classified by a decision tree trained on a small labelled table.

The markup is read once, left to right, into flat blocks: text between block-level tags. A block has its word count and
link density, those of its neighbours, whether it stands in article-like markup or in markup that pages use for what
isn't the article (nav, header, footer, aside, form, ... or a class, id or role that says so; of html and body, and of what
surrounds an article or main, class names say nothing), and whether it's a heading. An a without href is no link. A CART tree, grown here from labelled blocks by Gini impurity over all these, says which blocks are content. Of class names a whole name must say that something isn't the article
(social-links, not social-history), those of paragraphs and headings inside the article say nothing, and inline adverts are left out. Scripts, styles,
comments and the document's head never become blocks. Character references are decoded; inside a block white space
becomes one space; content blocks are joined in page order by one space.

Null, empty and text-free pages give an empty text. Unclosed and stray tags are tolerated; an unclosed comment, script
or style hides the rest of the page, as browsers do. Repeated pages give repeated rows.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare, table

#: Element names of HTML by their use here.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("script style noscript template svg iframe object canvas head title textarea".split())
CHROME = frozenset("nav header footer aside form menu button select option dialog fieldset legend label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id and role that mark markup as not the article, and as the article.
BAD = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar|side|footer|header|masthead|breadcrumb\w*|cookie\w*|consent|notice\w*|alert|popup|modal|newsletter|subscribe|signup|share|social|related|recommend\w*|comment\w*|reply|replies|disqus|widget|toolbar|pagination|pager|copyright|legal|login|search|navigation|complementary|contentinfo|hidden|skip)(?:[\s_-]|$)", re.I)
#: Words that such a name may hold beside: social-links is the page's, social-history isn't. Names that hold a word of GOOD are the article's own.
BESIDE = frozenset("list links link buttons button bar box wrapper wrap container block blocks area section slot unit group inner outer item items panel posts form icons icon row col top bottom left right main primary secondary global site page fixed sticky inline small large mobile desktop text message messages content js no the and".split())
#: Text-level elements, whose class names say how they look and not what they are; inline ones, of which only adverts are left out.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th caption figcaption".split())
INLINE = frozenset("span b i em strong small u s mark font ins q cite label abbr".split())
ADVERT = re.compile(r"(?:^|\s)(?:ads?|advert\w*|sponsor\w*|promo\w*)(?:\s|$)", re.I)
#: Names such as has-sidebar or no-comments say what the page has, not what the element is.
MENTION = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|not|with|without)[_-][^\s]*", re.I)
GOOD = re.compile(r"(?:^|[\s_-])(?:article\w*|post|entry|story|content|main|body|text)(?:[\s_-]|$)", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<(script|style|noscript|template|svg|textarea|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HREF = re.compile(r"\shref\s*=", re.I)
UNSEEN = re.compile(r"\shidden(?:[\s=>/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)



def misplaced(marks: str) -> bool:
    """Whether a name among the marks says that the element isn't of the article: a word of BAD, with none but such words or those of BESIDE."""
    for name in marks.split():
        words = [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
        bad = [bool(BAD.fullmatch(w)) for w in words]
        if any(bad) and all(b or w.lower() in BESIDE for b, w in zip(bad, words, strict=True)):
            return True
    return False


FEATURES = ("words", "link_density", "prev_words", "prev_link_density", "next_words", "next_link_density", "chrome", "article", "heading", "page_has_article")
#: Blocks of nine pages of the pages table, in page order: part (n: navigation, x: advert, a: article, f: footer), words, link density, heading.
PAGES = (
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 8, 0.0, 0), ("a", 12, 0.0, 1), ("a", 31, 0.0, 0), ("a", 23, 0.0, 0), ("a", 35, 0.0, 0), ("a", 35, 0.0, 0), ("a", 73, 0.0, 0), ("a", 23, 0.0, 0), ("a", 23, 0.0, 0), ("a", 15, 0.0, 0), ("a", 43, 0.0, 0), ("f", 9, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 9, 0.0, 0), ("a", 6, 0.0, 1), ("a", 107, 0.0, 0), ("a", 7, 0.0, 0), ("f", 15, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 10, 0.0, 0), ("a", 4, 0.0, 1), ("a", 4, 0.0, 0), ("a", 91, 0.0, 0), ("a", 20, 0.0, 0), ("f", 8, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 9, 0.0, 0), ("a", 8, 0.0, 1), ("a", 8, 0.0, 0), ("a", 1, 0.0, 0), ("a", 38, 0.0, 0), ("a", 122, 0.0, 0), ("a", 14, 0.0, 0), ("a", 1, 0.0, 0), ("a", 115, 0.0, 0), ("a", 2, 0.0, 0), ("a", 93, 0.0, 0), ("f", 12, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 5, 0.0, 0), ("a", 10, 0.0, 1), ("a", 61, 0.0, 0), ("a", 16, 0.0, 0), ("a", 43, 0.0, 0), ("a", 95, 0.0, 0), ("a", 13, 0.0, 0), ("a", 30, 0.0, 0), ("a", 18, 0.0, 0), ("a", 50, 0.0, 0), ("a", 29, 0.0, 0), ("f", 15, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 11, 0.0, 0), ("a", 11, 0.0, 1), ("a", 69, 0.0, 0), ("f", 11, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 6, 0.0, 0), ("a", 11, 0.0, 1), ("a", 12, 0.0, 0), ("a", 130, 0.0, 0), ("a", 7, 0.0, 0), ("a", 28, 0.0, 0), ("a", 29, 0.0, 0), ("a", 40, 0.0, 0), ("a", 32, 0.0, 0), ("a", 46, 0.0, 0), ("f", 16, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 8, 0.0, 0), ("a", 7, 0.0, 1), ("a", 7, 0.0, 0), ("a", 56, 0.0, 0), ("a", 19, 0.0, 0), ("a", 38, 0.0, 0), ("a", 10, 0.0, 0), ("a", 89, 0.0, 0), ("a", 25, 0.0, 0), ("a", 13, 0.0, 0), ("a", 3, 0.0, 0), ("f", 12, 0.0, 0)),
    (("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("n", 1, 1.0, 0), ("x", 12, 0.0, 0), ("a", 8, 0.0, 1), ("a", 9, 0.0, 0), ("a", 34, 0.0, 0), ("a", 51, 0.0, 0), ("a", 15, 0.0, 0), ("f", 8, 0.0, 0)),
)
#: Blocks for cases that those pages lack, in the order of FEATURES; the last value is 1 for content.
LABELLED = (
    # inside the article: text with links, between text and beside lists
    (45, 0.2, 60, 0.0, 8, 0.0, 0, 1, 0, 1, 1), (12, 0.3, 80, 0.0, 90, 0.0, 0, 1, 0, 1, 1), (70, 0.1, 1, 1.0, 2, 0.5, 0, 1, 0, 1, 1), (30, 0.4, 20, 0.0, 25, 0.0, 0, 1, 0, 1, 1),
    (5, 0.4, 40, 0.0, 45, 0.0, 0, 1, 0, 1, 1), (25, 0.0, 3, 1.0, 12, 0.0, 0, 1, 0, 1, 1), (18, 0.0, 14, 0.0, 3, 1.0, 0, 1, 0, 1, 1), (9, 0.45, 12, 0.0, 60, 0.0, 0, 1, 1, 1, 1),
    # inside it, too: paragraphs and lists that are links
    (3, 1.0, 45, 0.0, 3, 1.0, 0, 1, 0, 1, 1), (5, 0.9, 3, 1.0, 4, 1.0, 0, 1, 0, 1, 1), (15, 1.0, 40, 0.0, 40, 0.0, 0, 1, 0, 1, 1), (8, 0.8, 5, 0.9, 20, 0.0, 0, 1, 0, 1, 1), (4, 1.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1, 1), (4, 1.0, 30, 0.0, 0, 0.0, 0, 1, 0, 1, 1),
    # inside it, but in forms, asides, comments
    (25, 0.0, 45, 0.0, 20, 0.0, 1, 1, 0, 1, 0), (20, 0.1, 25, 0.0, 0, 0.0, 1, 1, 0, 1, 0), (80, 0.0, 60, 0.0, 9, 0.0, 1, 1, 0, 1, 0), (2, 0.0, 80, 0.0, 60, 0.0, 1, 1, 1, 1, 0),
    # beside it
    (14, 0.0, 0, 0.0, 9, 0.0, 0, 0, 0, 1, 0), (40, 0.0, 30, 0.0, 4, 1.0, 0, 0, 0, 1, 0), (6, 0.0, 1, 1.0, 9, 0.0, 0, 0, 0, 1, 0), (90, 0.0, 40, 0.0, 8, 0.0, 0, 0, 0, 1, 0),
    (4, 0.0, 1, 1.0, 80, 0.0, 0, 0, 1, 1, 0), (25, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (3, 1.0, 4, 1.0, 25, 0.0, 0, 0, 0, 1, 0), (55, 0.2, 20, 0.0, 30, 0.0, 0, 0, 0, 1, 0),
    # page without article markup: running text
    (35, 0.0, 5, 0.0, 50, 0.0, 0, 0, 0, 0, 1), (50, 0.05, 35, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (90, 0.0, 50, 0.0, 2, 1.0, 0, 0, 0, 0, 1), (6, 0.0, 2, 1.0, 35, 0.0, 0, 0, 1, 0, 1),
    (3, 0.0, 50, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (18, 0.0, 28, 0.0, 30, 0.0, 0, 0, 0, 0, 1), (16, 0.0, 0, 0.0, 4, 0.0, 0, 0, 0, 0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (400, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (22, 0.3, 60, 0.0, 10, 0.0, 0, 0, 0, 0, 1), (9, 0.0, 20, 0.0, 20, 0.0, 0, 0, 0, 0, 1), (1, 0.0, 12, 0.0, 15, 0.0, 0, 0, 0, 0, 1),
    # ... which ends with a paragraph, where no footer follows
    (40, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (25, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (33, 0.0, 8, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (90, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (60, 0.1, 120, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (150, 0.0, 22, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    # ... or with a line of a few words, which is a footer after running text, and the text where nothing else is
    (3, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (4, 0.0, 35, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (2, 0.0, 45, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    # ... and its link lists
    (2, 1.0, 2, 1.0, 35, 0.0, 0, 0, 0, 0, 0), (6, 0.9, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (20, 0.6, 90, 0.0, 20, 0.6, 0, 0, 0, 0, 0), (1, 1.0, 40, 0.0, 40, 0.0, 0, 0, 0, 0, 0),
)


def labelled() -> tuple:
    """The training rows. Each of PAGES is read as it is, without its footer, as the article alone, and as it is but without telling markup.

    So what the markup says counts where there is markup, and counts and densities of a block and its neighbours where there is none.
    Markup that says something is met beside short and long neighbours alike: a footer after a word, an article that is a link.
    """
    rows = []
    for words, before, after in product((1, 4, 12, 40), (0, 1, 6, 40), (0, 1, 12)):
        near = (before, 0.0, after, 0.0)
        rows += [(words, 0.0, *near, 1, inside, 0, has, 0) for inside, has in ((0, 0), (0, 1), (1, 1))]
        rows += [(words, density, *near, 0, 1, 0, 1, 1) for density in (0.0, 1.0)]
    for page in PAGES:
        for parts, readings in (("nxaf", (1, 0)), ("nxa", (1,)), ("a", (1,))):
            some = [b for b in page if b[0] in parts]
            for marked in readings:
                near = [(0, 0.0), *((words, density) for _, words, density, _ in some), (0, 0.0)]
                for i, (part, words, density, heading) in enumerate(some):
                    flags = (int(part != "a"), int(part == "a"), heading, 1) if marked else (0, 0, heading, 0)
                    rows.append((words, density, *near[i], *near[i + 2], *flags, int(part == "a")))
    return (*rows, *LABELLED)


def grow(rows: tuple, depth: int = 8) -> tuple | int:
    """A CART tree: (feature, bound, tree up to the bound, tree above it), or a class."""
    ones = sum(r[-1] for r in rows)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))
    gini = lambda part: 2 * (p := sum(r[-1] for r in part) / len(part)) * (1 - p) * len(part)
    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:], strict=False):
            low, high = [r for r in rows if r[f] <= lo], [r for r in rows if r[f] > lo]
            if best is None or gini(low) + gini(high) < best[0] - 1e-12:
                best = gini(low) + gini(high), f, (lo + hi) / 2, low, high
    if best is None:
        return int(2 * ones >= len(rows))
    return best[1], best[2], grow(tuple(best[3]), depth - 1), grow(tuple(best[4]), depth - 1)


@lru_cache(1)
def tree() -> tuple | int:
    """One tree over all rows; which question comes first is found by growing it, too."""
    return grow(labelled(), 12)


def decide(node: tuple | int, x: tuple) -> int:
    while isinstance(node, tuple):
        node = node[2] if x[node[0]] <= node[1] else node[3]
    return node


def blocks(page: str | None) -> list[tuple[str, float, bool, bool, bool]]:
    """(text, link density, in chrome, in article, heading) of each block with text, in page order."""
    out: list[tuple[str, float, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, chrome, article, unseen: what holds inside the element
    text: list[str] = []
    linked = 0
    link = -1  # open elements around an open link
    chrome = article = unseen = heading = False

    def close() -> None:
        nonlocal linked
        if text:
            words = _html.unescape("".join(text)).split()
            if words:
                out.append((" ".join(words), min(1.0, linked / len(words)), chrome, article, heading))
            text.clear()
        linked = 0

    def add(s: str) -> None:
        nonlocal linked
        if s and not unseen:
            text.append(s)
            if link >= 0:
                linked += len(s.split())

    at = 0
    page = page or ""
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if not m[2]:
            if name == "br":
                text.append(" ")
                continue
            if name == "a":
                link = len(stack) if HREF.search(m[4]) else -1
                continue
            if name in VOID:
                if name == "hr":
                    close()
                continue
            if name in INLINE and m[4] and any(ADVERT.search(a or b or c) for a, b, c in ATTR.findall(m[4])):
                text.append(" ")
                stack.append((name, chrome, article, True))  # an advert within a line ends no block
                unseen = True
                continue
            if name not in BLOCK and name not in CHROME and name not in HIDDEN and not (m[4] and UNSEEN.search(m[4])):
                continue
            if name == "p" or name == "li" or name == "option":  # these end one of their own kind that is open
                _pop(stack, name, ("ul", "ol", "menu", "select") if name != "p" else ("div", "article", "section", "td", "li", "blockquote"))
            close()
            whole = name in ("html", "body")  # what their classes say holds for no single block
            marks = MENTION.sub(" ", " ".join(a or b or c for a, b, c in ATTR.findall(m[4]))) if m[4] and not whole else ""
            top = stack[-1] if stack else ("", False, False, False)
            named = name in ("article", "main")
            good = named or bool(marks and GOOD.search(marks))
            bad = name in CHROME and not (name == "header" and top[2]) or bool(marks and not (name in TEXTUAL and top[2]) and misplaced(marks))
            # an article inside an element that only its class names sets apart is none of that
            inside = top[1] and not (named and not bad and not any(x[0] in CHROME for x in stack))
            stack.append((name, inside or bad, top[2] or good and not bad, top[3] or name in HIDDEN or bool(m[4] and UNSEEN.search(m[4]))))
        else:
            if name == "a":
                link = -1
                continue
            if not any(x[0] == name for x in stack):
                continue
            if name not in INLINE or stack[-1][0] != name or not stack[-1][3]:
                close()
            while stack.pop()[0] != name:
                pass
            if link > len(stack):
                link = -1
        _, chrome, article, unseen = stack[-1] if stack else ("", False, False, False)
        heading = any(x[0] in HEADING for x in stack[-3:])
    if at < len(page):
        add(page[at:])
    close()
    return out


def _pop(stack: list, name: str, until: tuple[str, ...]) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return
        if stack[i][0] in until:
            return


def main_text(page: str | None) -> str:
    found = blocks(page)
    sizes = [len(b[0].split()) for b in found]
    has = float(any(b[3] for b in found))
    t = tree()
    out = []
    for i, (text, density, chrome, article, heading) in enumerate(found):
        before = (sizes[i - 1], found[i - 1][1]) if i else (0, 0.0)
        after = (sizes[i + 1], found[i + 1][1]) if i + 1 < len(found) else (0, 0.0)
        if decide(t, (sizes[i], density, *before, *after, chrome, article, heading, has)):
            out.append(text)
    return " ".join(out)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The columns in keep with text and n_chars."""
    prepare(pages.sparkSession)
    source = pages.select(*keep, F.col(html).alias("__html"))

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [main_text(x) for x in columns(batch, "__html")[0]]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, type=pa.string()), pa.array([len(x) for x in texts], type=pa.int64())], names=[*keep, "text", "n_chars"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), "text string", "n_chars long"])
    return source.mapInArrow(each, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
