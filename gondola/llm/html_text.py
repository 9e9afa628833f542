"""Main text of web pages by tag-path ratios.

A page's text is cut into blocks at block-level tags.  For every root-to-leaf
tag path the text length (outside links) and the punctuation of its blocks are
added up; length and punctuation per block are the path's two ratios.  Each
block takes its path's ratios, which are smoothed over neighbouring blocks and
fused by multiplication; blocks above the page's threshold are the seeds.  The
content is the deepest element that holds nearly all of the seeds' weight, at
most down to the article or main element and to what holds all text of a page
without one, less the paths that are menus, headers, footers, sidebars, notices,
adverts, forms or reader comments by their tag, role, class or id.  A block
beside the content is kept if its own path's ratios are those of the content.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, ship, without

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template iframe object svg annotation annotation-xml canvas audio video title textarea select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody "
    "tfoot thead tr ul".split())
#: A start tag of the key closes an open element of the value, up to the barrier.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tbody", "thead", "tfoot"}, "body": {"head"}}
BARRIER = frozenset("ul ol dl table div article section body html main menu".split())
# Words that name boilerplate in tags, roles, classes and ids.
BOILERPLATE_TAGS = frozenset("nav aside footer form button dialog menu search fieldset label".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert disclaimer popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menus breadcrumb "
    "breadcrumbs pagination pager sidebar sidebars aside rail widget widgets footer header masthead topbar toolbar share sharing social "
    "related recommended recommendations comment comments disqus respond reply replies responses discussion feedback search form skip "
    "adbox adslot adsense promoted outbrain taboola announcement toast paywall infobar privacy side sidenav branding logo topnav colophon "
    "copyright crumb crumbs".split())
#: A header belongs to the text if it is named as the header of one of these.
HEADERS = frozenset("header masthead".split())
CONTENT_NAMES = frozenset("article post entry story content section".split())
_CONTENT_TAGS = frozenset({"article", "main"})
#: Words that say nothing of their own beside a name ("site-footer", "comments-area").
STRUCTURE = frozenset(
    "area article articles bar block blog body bottom box btn button buttons center col column container content count cta desktop element "
    "entry extra first fixed global grid group holder home icon icons id info inner item items last layer left link links list main message "
    "meta mobile module new news number outer page panel pane post posts primary recent region right row secondary section site slot small "
    "sticky stories story text thread title toggle top trail unit user wp wrap wrapper zone".split())
#: Names that are also words of texts: they count only where the whole token is known.
AMBIGUOUS = frozenset(
    "ad ads advertising alert announcement banner branding copyright crumb crumbs disclaimer discussion feedback form login logo menu menus "
    "notice notices overlay modal navigation privacy promotion promo rail reply respond responses search share sharing side signup skip social "
    "subscription toast widget widgets".split())
#: Names of services and legal notes, also before a word that is not known.
SERVICES = frozenset("adsense breadcrumb breadcrumbs consent cookie cookies disqus gdpr newsletter outbrain taboola".split())
#: Parts of a page builder, overruled where the path ratios find the text in them.
PARTS = frozenset("form modal overlay rail side widget widgets".split())
#: Ids of sections that follow a text, also under a heading of their own.
FOLLOWING = frozenset("ad ads adverts comment comments disqus newsletter recommendations recommended related replies reply respond share sharing "
                      "signup sponsored subscribe taboola outbrain".split())
#: Names of what readers and other pages add: they mark an article element too and never wrap the text.
ADDED = frozenset("comment comments disqus recommendations recommended related replies reply respond".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: "has-sidebar" and the like tell of a layout, not of the element itself.
_LAYOUT = re.compile(r"(?<![^\W_])(?:(?i:has|with|without|no)[-_]+|(?:[Hh]as|[Ww]ith|[Ww]ithout|[Nn]o)(?=[A-Z]))[\w-]+")

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

#: Share of the seeds' weight that the content element has to hold.
HOLDS = 0.8
#: Blocks under this share of the mean smoothed ratio are no seeds.
THRESHOLD = 0.5


def _boilerplate_names(token: str, slug: bool) -> set[str]:
    """Boilerplate names in a class or, as a ``slug``, an id.

    All other words of the token have to be structure; a class may also end in
    an unambiguous name ("theme-footer") or start with a service's.
    """
    words = [w.lower() for w in _WORD.findall(token)]
    found = BOILERPLATE_NAMES.intersection(words)
    if not found or all(w in found or w in STRUCTURE for w in words):
        return found
    if slug:
        return set()
    while words[-1] in STRUCTURE:
        words.pop()
    return (found - AMBIGUOUS).intersection(words[-1:]) | SERVICES.intersection(words[:1])


class _Page:
    """Elements (parent, label, boilerplate) and blocks (element, text, link characters)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.label, self.marked, self.named = [-1], [""], [""], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.inside = [False]  # of an article or main element
        self.added = [False]  # named as added by readers or other pages
        self.form = [False]
        self.part = [False]  # named as a part of a page builder only
        self.unheaded = [False]  # boilerplate only without a heading of its own
        self._stack = [0]
        self._opened: Counter[str] = Counter()
        self._endless: set[str] = set()
        self._pieces: list[tuple[str, bool]] = []
        self._links = 0
        self._parse(source)

    def _flush(self) -> None:
        text = " ".join("".join(p for p, _ in self._pieces).split())
        if text:
            linked = len(" ".join("".join(p for p, in_link in self._pieces if in_link).split()))
            self.blocks.append((self._stack[-1], text, linked))
        self._pieces = []

    def _open(self, tag: str, attributes: str) -> None:
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        classes, own_id = _LAYOUT.sub(" ", given.get("class", "")), given.get("id", "")
        hidden = "hidden" in given or re.search(r"display\s*:\s*none", given.get("style", ""), re.I) is not None
        inside = self.inside[self._stack[-1]]
        names = set().union(*(_boilerplate_names(x, False) for x in classes.split()))
        named_by_id = _boilerplate_names(own_id, True)
        if tag in _HEADINGS or inside and tag in ("p", "pre", "blockquote", "figure", "table"):
            named_by_id = set()
        if inside or CONTENT_NAMES.intersection(w.lower() for w in _WORD.findall(f"{classes} {own_id}")):
            names -= HEADERS
            named_by_id -= HEADERS
        self.unheaded.append(inside and tag == "section" and not names and not named_by_id & FOLLOWING)
        names |= named_by_id
        self.part.append(bool(names) and names <= PARTS)
        self.inside.append(inside or tag in _CONTENT_TAGS)
        self._opened[tag] += 1
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.label.append(".".join([tag, *given.get("class", "").lower().split()]))
        role = given.get("role", "").lower()
        self.form.append(tag == "form" and not hidden and (role == "form" or role not in BOILERPLATE_ROLES))
        self.marked.append(not self.form[-1] and (tag in BOILERPLATE_TAGS or tag == "header" and not inside or hidden or role in BOILERPLATE_ROLES))
        self.added.append(bool(names & ADDED))
        self.named.append(bool(names & ADDED if tag in _CONTENT_TAGS else names) and tag not in ("main", "html", "body"))
        self._stack.append(len(self.tag) - 1)

    def _close(self, tags: set[str], barrier: frozenset) -> None:
        """Close the innermost open element of these tags, if no barrier stands before it."""
        if not any(self._opened[t] for t in tags):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[k]] in tags:
                self._opened.subtract(self.tag[e] for e in self._stack[k:])
                del self._stack[k:]
                return
            if self.tag[self._stack[k]] in barrier:
                return

    def _end_of(self, tag: str, source: str, at: int) -> int | None:
        """Where the element's end tag ends, None if there is none."""
        if tag in self._endless:
            return None
        end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
        if end is None:
            self._endless.add(tag)
        return end.end() if end else None

    def _parse(self, source: str) -> None:
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                piece = source[at:m.start()]
                self._pieces.append((html.unescape(piece) if "&" in piece else piece, self._links > 0))
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    self._links = max(0, self._links - 1)
                elif tag in BLOCKS:
                    self._flush()
                    self._close({tag}, frozenset())
                elif tag in ("td", "th"):
                    self._pieces.append((" ", False))
                continue
            if tag == "label" and not self._opened["form"]:
                continue  # words of the text, as any inline element's
            if tag in SILENT and not m[3].endswith("/>"):
                at = self._end_of(tag, source, at) or len(source)
                continue
            if tag == "br":
                self._pieces.append((" ", False))
            elif tag == "a":
                self._links = 1
            elif tag in BLOCKS or tag in ("td", "th", "button", "label"):
                if tag in BLOCKS:
                    self._flush()
                    self._close({"p"}, BARRIER)
                else:
                    self._pieces.append((" ", False))
                if tag in CLOSES:
                    self._close(CLOSES[tag], BARRIER - CLOSES[tag])
                if tag in BLOCKS and tag not in VOID:
                    self._links = 0
                    self._open(tag, m[3])
                elif tag in ("button", "label"):
                    at = self._end_of(tag, source, at) or at
        if at < len(source):
            piece = source[at:]
            self._pieces.append((html.unescape(piece) if "&" in piece else piece, self._links > 0))
        self._flush()


def _smooth(x: np.ndarray) -> np.ndarray:
    """Weights 1, 2, 1 over neighbouring blocks."""
    padded = np.pad(x, 1, mode="edge")
    return (padded[:-2] + 2 * padded[1:-1] + padded[2:]) / 4


def _content_element(page: _Page, weights: np.ndarray, blocks: list[tuple[int, str, int]], menus: list[bool]) -> int:
    """The deepest element that holds nearly all weight.

    It is no deeper than the article or main element, and without one no deeper
    than the element that holds all blocks besides menus.
    """
    held, texts = [0.0] * len(page.parent), [0] * len(page.parent)
    encloses = [tag in _CONTENT_TAGS for tag in page.tag]
    for (element, _, _), w, menu in zip(blocks, weights, menus):
        held[element] += w
        texts[element] += not menu
    heaviest: dict[int, int] = {}
    for e in range(len(held) - 1, 0, -1):  # children come after their parents
        up = page.parent[e]
        held[up] += held[e]
        texts[up] += texts[e]
        encloses[up] |= encloses[e]
        if up not in heaviest or held[e] >= held[heaviest[up]]:
            heaviest[up] = e
    at = 0
    while page.tag[at] not in _CONTENT_TAGS:
        best = heaviest.get(at)
        # a paragraph alone is no container: its neighbours belong to the text
        if best is None or held[best] < HOLDS * held[0] or page.tag[best] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote"):
            return at
        if texts[best] < texts[at] and not encloses[best]:
            return at
        at = best
    return at


def _paths(page: _Page, blocks: list[tuple[int, str, int]]) -> tuple[list[int], dict, dict, dict, dict]:
    """Tag path of each block, and each path's text characters, punctuation, blocks and link characters."""
    number: dict[tuple[int, str], int] = {}  # of each tag path, by its parent path and label
    path_of = [0] * len(page.parent)
    for e in range(1, len(page.parent)):
        path_of[e] = number.setdefault((path_of[page.parent[e]], page.label[e]), len(number) + 1)
    paths = [path_of[element] for element, _, _ in blocks]
    chars, points, count, linked = (defaultdict(float) for _ in range(4))
    for path, (_, text, in_links) in zip(paths, blocks):
        chars[path] += len(text) - in_links
        linked[path] += in_links
        points[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
    return paths, chars, points, count, linked


def _path_weights(page: _Page, blocks: list[tuple[int, str, int]]) -> list[float]:
    """Each block's text characters by its own path's ratios."""
    paths, chars, points, count, _ = _paths(page, blocks)
    return [chars[p] / count[p] * (0.5 + points[p] / count[p]) * (len(b[1]) - b[2]) for p, b in zip(paths, blocks)]


def _boilerplate(page: _Page, parts: bool) -> list[bool]:
    """Boilerplate elements, with or without those named as parts of a page.

    An element named like boilerplate is a layout container if it wraps the
    article that outweighs all text outside such elements; so is a form that
    wraps an article or holds nearly all of the page's text.
    """
    n = len(page.parent)
    headed, wraps = [False] * n, [False] * n
    for e in range(n - 1, 0, -1):  # children come after their parents
        headed[page.parent[e]] |= headed[e] or page.tag[e] in _HEADINGS
    named = [page.named[e] and not (page.unheaded[e] and headed[e]) and (parts or not page.part[e]) for e in range(n)]
    marked, under, added = [False] * n, [False] * n, [False] * n  # by tag or role, name, name of an addition; each with its subtree
    article = [0] * n  # outermost article or main element, without those outside a named element around it
    for e in range(1, n):
        up = page.parent[e]
        marked[e] = marked[up] or page.marked[e]
        under[e] = under[up] or named[e]
        added[e] = added[up] or named[e] and page.added[e]
        article[e] = 0 if named[e] else article[up] or (e if page.tag[e] in _CONTENT_TAGS else 0)
    exempt: set[int] = set()
    if any(under[a] and not added[a] for a in article):
        blocks = [b for b in page.blocks if not marked[b[0]]]
        held, rest = defaultdict(float), 0.0
        for (element, _, _), w in zip(blocks, _path_weights(page, blocks)):
            if not under[element]:
                rest += w
            elif article[element] and not added[element]:
                held[article[element]] += w
        at = max(held, key=held.__getitem__, default=0)
        if held[at] > rest:
            while at > 0:
                exempt.add(at)
                at = page.parent[at]
    out = [False] * n
    for e in range(1, n):
        out[e] = out[page.parent[e]] or page.marked[e] or named[e] and e not in exempt
    if any(page.form):
        chars = [0] * n
        for element, text, in_links in page.blocks:
            if not out[element]:
                chars[element] += len(text) - in_links
        for e in range(n - 1, 0, -1):
            chars[page.parent[e]] += chars[e]
            wraps[page.parent[e]] |= wraps[e] or page.tag[e] in _CONTENT_TAGS and not out[e]
        for e in range(1, n):
            out[e] = out[page.parent[e]] or out[e] or page.form[e] and not wraps[e] and chars[e] < HOLDS * chars[0]
    return out


def main_text(source: str) -> str:
    """Main text of one page: blocks in page order joined by two line ends."""
    page = _Page(source)
    out = _boilerplate(page, True)
    blocks = [b for b in page.blocks if not out[b[0]]]
    if any(page.part):
        wide = _boilerplate(page, False)
        more = [b for b in page.blocks if not wide[b[0]]]
        weights = _path_weights(page, more)
        if sum(w for w, b in zip(weights, more) if out[b[0]]) >= HOLDS * sum(weights):
            blocks = more
    if not blocks:
        return ""
    paths, chars, points, count, linked = _paths(page, blocks)
    inside = np.array([10.0 if page.inside[b[0]] else 1.0 for b in blocks])
    length = _smooth(np.array([chars[p] / count[p] for p in paths]))
    marks = _smooth(np.array([points[p] / count[p] for p in paths]))
    fused = inside * length * (0.5 + marks)
    weights = np.where(fused >= THRESHOLD * fused.mean(), fused, 0.0) * np.array([len(b[1]) - b[2] for b in blocks])
    if not weights.any():
        weights = np.array([float(len(b[1])) for b in blocks])
    menus = [count[p] >= 3 and linked[p] >= 0.8 * (chars[p] + linked[p]) and linked[p] / count[p] < 40 for p in paths]
    content = _content_element(page, weights, blocks, menus)
    under = [e == content for e in range(len(page.parent))]
    for e in range(content + 1, len(under)):
        under[e] = under[page.parent[e]]
    # blocks beside the content stay by the ratios of their own paths, and a title if the content has none
    own = np.array([chars[p] / count[p] * (0.5 + points[p] / count[p]) for p in paths])
    least = THRESHOLD * own[[under[b[0]] for b in blocks]].mean()
    untitled = not any(under[e] and page.tag[e] == "h1" for e, _, _ in blocks)
    # links inside an article are part of it: menus are judged where no article is marked
    whole = page.tag[content] in _CONTENT_TAGS
    article = [0] * len(page.parent)  # outermost article or main element
    for e in range(1, len(article)):
        article[e] = article[page.parent[e]] or (e if page.tag[e] in _CONTENT_TAGS else 0)
    kept = []
    for path, (element, _, _), ratio, menu in zip(paths, blocks, own, menus):
        beside = ratio >= least and linked[path] <= chars[path] or untitled and page.tag[element] == "h1"
        kept.append(under[element] and (whole or article[element] > 0 or not menu) or beside and not menu)
    # and an article of which a paragraph stays keeps its headings
    stay = {article[b[0]] for b, k in zip(blocks, kept) if k and page.tag[b[0]] not in _HEADINGS} - {0}
    kept = [k or page.tag[b[0]] in _HEADINGS and article[b[0]] in stay for b, k in zip(blocks, kept)]
    return "\n\n".join(b[1] for b, k in zip(blocks, kept) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text (main text of the whole ``html``) and n_chars.

    Null and empty html give an empty text; markup that never closes is read to
    its end; very long pages are read whole; repeated rows come back repeated; of
    elements that hold equal weight the first is the content; an empty table gives
    an empty one.  Incoming text and n_chars
    columns are replaced.
    """
    ship(pages.sparkSession)
    own = without(pages, ["text", "n_chars"])
    width, at = len(own.columns), own.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) if x else "" for x in (s.as_py() for s in batch.column(at))]
            yield pa.RecordBatch.from_arrays(batch.columns[:width] + [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                             names=batch.schema.names[:width] + ["text", "n_chars"])

    return map_batches(own, run, T.StructType(own.schema.fields + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
