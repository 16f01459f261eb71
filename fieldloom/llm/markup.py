"""A linear reader of web pages: text pieces and tags in order, with the zone of the page that each stands in."""

from __future__ import annotations

import html
import re
from functools import lru_cache

# Fixed values of the markup language and of common naming habits ------------------------------------------------

VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is read as it stands, up to their own end tag; none of it is page text.
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
BLOCK = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol option p pre search section select summary table tbody td template"
    " tfoot th thead tr ul".split()
)
#: Start tags that leave an open paragraph open.
IN_PARAGRAPH = frozenset("button caption dd dt head html body li option select tbody td template tfoot th thead tr".split())
#: End tags do not reach beyond these.
BARRIER = frozenset("td th caption table template button".split())
#: A start tag ends an open element of the first kind that is nearer than the nearest of the second kind.
IMPLIED_END = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
    "a": ("a", ()),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: they are no section of a page by themselves.
TEXT_BLOCKS = HEADINGS | frozenset(
    "p li ul ol dl dt dd blockquote pre table thead tbody tfoot tr caption figure figcaption address hgroup summary".split()
)
#: Never text of an article.
APART = frozenset(
    "head nav aside footer form button select option datalist optgroup label fieldset legend output menu dialog template object applet"
    " audio video canvas svg map search".split()
) | RAW
APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar tablist".split()
)
#: Words of class and id names.
APART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising advertorial adsense adsbygoogle adslot adunit adbox sponsor sponsors"
    " sponsored sponsorship promo promos promotion promotions promoted banner banners cookie cookies consent gdpr notice notices notification"
    " notifications alert alerts announcement newsletter subscribe subscription signup signin login logon paywall sidebar sidebars sidenav"
    " aside rail nav navs navbar navigation subnav menu menus submenu breadcrumb breadcrumbs topbar toolbar masthead footer footers"
    " colophon copyright pagination pager paginator share shares sharing sharebar social socials popup popups modal overlay lightbox toast"
    " related recommended recommendations recirculation trending outbrain taboola search searchbox searchform skip skiplink".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist commentform commenter disqus respond replies reply".split())
#: Apart only outside an article: within it they are its own heading.
OUTER_NAMES = frozenset("header headers topheader siteheader".split())
#: Beside a name they tell nothing else.
LAYOUT_WORDS = frozenset(
    "list section box wrap wrapper container area block buttons links bar side slot unit form top bottom left right center inner outer widget"
    " thread posts articles stories items col column panel group row id".split()
)
#: In front of a name they speak of the page around it.
ABOUT = frozenset("no has with without is not hide show".split())
#: A class that is one of these words speaks for content, whatever else the element is named.
CONTENT_CLASSES = frozenset("content article post entry story".split())
IN_HEAD = frozenset("meta link script style title base basefont bgsound noscript noframes template".split())

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+""")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WIDE = re.compile(r"[぀-ヿ㐀-䶿一-鿿가-힯]")

#: A line of rights outside the content of a page.
_RIGHTS = re.compile(r"\s*(?:copyright\s*)?(?:©|\(c\)\s)", re.IGNORECASE)

#: How a page may mark its content, the strongest first.
MARKS = ("article", "body", "main")


def _parts(name: str) -> list[str]:
    """The words of a class or id name, and neighbours taken together (side-bar)."""
    words = [w.lower() for w in _NAME_PARTS.findall(name)]
    return words + [a + b for a, b in zip(words, words[1:], strict=False)]


def _named(name: str, names: frozenset[str]) -> bool:
    parts = _parts(name)
    return bool(parts) and parts[0] not in ABOUT and not names.isdisjoint(parts)


@lru_cache(maxsize=4096)
def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


@lru_cache(maxsize=4096)
def zone(name: str, raw: str, in_article: bool) -> tuple[bool, str | None]:
    """(stands apart from the content, the mark it carries) of an element, by its tag and attributes."""
    given = _attributes(raw) if raw else {}
    role = given.get("role", "").strip().lower()
    prop = given.get("itemprop", "").lower()
    mark = "article" if name == "article" else "body" if prop == "articlebody" else "main" if name == "main" or role == "main" else None
    if name in ("html", "body"):
        return False, None
    if name in APART or role in APART_ROLES or (name == "header" and not in_article):
        return True, None
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or _HIDDEN_STYLE.search(given.get("style", "")):
        return True, None
    classes, own_id = given.get("class", "").split(), given.get("id", "")
    if any(_named(c, COMMENT_NAMES) for c in classes):
        return True, None
    if name not in HEADINGS and own_id:
        # the id of a part of an article is often made from its heading: there it counts if all its words speak of layout
        words = [w.lower() for w in _NAME_PARTS.findall(own_id)]
        known = COMMENT_NAMES if mark else COMMENT_NAMES | APART_NAMES
        layout = not in_article or all(w in known or w in LAYOUT_WORDS or w.isdigit() for w in words)
        if layout and _named(own_id, known):
            return True, None
        if not in_article and not mark and _named(own_id, OUTER_NAMES):
            return True, None
    if mark != "main" and not any(c.lower() in CONTENT_CLASSES for c in classes):
        names = APART_NAMES if in_article or mark else APART_NAMES | OUTER_NAMES
        if any(_named(c, names) for c in classes):
            return True, None
    return False, mark


class Page:
    """The pieces of a page's text and the items of its scan, in page order.

    ``pieces``: [text, block, starts a new block]; ``items``: (class, count, piece or -1,
    apart, mark): a class is ``text`` or ``link`` for words, otherwise the name of a tag.
    ``parent``, ``tag``, ``mark`` describe the elements by number; 0 is the page.
    """

    def __init__(self, source: str):
        self.pieces: list[list] = []
        self.items: list[tuple[str, int, int, bool, bool]] = []
        self.parent, self.tag, self.mark = [0], ["#page"], [None]
        self._apart = [False]
        self._stack = [0]
        self._where: dict[str, list[int]] = {}
        self._break = True
        self._read(source)

    # reading ------------------------------------------------------------------

    def _read(self, source: str) -> None:
        at, size, quotes = 0, len(source), True
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                return
            after = source[start + 1 : start + 2]
            if after == "/":
                after = "/" if source[start + 2 : start + 3].isalpha() and source[start + 2 : start + 3].isascii() else "?"
            if not (after.isascii() and after.isalpha()) and after not in ("/", "!", "?"):
                self._text(source[at : start + 1])
                at = start + 1
                continue
            if start > at:
                self._text(source[at:start])
            if after in ("!", "?"):
                at = self._remark(source, start)
                continue
            found = _TAG.match(source, start) if quotes else None
            if found:
                name, raw, at = found[1].lower(), found[2], found.end()
            else:
                # a quote is never closed: from here on a tag ends at the next bracket
                quotes = False
                at = source.find(">", start) + 1
                if not at:
                    return
                plain = source[start:at].strip("</>").split(None, 1) or [""]
                name, raw = plain[0].lower(), plain[1] if len(plain) > 1 else ""
            if after == "/":
                self._end(name)
            else:
                self._start(name, raw)
                if name in RAW:
                    end = _RAW_END[name].search(source, at)
                    at = end.start() if end else size

    @staticmethod
    def _remark(source: str, start: int) -> int:
        """Where the comment or declaration at ``start`` ends."""
        if source.startswith("<!--", start):
            if source.startswith((">", "->"), start + 4):
                return source.index(">", start) + 1
            end = _COMMENT_END.search(source, start + 4)
            return end.end() if end else len(source)
        return source.find(">", start) + 1 or len(source)

    # elements -----------------------------------------------------------------

    def _nearest(self, names) -> int:
        return max((self._where[n][-1] for n in names if self._where.get(n)), default=-1)

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            name = self.tag[self._stack.pop()]
            self._where[name].pop()
            if name in BLOCK:
                self._where["#block"].pop()
                self._break = True

    def _item(self, name: str, element: int) -> None:
        # inside a zone that stands apart only the zone's own tags count
        if not self._apart[self.parent[element]]:
            self.items.append((name, 1, -1, self._apart[element], self._in(element)))

    def _in(self, element: int) -> bool:
        return self.mark[element] is not None

    def _start(self, name: str, raw: str) -> None:
        if name in ("html", "body") and self._where.get(name):
            return
        if name in BLOCK:
            self._break = True
            if name not in IN_PARAGRAPH:
                paragraph = self._nearest(("p",))
                if paragraph > self._nearest(BARRIER):
                    self._pop_to(paragraph)
        if name in IMPLIED_END:
            ends, within = IMPLIED_END[name]
            depth = self._nearest(ends.split())
            if depth > self._nearest(within) and depth > self._nearest(BARRIER - {"td", "th"} if name in ("td", "th") else BARRIER):
                self._pop_to(depth)
        if self._where.get("head") and name not in IN_HEAD:
            self._pop_to(self._where["head"][-1])
        above = self._stack[-1]
        describe = zone if len(raw) < 2000 else zone.__wrapped__
        apart, mark = describe(name, raw, self.mark[above] is not None)
        if name == "br":
            self._break = True
        element = len(self.parent)
        inherited = self.mark[above]
        # the strongest mark counts within its element
        kept = min((m for m in (mark, inherited) if m), key=MARKS.index, default=None)
        self.parent.append(above)
        self.tag.append(name)
        self.mark.append(kept)
        self._apart.append(self._apart[above] or apart)
        self._item(name, element)
        if name in VOID or (raw.endswith("/") and self._where.get("svg")):
            return
        depth = len(self._stack)
        self._stack.append(element)
        self._where.setdefault(name, []).append(depth)
        if name in BLOCK:
            self._where.setdefault("#block", []).append(depth)

    def _end(self, name: str) -> None:
        if name in BLOCK or name == "br":
            self._break = True
        if name in ("html", "body"):
            return
        depth = self._nearest(HEADINGS) if name in HEADINGS else self._nearest((name,))
        floor = self._nearest(BARRIER) if name in BLOCK else self._nearest(("#block",))
        if depth < 0 or (depth < floor and name not in BARRIER | {"tr", "tbody", "thead", "tfoot"}):
            return
        self._item(name, self._stack[depth])
        self._pop_to(depth)

    # text ---------------------------------------------------------------------

    def _text(self, raw: str) -> None:
        if not raw or (raw.isspace() and (self._break or not self.pieces)):
            return
        element = self._stack[-1]
        text = html.unescape(raw) if "&" in raw else raw
        count = len(text.split())
        if not text.isascii():
            count += len(_WIDE.findall(text)) // 2
        kind = "link" if self._where.get("a") else "text"
        rights = not self._in(element) and _RIGHTS.match(text)
        if self._apart[element] or rights:
            if count:
                self.items.append((kind, count, -1, True, self._in(element)))
            return
        block = self._where.get("#block")
        self.pieces.append([text, self._stack[block[-1]] if block else 0, self._break])
        self._break = False
        if count:
            self.items.append((kind, count, len(self.pieces) - 1, False, self._in(element)))
