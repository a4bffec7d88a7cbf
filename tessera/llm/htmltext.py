"""Visible text of HTML pages, laid out.

Tags build a tree with the end tags that HTML implies; invisible elements are left out; the tree is rendered with
line breaks around blocks, blank lines between paragraphs, list markers and table cells aligned in columns.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style noscript template title iframe object canvas datalist audio video "
             "defs desc metadata symbol annotation annotation-xml".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tr ul caption".split())
# Stand on a line of their own, but leave an open paragraph open.
LINED = set("option optgroup text".split())
SPACED = set("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
# An opening tag of the key closes an open element of the value that no element of SCOPE separates from it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th", "caption", "colgroup"},
          "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"},
          "thead": {"caption", "colgroup"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "p": {"table", "td", "th", "button"}}
TABLE_SCOPE = {"table"}

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_TAG_MARK = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    """An element with its children (nodes and strings)."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def visible(self) -> bool:
        a = self.attrs
        shut = self.tag == "dialog" and "open" not in a
        return self.tag not in HIDDEN and "hidden" not in a and not shut and not _UNSEEN.search(a.get("style", ""))


class Scanner:
    """Tags and texts of a page, read forwards: every character is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.quoted = page, True
        self.last = page.rfind(">")         # no tag begins behind it

    def tag_end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``: the next ">" outside quotes; -1 without one.

        A quote without a partner is a character as any other.  Where quotes would swallow the rest of the page, they
        no longer count from there on."""
        if at > self.last:
            return -1
        first = at
        while self.quoted:
            m = _TAG_MARK.search(self.page, at)
            if m is None:
                self.quoted = False
            elif m[0] == ">":
                return m.start()
            else:
                close = self.page.find(m[0], m.end())
                if close < 0:
                    self.quoted = False
                at = close + 1
        return self.page.find(">", first)

    def __iter__(self):
        """(text, None, None, None) or (None, "/" or "", tag, attributes); ``at`` is the place behind it, and may be moved."""
        page, self.at = self.page, 0
        while self.at < len(page):
            at = self.at
            m = _OPEN.match(page, at)
            end = self.tag_end(m.end()) if m else -1
            if end >= 0:
                self.at = end + 1
                yield None, m[1], m[2].lower(), page[m.end():end]
            elif page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                self.at = end + 3 if end >= 0 else len(page)
            elif page.startswith(("<!", "<?"), at):
                end = page.find(">", at)
                self.at = end + 1 if end >= 0 else len(page)
            else:
                end = page.find("<", at + 1)
                while end >= 0 and not self.markup(end):
                    end = page.find("<", end + 1)
                self.at = end if end >= 0 else len(page)
                yield page[at:self.at], None, None, None

    def markup(self, at: int) -> bool:
        """Whether a tag, comment or declaration begins at ``at``."""
        m = _OPEN.match(self.page, at)
        return self.tag_end(m.end()) >= 0 if m else self.page.startswith(("<!", "<?"), at)


class Open:
    """The open elements, with the places of each tag among them."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {}

    def add(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def close(self, tags: set[str], scope: set[str]) -> None:
        """End an open element of ``tags`` inside the nearest element of ``scope``: of one tag the innermost, of several
        the outermost."""
        border = max((self.places[t][-1] for t in scope - tags if self.places.get(t)), default=0)
        found = []
        for t in tags:
            held = self.places.get(t)
            if held and held[-1] > border:
                found.append(held[-1] if len(tags) == 1 else held[bisect_right(held, border)])
        if found:
            for node in self.stack[min(found):]:
                self.places[node.tag].pop()
            del self.stack[min(found):]


def parse(page: str) -> Node:
    root = Node("#root", {})
    opened, scanner, folded = Open(root), Scanner(page), []
    for text, slash, tag, rest in scanner:
        if text is not None:
            opened.stack[-1].children.append(html.unescape(text))
            continue
        if slash:
            opened.close({tag}, TABLE_SCOPE if tag != "table" else set())
            if tag == "br":
                opened.stack[-1].children.append(Node("br", {}))
            continue
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(rest)} if rest else {}
        if tag in BLOCK and tag not in ("html", "body"):
            opened.close({"p"}, SCOPE["p"])
        if tag in CLOSES:
            opened.close(CLOSES[tag], SCOPE.get(tag, TABLE_SCOPE))
        node = Node(tag, attrs)
        opened.stack[-1].children.append(node)
        if tag == "details" and "open" not in attrs:
            folded.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, scanner.at)
            body = page[scanner.at:end.start() if end else len(page)]
            node.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            scanner.at = end.end() if end else len(page)
        elif tag not in VOID and not rest.endswith("/"):
            opened.add(node)
    for node in folded:         # of folded details the first summary alone is seen
        node.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return root


class _Lines:
    """Text gathered into lines: ``gap`` is the number of line ends owed before the next text."""

    def __init__(self):
        self.lines, self.gap, self.prefix = [""], 0, ""

    def block(self, blank: bool) -> None:
        self.gap = max(self.gap, 2 if blank else 1)

    def text(self, s: str, pre: bool) -> None:
        if not pre:
            s = _SPACE.sub(" ", s)
            if not s.strip(" "):
                if s and not self.gap and self.lines[-1] and not self.lines[-1].endswith(" "):
                    self.lines[-1] += " "
                return
        self._start()
        first, *rest = s.split("\n") if pre else [s]
        cur = self.lines[-1]
        if not pre and (cur.endswith(" ") or not cur.strip(" ")):
            first = first.lstrip(" ")
        self.lines[-1] = cur + first
        self.lines += rest

    def _start(self) -> None:
        if self.gap:
            if any(self.lines):
                self.lines[-1] = self.lines[-1].rstrip(" ")
                empty = next((i for i, x in enumerate(reversed(self.lines)) if x), len(self.lines))
                self.lines += [""] * (self.gap - empty)
            self.gap = 0
        if self.prefix and not self.lines[-1]:
            self.lines[-1], self.prefix = self.prefix, ""

    def newline(self) -> None:
        self._start()
        self.lines.append("")

    def whole(self) -> str:
        return "\n".join(x.rstrip(" ") for x in self.lines).strip("\n")


def _indent(text: str, marker: str) -> str:
    pad = " " * len(marker)
    return "\n".join((marker if i == 0 else pad) + x if x or i == 0 else x for i, x in enumerate(text.split("\n")))


def _table(rows: list[list[str]]) -> str:
    """Rows of cell texts in columns of equal width, two spaces apart; a cell may have several lines."""
    cells = [[c.split("\n") for c in r] for r in rows]
    width: list[int] = []
    for r in cells:
        for i, c in enumerate(r):
            width.extend([0] * (i + 1 - len(width)))
            width[i] = max(width[i], *map(len, c))
    return "\n".join("  ".join((c[k] if k < len(c) else "").ljust(width[i]) for i, c in enumerate(r)).rstrip()
                     for r in cells for k in range(max(map(len, r), default=1)))


def render(root: Node) -> str:
    """All visible text of the tree.  Works with a stack of its own, so nesting depth is not bounded by recursion."""
    done: dict[int, str] = {}           # texts of rendered list items, cells and tables
    own = {"li", "td", "th", "table", "caption"}
    todo = [(root, False)]
    while todo:                         # children that need a text of their own come first
        node, ready = todo.pop()
        if ready:
            done[id(node)] = _table_text(node, done) if node.tag == "table" else _flow(node, done)
            continue
        if node is root or node.tag in own:
            todo.append((node, True))
        todo += [(c, False) for c in node.children if isinstance(c, Node) and c.visible()]
    return done[id(root)]


def _table_text(table: Node, done: dict[int, str]) -> str:
    rows, caption, todo = [], "", [(c, None) for c in reversed(table.children)]
    loose = []
    while todo:
        node, row = todo.pop()
        if not isinstance(node, Node):
            if node.strip():
                loose.append(_SPACE.sub(" ", node).strip())
        elif node.visible():
            if node.tag in ("td", "th"):
                if row is None:
                    rows.append(row := [])
                row.append(done[id(node)])
                row += [""] * (min(int(span), 100) - 1 if (span := node.attrs.get("colspan", "")).isdecimal() and int(span) > 1 else 0)
            elif node.tag in ("caption", "table", "li"):
                if node.tag == "caption":
                    caption = done[id(node)]
                else:
                    loose.append(done[id(node)])
            else:
                if node.tag == "tr":
                    rows.append(row := [])
                todo += [(c, row) for c in reversed(node.children)]
    return "\n".join(x for x in (*loose, caption, _table([r for r in rows if r])) if x)


def _flow(top: Node, done: dict[int, str]) -> str:
    out = _Lines()
    count: dict[int, int] = {}
    pre0 = top.tag == "pre"
    todo = [(c, pre0, id(top), top.tag) for c in reversed(top.children)]
    while todo:
        node, pre, parent, kind = todo.pop()
        if node is None:
            out.block(kind in SPACED)
        elif isinstance(node, str):
            out.text(node, pre)
        elif not node.visible():
            continue
        elif node.tag == "br":
            out.newline()
        elif node.tag == "img":
            out.text(node.attrs.get("alt", ""), False)
        elif node.tag == "input":
            if node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                out.text(node.attrs.get("value", ""), False)
        elif node.tag in ("li", "table", "caption", "td", "th"):
            text = done[id(node)]
            out.block(node.tag == "table")
            if node.tag == "li":
                start = node.attrs.get("value", "")
                count[parent] = int(start) if start.isdecimal() and len(start) < 10 else count.get(parent, 0) + 1
                text = _indent(text, f"{count[parent]}. " if kind == "ol" else "- ") if text else ""
            if text:
                out.text(text, True)
            out.block(node.tag == "table")
        else:
            if node.tag in BLOCK or node.tag in LINED:
                out.block(node.tag in SPACED)
                todo.append((None, pre, 0, node.tag))
            if node.tag == "ol" and (s := node.attrs.get("start", "")).isdecimal() and len(s) < 10:
                count[id(node)] = int(s) - 1
            todo += [(c, pre or node.tag == "pre", id(node), node.tag) for c in reversed(node.children)]
    return out.whole()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id_col, title, text, n_chars) for every row: the page's title and all its visible text, laid out.

    Null and empty pages have an empty title and text.  Broken markup never fails: what cannot be a tag is text, and
    elements left open end with the page.  Repeated rows keep a row each; an empty table gives an empty result; other
    columns are not carried."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                titles, texts = [], []
                for page in part.column(1).to_pylist():
                    root = parse(page or "")
                    titles.append(_title(root))
                    texts.append(render(root))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string())],
                                                 names=[id_col, "title", "text"])

    kind = pages.select(id_col).schema[0].dataType.simpleString()
    return (pages.select(id_col, F.col(html_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, title string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))


def _title(root: Node) -> str:
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return ""
