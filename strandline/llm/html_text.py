"""Layout-aware rendering of HTML: a tree with implied tags, visibility rules, then all visible text in its layout.

The tree builder supplies what authors leave out: html, head and body are implied; a new p, li, dt/dd, option, tr, td,
th or table section closes the one before it; a cell outside a row opens one, and one in an inline element finds its row;
what is in a table but in no cell moves in front of it, and a form there holds nothing; a block closes an open p; end tags close up to their element and are
dropped where none is open; void elements take no content; raw text elements end at their own end tag alone. Not
rendered are head and raw text elements (script, style and the like), noscript's fallback, comments, and elements
hidden by the hidden attribute, aria-hidden, a style (display: none, visibility: hidden unless a part of it is made
visible again, zero opacity), inline or by a style sheet's rule for a tag, class or id (of rules for some media, those for
a screen of SCREEN pixels), a closed dialog, or an input of type hidden; a closed details shows its summary. Of SVG its texts are shown, of MathML all but
annotations, of a select the labels of its options and their groups.

Layout: blocks begin lines; paragraphs, headings, lists, tables, quotations and preformatted text have an empty line
around them; br ends a line; list items have a dash or their number (start, value and reversed are kept) and are
indented with their depth; a table's cells are padded to their column's width, a cell of several columns or rows covers them
(a line longer than WIDE widens no column; cells after it stand two spaces behind it). Lists, quotations and tables inside
LEVELS others are indented and aligned no further: their texts, marks and lines stay.
preformatted text keeps its white space, all else has runs of it made one space. Images give their alt text, inputs
of buttons their value. Text inside links stays; addresses do not.

Each page is rendered by itself, in one pass without a shuffle. Defined results: null or empty HTML gives empty text;
broken markup never raises, each tag is read once, and elements may be nested to any depth, as trees are walked with stacks of
their own; text inside a tag that the page's end leaves open is not shown; repeated rows are rendered alike. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 100
WIDE = 1000
SCREEN = 1280
TEXTS = "id bigint, title string, text string, n_blocks int"

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist title meta link base source track param area map".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr article section".split())
LISTS = frozenset("ul ol menu dir".split())
FOREIGN_UNSEEN = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
ROWS = frozenset("table thead tbody tfoot tr".split())
TABLE_PARTS = frozenset("tr td th thead tbody tfoot caption colgroup col".split())
#: An opening tag closes the nearest open element of these, unless one of the others stands between.
CLOSES = {
    "li": ("li", LISTS), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "option": ("option", {"select", "datalist"}), "optgroup": ("optgroup option", {"select"}),
    "tr": ("tr caption colgroup", {"table"}), "td": ("td th", {"table", "tr"}), "th": ("td th", {"table", "tr"}),
    "thead": ("thead tbody tfoot caption colgroup", {"table"}), "tbody": ("thead tbody tfoot caption colgroup", {"table"}), "tfoot": ("thead tbody tfoot caption colgroup", {"table"}), "body": ("head", frozenset()),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b)) for k, (a, b) in CLOSES.items()}
SCOPE = frozenset("table td th caption button html body".split())
HEAD_ONLY = frozenset("title meta link base style script noscript template head".split())

# Possessive, and no two alternatives begin alike, so a tag is read once. A quote counts after "=" alone.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DISPLAY = re.compile(r"(?:^|[;{\s])display\s*:\s*([a-z-]+)", re.I)
_VISIBILITY = re.compile(r"(?:^|[;{\s])visibility\s*:\s*([a-z]+)", re.I)
_CLEAR = re.compile(r"(?:^|[;{\s])opacity\s*:\s*0(?:\.0*)?%?\s*(?:;|!|$)", re.I)
_WIDTH = re.compile(r"\(\s*(min|max)-width\s*:\s*([\d.]+)\s*(px|em|rem)\s*\)", re.I)
_SIMPLE = re.compile(r"([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)$", re.I)
_SPACE = re.compile(r"[ \t\r\n\f\v]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], None


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" else value))
    return out


def parse(source: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    head, body = Node("head", {}), Node("body", {})
    root.children += [head, body]
    stack, in_body, at = [root, head], False, 0
    open_: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag

    def push(node: Node) -> None:
        open_[node.tag].append(len(stack))
        stack.append(node)

    def cut(i: int) -> None:
        for x in reversed(stack[max(i, 2) if stack[1] is head else i :]):
            open_[x.tag].pop()
        del stack[i:]

    def nearest(tags) -> int:
        """The place of the innermost open element of these, -1 without one."""
        return max((open_[t][-1] for t in tags if open_[t]), default=-1)

    def enter_body():
        nonlocal in_body
        in_body = True
        cut(1)
        push(body)

    def put(child, foster: bool) -> None:
        """At the stack's top, or in front of the table whose part that is."""
        top = stack[-1]
        if foster and top.tag in ROWS:
            table = stack[open_["table"][-1]] if open_["table"] else None
            if table is not None and table.parent is not None:
                top, k = table.parent, len(table.parent.children) - 1
                while top.children[k] is not table:
                    k -= 1
                top.children.insert(k, child)
            else:
                top.children.append(child)
        else:
            top.children.append(child)
        if isinstance(child, Node):
            child.parent = top

    def text(piece: str):
        if not piece:
            return
        if not in_body and len(stack) == 2:
            if not piece.strip():
                return
            enter_body()
        put(html.unescape(piece), bool(piece.strip()))

    def close(tags, stop) -> None:
        i = nearest(tags)
        if i > 1 and i >= nearest(stop):
            cut(i)

    look = 0
    while at < len(source):
        i = source.find("<", max(at, look))
        if i < 0:
            text(source[at:])
            break
        ahead = source[i + 1 : i + 2]
        if ahead in ("!", "?") or (ahead == "/" and not source[i + 2 : i + 3].isalpha()):
            text(source[at:i])
            start, ending = (i + 9, "]]>") if source.startswith("<![CDATA[", i) else (i + 2, "-->") if source.startswith("<!--", i) else (i + 1, ">")
            end = source.find(ending, start)
            if ending == "]]>":
                text(source[start : end if end >= 0 else len(source)])
            at = end + len(ending) if end >= 0 else len(source)
            continue
        if not (ahead == "/" or (ahead.isascii() and ahead.isalpha())):
            look = i + 1  # a sign of the text
            continue
        m = _TAG.match(source, i)
        text(source[at:i])
        if m is None:  # the page ends inside a tag, or within a quoted value
            break
        at = m.end()
        tag, closed = m[2].lower(), m[3].rstrip().endswith("/")
        if m[1]:  # an end tag
            if tag in ("html", "body"):
                continue
            if tag == "head":
                enter_body()
            elif tag == "p" and not open_["p"]:
                put(Node("p", {}), True)
            elif tag == "br":
                put(Node("br", {}), True)
            else:
                close({tag}, {"table"} if tag not in TABLE_PARTS and tag != "table" else frozenset())
            continue
        if tag in ("html", "head", "body"):
            node = {"html": root, "head": head, "body": body}[tag]
            for k, v in _attributes(m[3]).items():
                node.attrs.setdefault(k, v)
            if tag == "body" and not in_body:
                enter_body()
            continue
        if not in_body and len(stack) == 2 and tag not in HEAD_ONLY:
            enter_body()
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in BLOCK and tag != "summary":
            close({"p"}, SCOPE)
        if tag in TABLE_PARTS and open_["table"]:  # inline elements between a row and its cell hold nothing more
            k = nearest(TABLE_PARTS | {"table"})
            if stack[k].tag in ROWS:
                cut(k + 1)
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr", {})
            put(row, False)
            push(row)
        node = Node(tag, _attributes(m[3]) if m[3].strip() else {})
        foreign = bool(open_["svg"] or open_["math"])
        if tag == "form" and stack[-1].tag in ROWS:
            continue
        put(node, tag not in TABLE_PARTS and tag not in RAW)
        if closed and foreign:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            node.children.append(html.unescape(source[at : end.start() if end else len(source)]) if tag in ("title", "textarea") else source[at : end.start() if end else len(source)])
            at = end.end() if end else len(source)
        elif tag not in VOID and not (closed and tag in ("svg", "math", "path")):
            push(node)
    return root


def hidden(node: Node) -> bool:
    """Whether an element is not rendered, whatever style sheets say."""
    a = node.attrs
    style = a.get("style", "")
    return (
        node.tag in UNSEEN or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or (bool(style) and (bool((m := _DISPLAY.search(style)) and m[1].lower() == "none") or bool(_CLEAR.search(style))))
        or (node.tag == "dialog" and "open" not in a) or (node.tag == "input" and a.get("type", "").lower() not in ("submit", "button", "reset"))
    )


def _on_screen(query: str) -> bool:
    """Whether a media query list holds for a screen of SCREEN pixels. A feature other than its width does not."""
    for one in query.lower().split(","):
        kind, *features = re.split(r"\band\b", one)
        if "(" in kind:
            kind, features = "all", [kind, *features]
        widths = [_WIDTH.fullmatch(x.strip()) for x in features]
        if kind.replace("only", "").strip() in ("", "all", "screen") and all(widths):
            sizes = [(m[1], float(m[2]) * (1 if m[3] == "px" else 16)) for m in widths if re.fullmatch(r"\d+(\.\d*)?|\.\d+", m[2])]
            if len(sizes) == len(widths) and all(x <= SCREEN if k == "min" else x >= SCREEN for k, x in sizes):
                return True
    return False


class Styles:
    """Rules of style sheets on display and visibility whose selectors are one element's tag, classes and id. Rules inside a layer, a condition on features or a media query that holds for a screen count; those inside other rules, and selectors of several elements, are left out. Rules of one selector are one."""

    def __init__(self, sheets: list[str]):
        self.by_key: dict[str, dict] = {}  # by an id, a class or a tag that the selector needs, then by selector
        self.known: dict[tuple, list] = {}
        order = 0
        for sheet in sheets:
            text, at = re.sub(r"/\*.*?(?:\*/|\Z)", " ", sheet, flags=re.S), 0
            open_: list[list] = []  # for each open brace: whether rules count inside, selectors, pieces of the body
            for m in re.finditer("[{}]", text):
                piece, at = text[at : m.start()], m.end()
                if m[0] == "{":
                    said, _, header = piece.rpartition(";")
                    if open_:
                        open_[-1][2].append(said)
                    header, counts = header.strip(), not open_ or open_[-1][0]
                    if header.startswith("@"):
                        name, _, rest = header[1:].partition(" ") if "(" not in header.split(" ")[0] else header[1:].partition("(")
                        rest = f"({rest}" if "(" in header.split(" ")[0] else rest
                        counts &= name.lower() in ("layer", "supports") and not rest.strip().lower().startswith("not") or name.lower() == "media" and _on_screen(rest)
                        open_.append([counts, None, []])
                    else:
                        open_.append([False, header if counts else None, []])
                elif open_:
                    _, selectors, body = open_.pop()
                    if selectors is not None:
                        order += 1
                        self._add(selectors, ";".join([*body, piece]), order)

    def _add(self, selectors: str, body: str, order: int) -> None:
        said = [(m[1].lower() if (m := p.search(body)) else None) for p in (_DISPLAY, _VISIBILITY)]
        if _CLEAR.search(body):
            said[0] = "none"
        if not any(said):
            return
        for selector in selectors.split(","):
            if (selector := selector.strip()) and (m := _SIMPLE.fullmatch(selector)):
                tag, marks = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
                ids, classes = frozenset(x for x in marks if x[0] == "#"), frozenset(x[1:] for x in marks if x[0] == ".")
                keys = sorted(ids) or sorted(f".{c}" for c in classes) or [tag]
                key = min(keys, key=lambda k: len(self.by_key.get(k, ())))
                rule = self.by_key.setdefault(key, {}).setdefault((tag, ids, classes), [(), (), None, None])
                for k in (0, 1):
                    if said[k]:
                        rule[k], rule[2 + k] = (len(ids), len(classes), int(tag != "*"), order), said[k]

    def of(self, node: Node) -> list:
        """What the rules say of an element's display and visibility; None where they say nothing."""
        if not self.by_key:
            return [None, None]
        mine = (node.tag, node.attrs.get("id"), node.attrs.get("class", ""))
        if mine not in self.known:
            self.known[mine] = self._of(*mine)
        return self.known[mine]

    def _of(self, own_tag: str, own_id: str | None, own_classes: str) -> list:
        out, rank, own, ids = [None, None], [(), ()], set(own_classes.split()), {f"#{own_id}"}
        for key in (*ids, *(f".{c}" for c in own), own_tag, "*"):
            for (tag, needs, classes), rule in self.by_key.get(key, {}).items():
                if tag in ("*", own_tag) and needs <= ids and classes <= own:
                    for k in (0, 1):
                        if rule[k] > rank[k]:
                            out[k], rank[k] = rule[2 + k], rule[k]
        return out


def prune(root: Node, styles: Styles) -> None:
    """Takes out of a tree what is not visible."""

    def stays(node: Node) -> bool:
        return not hidden(node) and (styles.of(node)[0] != "none" or bool(_DISPLAY.search(node.attrs.get("style", ""))))

    if not stays(root):
        root.children = []
    rest = [(root, True)]
    while rest:
        node, seen = rest.pop()
        visibility = m[1].lower() if (m := _VISIBILITY.search(node.attrs.get("style", ""))) else styles.of(node)[1]
        seen = seen if visibility not in ("hidden", "collapse", "visible") else visibility == "visible"
        if not seen:
            node.attrs = {k: v for k, v in node.attrs.items() if k not in ("alt", "value", "label")}
        node.children = [x for x in node.children if (seen if isinstance(x, str) else stays(x))]
        rest += [(x, seen) for x in node.children if isinstance(x, Node)]


def _walked(step):
    """What a generator returns that yields further ones for their results: calls within calls, with a stack of its own."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


class _Lines:
    """Lines under way: words wait until it is known whether a space comes before them."""

    def __init__(self, level: int = 0):
        self.level = level  # of lists, quotations and tables around
        self.lines, self.now, self.space, self.gap, self.blocks = [], "", False, 0, 0

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *rest = text.split("\n")
            self._put(first, True)
            for line in rest:
                self.lines.append(self.now.rstrip())
                self.now = line
            return
        words = _SPACE.sub(" ", text)
        if words == " ":
            self.space = True
            return
        if words:
            self._put((" " if self.space and self.now else "") + (words.lstrip(" ") if not self.now or self.space else words).rstrip(" "), False)
            self.space = words.endswith(" ")

    def _put(self, text: str, keep: bool) -> None:
        if not (text if keep else text.strip()):
            return
        if not self.now and self.gap:
            if self.lines:
                self.lines += [""] * (self.gap - 1)
            self.gap = 0
            self.blocks += 1
        self.now += text

    def end(self, gap: int = 1) -> None:
        if self.now.strip():
            self.lines.append(self.now.rstrip())
        self.now, self.space = "", False
        self.gap = max(self.gap, gap)

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def _integer(text: str | None, other: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,6}\s*", text) else other


def _render(node: Node, out: _Lines, pre: bool):
    """Adds what a node holds; for _walked()."""
    for child in node.children:
        if isinstance(child, str):
            out.add(child, pre)
        elif hidden(child):
            continue
        elif child.tag == "br":
            if out.now.strip():
                out.end()
            elif out.lines and not out.gap:
                out.lines.append("")
            out.gap = 0 if out.gap == 1 else out.gap
        elif child.tag == "hr":
            out.end(2)
        elif child.tag == "img":
            out.add(child.attrs.get("alt", ""))
        elif child.tag == "input":
            out.add(f' {child.attrs.get("value", "")} ')
        elif child.tag in ("button", "textarea"):
            out.add(" ")
            yield _render(child, out, pre)
            out.add(" ")
        elif child.tag in ("svg", "math"):
            for k, part in enumerate(_foreign(child)):
                out.add(" " if k else "")
                yield _render(part, out, pre)
        elif child.tag in ("select", "optgroup", "option"):
            out.end()
            out.add(child.attrs.get("label", "") if child.tag != "select" else "")
            if child.tag != "option" or "label" not in child.attrs:
                out.end()
                yield _render(child, out, pre)
            out.end()
        elif child.tag == "q":
            out.add('"')
            yield _render(child, out, pre)
            out.add('"')
        elif child.tag in LISTS and out.level < LEVELS:
            _block((yield _list(child, out.level + 1)), out, 2 if node.tag != "li" else 1)
        elif child.tag == "table" and out.level < LEVELS:
            _block((yield _table(child, out.level + 1)), out, 2)
        elif child.tag == "blockquote" and out.level < LEVELS:
            _block("\n".join(f"> {x}".rstrip() for x in (yield _inside(child, False, out.level + 1)).split("\n")), out, 2)
        elif child.tag == "pre" and out.level < LEVELS:
            _block((yield _inside(child, True, out.level + 1)).strip("\n"), out, 2)
        elif child.tag in LISTS:
            for mark, item in _items(child):
                out.end()
                out.add(mark)
                yield _render(item, out, pre)
                out.end()
        elif child.tag in ("tr", "thead", "tbody", "tfoot", "caption"):
            out.end()
            yield _render(child, out, pre)
            out.end()
        elif child.tag in ("td", "th"):
            out.add(" ")
            yield _render(child, out, pre)
            out.add(" ")
        elif child.tag == "details" and "open" not in child.attrs:
            shown = Node("div", {})
            shown.children = [x for x in child.children if isinstance(x, Node) and x.tag == "summary"][:1]
            out.end()
            yield _render(shown, out, pre)
            out.end()
        elif child.tag in BLOCK:
            gap = 2 if child.tag in SPACED else 1
            out.end(gap)
            yield _render(child, out, pre)
            out.end(gap)
        else:
            yield _render(child, out, pre)


def _foreign(node: Node) -> list[Node]:
    """The parts of SVG or MathML that show text."""
    out, rest = [], [(x, node.tag) for x in reversed(node.children)]
    while rest:
        child, around = rest.pop()
        if isinstance(child, Node):
            if child.tag in ("text", "foreignobject") and not hidden(child):
                out.append(child)
            elif not hidden(child) and child.tag not in FOREIGN_UNSEEN:
                rest += [(x, child.tag) for x in reversed(child.children)]
        elif child.strip() and around != "svg":
            shown = Node("span", {})
            shown.children = [child]
            out.append(shown)
    return out


def _inside(node: Node, pre: bool, level: int):
    """The text of what a node holds; for _walked(), as _list and _table."""
    lines = _Lines(level)
    yield _render(node, lines, pre)
    if pre and lines.now:
        lines.lines.append(lines.now.rstrip())
        lines.now = ""
    return lines.text()


def _block(text: str, out: _Lines, gap: int) -> None:
    """A finished block, its lines as they are."""
    out.end(gap)
    if text:
        for line in text.split("\n"):
            if out.gap and line:
                if out.lines:
                    out.lines += [""] * (out.gap - 1)
                out.gap = 0
                out.blocks += 1
            out.lines.append(line)
        out.gap = gap


def _items(node: Node):
    """(mark, node) of what a list shows: its items; other elements and texts without a mark."""
    items = [x for x in node.children if isinstance(x, Node) and not hidden(x)]
    numbered, step = node.tag == "ol", -1 if "reversed" in node.attrs else 1
    number = _integer(node.attrs.get("start"), sum(x.tag == "li" for x in items) if step < 0 else 1)
    for item in node.children:
        if isinstance(item, Node) and hidden(item) or isinstance(item, str) and not item.strip():
            continue
        if isinstance(item, Node) and item.tag == "li":
            mark = "- "
            if numbered:
                number = _integer(item.attrs.get("value"), number)
                mark = f"{number}. "
                number += step
            yield mark, item
        else:
            holder = Node("div", {})
            holder.children = [item]
            yield "", holder


def _list(node: Node, level: int):
    out = []
    for mark, item in _items(node):
        inner = yield _inside(item, False, level)
        if mark or inner:
            first, *rest = inner.split("\n")
            loose = "  " if not mark and isinstance(item.children[0], Node) else ""
            out.append("\n".join([(mark + loose + first).rstrip(), *((" " * len(mark) + loose + x).rstrip() for x in rest)]))
    return "\n".join(out)


def _rows(node: Node):
    for child in node.children:
        if isinstance(child, Node) and not hidden(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def _loose(node: Node):
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                yield child
        elif not hidden(child):
            if child.tag in ("tr", "thead", "tbody", "tfoot"):
                yield from _loose(child)
            elif child.tag not in TABLE_PARTS or (child.tag == "caption" and node.tag != "table"):
                yield child


def _table(node: Node, level: int):
    head = []
    for x in node.children:
        if isinstance(x, Node) and x.tag == "caption" and not hidden(x):
            head.append((yield _inside(x, False, level)))
    loose = Node("div", {})  # what is in a table but in no cell stands before it
    loose.children = list(_loose(node))
    if loose.children:
        head.append((yield _inside(loose, False, level)))
    grid, busy = [], []  # busy: (first column, end, row before which it is free again), in order, of cells from above
    for nr, row in enumerate(_rows(node)):
        cells, at, k, taken = [], 0, 0, []
        for c in row.children:
            if not isinstance(c, Node) or c.tag not in ("td", "th") or hidden(c):
                continue
            while k < len(busy) and busy[k][0] <= at:
                at = max(at, busy[k][1])
                k += 1
            across, down = min(1000, max(1, _integer(c.attrs.get("colspan"), 1))), _integer(c.attrs.get("rowspan"), 1)
            cells.append((at, at + across, (yield _inside(c, False, level)).split("\n")))
            if down != 1:
                until = nr + (down if down > 1 else 65534)
                if taken and taken[-1][1] == at and taken[-1][2] == until:
                    taken[-1] = (taken[-1][0], at + across, until)
                else:
                    taken.append((at, at + across, until))
            at += across
        grid.append(cells)
        busy = sorted(x for x in [*busy, *taken] if x[2] > nr + 1) if taken or any(x[2] == nr + 1 for x in busy) else busy
    # Columns between places where a cell begins or ends; a space of two behind those where one ends.
    edges = sorted({x for row in grid for begin, end, _ in row for x in (begin, end)})
    column, ends = {x: i for i, x in enumerate(edges)}, {end for row in grid for _, end, _ in row}
    gutter = [2 if x in ends else 0 for x in edges[1:]]
    width = [0] * len(gutter)
    for begin, end, lines in sorted((x for row in grid for x in row), key=lambda x: x[1] - x[0]):
        i, j = column[begin], column[end]
        room = sum(width[i:j]) + sum(gutter[i : j - 1])
        if (most := max((n for n in map(len, lines) if n <= WIDE), default=0)) > room:
            width[j - 1] += most - room
    left = [0]  # where each column begins
    for w, g in zip(width, gutter):
        left.append(left[-1] + w + g)
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for begin, _, lines in row:
                if k < len(lines) and lines[k]:
                    line = (f"{line}  " if line else "").ljust(left[column[begin]]) + lines[k]
            out.append(line.rstrip())
    return "\n".join([*(h for h in head if h), *out])


def _sheets(root: Node) -> list[str]:
    out, rest = [], [root]
    while rest:
        node = rest.pop()
        if node.tag == "style":
            out += [x for x in node.children if isinstance(x, str)]
        rest += [x for x in reversed(node.children) if isinstance(x, Node)]
    return out


def render(source: str | None) -> tuple[str, str, int]:
    """Title, visible text, and number of blocks of a page."""
    if not source:
        return "", "", 0
    root = parse(source)
    titles = [_SPACE.sub(" ", x.children[0]).strip() for part in root.children for x in part.children if isinstance(x, Node) and x.tag == "title" and x.children]
    lines, body, styles = _Lines(), root.children[1], Styles(_sheets(root))
    root.children = [body]
    lines.gap = 1
    prune(root, styles)
    if root.children:
        _walked(_render(body, lines, False))
    text = lines.text()
    return (titles or [""])[0], text, lines.blocks


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of pages: id, title, text, n_blocks."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                done = [render(x) for x in part.column("html").to_pylist()]
                yield pa.record_batch([part.column("id"), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int32())], ["id", "title", "text", "n_blocks"])

    slim = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, TEXTS).withColumnRenamed("id", id_col)
