"""Visible text of HTML pages, laid out as a page would be: blocks, lists, preformatted text and aligned tables."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split())
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
HIDDEN = frozenset("area base datalist head link meta noembed noframes noscript param rp script style template title audio canvas iframe object video".split())
# A start tag closes the open elements on the right, up to the nearest of the last set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "thead", "tbody", "tfoot"}),
    "thead": ({"tr", "td", "th", "caption", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "caption", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "caption", "thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = frozenset("html body table td th caption button object template".split())
MAX_DEPTH = 256
_SPACE = re.compile(r"[ \t\n\r\f]+")
# What may stand in head, and directly in a table and its parts; anything else ends head or is laid out before the table.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
IN_TABLE = frozenset("caption colgroup col thead tbody tfoot tr td th style script template".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr colgroup".split())
_DECLARED = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SIMPLE = re.compile(r"^([a-z][a-z0-9]*)?([.#][\w-]+)?$", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds the element tree: void elements, implied end tags, stray end tags ignored, bounded depth."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open, self.styles, self.begun, self.body = [self.root], [], False, False

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        """In HTML a marked section is a comment up to the next >."""
        return self.parse_bogus_comment(i, report)

    def close(self) -> None:
        if self.rawdata.startswith(("<!", "<?")):
            self.rawdata = ""  # a comment without an end takes the rest
        super().close()

    def _close(self, tags: set, stop) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return self._close(tags, stop)
            if self.open[i].tag in stop:
                return None
        return None

    def _back_to(self, tags: set | frozenset) -> bool:
        """Closes what is open above the nearest of the tags, unless a cell or the end of the tree comes first."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i + 1 :]
                return True
            if self.open[i].tag in ("td", "th", "caption"):
                return False
        return False

    def _place(self, child) -> None:
        """Adds to the innermost open element; what a table can't hold goes before the table."""
        if self.open[-1].tag in TABLE_PARTS:
            at = max((i for i, x in enumerate(self.open) if x.tag == "table"), default=0)
            if at:
                outer = next(x for x in reversed(self.open[:at]) if x.tag not in TABLE_PARTS)
                where = next((k for k in range(len(outer.children) - 1, -1, -1) if outer.children[k] is self.open[at]), len(outer.children))
                outer.children.insert(where, child)
                return
        self.open[-1].children.append(child)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        # a page has one head, before all else, and one body
        if tag == "html" or (tag == "head" and (len(self.open) > 1 or self.begun)) or (tag == "body" and self.body):
            return
        self.begun, self.body = True, self.body or tag == "body"
        if tag not in IN_HEAD and self.open[-1].tag == "head":
            self.open.pop()
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        elif tag in BLOCK:
            self._close({"p"}, SCOPE)
        if tag == "table" and self.open[-1].tag in TABLE_PARTS and self._back_to({"table"}):
            self.open.pop()  # a table ends the one that it stands in directly
        if tag in ("tr", "thead", "tbody", "tfoot", "caption", "colgroup"):
            self._back_to({"table", "thead", "tbody", "tfoot"} if tag == "tr" else {"table"})
        elif tag in ("td", "th") and self._back_to({"table", "thead", "tbody", "tfoot", "tr"}) and self.open[-1].tag != "tr":
            row = Node("tr", {})
            self.open[-1].children.append(row)
            self.open.append(row)
        inside = self.open[-1].tag in TABLE_PARTS
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        if inside and tag == "form":
            return  # a form in a table holds nothing
        if inside and tag in IN_TABLE:
            self.open[-1].children.append(node)
        else:
            self._place(node)
        if tag not in VOID and len(self.open) < MAX_DEPTH:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._place(Node("br", {}))
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body"):
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "style":
            self.styles.append(data)
        blank = not data.strip(" \t\n\r\f")
        if self.open[-1].tag == "head" and not blank:
            self.open.pop()
        self.begun |= not blank
        if blank:
            self.open[-1].children.append(data)
        else:
            self._place(data)


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """display and visibility of a block of declarations, as (important, hides); of one weight the later one holds."""
    out: dict[str, tuple[bool, bool]] = {}
    for name, value, important in _DECLARED.findall(body):
        name, value = name.lower(), value.lower()
        if name not in out or bool(important) >= out[name][0]:
            out[name] = (bool(important), value == "none" if name == "display" else value in ("hidden", "collapse"))
    return out


def _on_screen(at_rule: str) -> bool:
    """Whether the rules within an at-rule hold for any screen: plain media lists that name it, layers and feature queries."""
    name, _, rest = at_rule[1:].partition(" ")
    if name.lower() in ("layer", "supports"):
        return True
    media = [" ".join(m.split()).lower() for m in rest.split(",")]
    return name.lower() == "media" and any(m in ("screen", "all", "only screen", "not print", "not speech") for m in media)


def _rules(sheet: str):
    """(selectors, body) of the rules that hold for screens, in order; braces nest to any depth."""
    frames, off, at = [], 0, 0  # open at-rules, how many of them don't hold, where the next prelude begins
    names, begun, depth = None, 0, 0  # the rule whose body is open
    for m in re.finditer("[{}]", sheet):
        if names is not None:
            depth += 1 if m[0] == "{" else -1
            if not depth:
                if not off:
                    yield names, sheet[begun : m.start()]
                names, at = None, m.end()
            continue
        if m[0] == "}":
            off -= bool(frames and not frames.pop())
        else:
            prelude = sheet[at : m.start()].rsplit(";", 1)[-1].strip()
            if prelude.startswith("@"):
                frames.append(_on_screen(prelude))
                off += not frames[-1]
            else:
                names, begun, depth = prelude, m.end(), 1
        at = m.end()
    if names is not None and not off:
        yield names, sheet[begun:]


def style_rules(styles: list[str]) -> dict[str, dict[str, tuple]]:
    """Simple selectors (tag, .class, #id, tag.class, tag#id) with (important, weight, order, hides) of display and visibility."""
    out: dict[str, dict[str, tuple]] = {}
    for n, (names, body) in enumerate(r for sheet in styles for r in _rules(_COMMENT.sub(" ", sheet))):
        found = _declared(body)
        for name in (x.strip() for x in names.split(",")) if found else ():
            m = _SIMPLE.match(name)
            if name and m:
                key = (m[1] or "").lower() + (m[2] or "")
                weight = (100 if "#" in key else 10 if "." in key else 0) + bool(m[1])
                held = out.setdefault(key, {})
                for prop, (important, hides) in found.items():
                    held[prop] = max(held.get(prop, (False, -1, -1, False)), (important, weight, n, hides))
    return out


def _hides(node: Node, rules: dict[str, dict[str, tuple]]) -> tuple[bool, bool | None]:
    """Whether an element isn't displayed, and whether it is hidden: null where it says nothing, so that its parent's visibility holds."""
    a = node.attrs
    if node.tag in HIDDEN or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return True, None
    closed = node.tag == "dialog" and "open" not in a
    state = {"display": (False, -1, -1, "hidden" in a or closed), "visibility": (False, -1, -1, None)}
    if rules:
        names = [node.tag]
        for c in a.get("class", "").split():
            names += [f".{c}", f"{node.tag}.{c}"]
        if a.get("id"):
            names += [f"#{a['id']}", f"{node.tag}#{a['id']}"]
        for name in names:
            for prop, rule in rules.get(name, {}).items():
                if rule[:3] >= state[prop][:3]:
                    state[prop] = rule
    if "style" in a:
        for prop, (important, hides) in _declared(a["style"]).items():
            if (important, 1000, 0) >= state[prop][:3]:
                state[prop] = (important, 1000, 0, hides)
    return state["display"][3], state["visibility"][3]


def prune(node: Node, rules: dict[str, dict[str, tuple]], hidden: bool = False) -> bool:
    """Takes away what isn't shown below an element; False if nothing is left of it. Of a closed details only the first summary is shown,
    and something visible within something hidden stays."""
    gone, own = _hides(node, rules)
    if gone:
        return False
    hidden = hidden if own is None else own
    children = node.children
    if node.tag == "details" and "open" not in node.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    node.children = [c for c in children if (not hidden if isinstance(c, str) else prune(c, rules, hidden))]
    return not hidden or any(isinstance(c, Node) for c in node.children)


def _width(text: str) -> int:
    """Columns that a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _whole(text: str) -> int | None:
    m = re.match(r"\s*([+-]?[0-9]{1,9})(?![0-9])", text)
    return int(m[1]) if m else None


class Page:
    """Lines of text as they build up: spaces fold, blocks begin lines, margins are one blank line at most."""

    def __init__(self):
        self.lines, self.line, self.space, self.margin = [], "", False, False

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.expandtabs(8).split("\n")
            self._add(first)
            for part in rest:
                self._end(force=True)
                self._add(part)
            return
        folded = _SPACE.sub(" ", data)
        if folded.startswith(" "):
            self.space, folded = True, folded[1:]
        tail = folded.endswith(" ")
        if folded := folded[: -1 if tail else None]:
            self._add((" " if self.space and self.line else "") + folded)
        self.space = tail or (self.space and not folded)

    def _add(self, part: str) -> None:
        if part:
            if self.margin and self.lines and not self.line:
                self.lines.append("")
            self.line, self.margin, self.space = self.line + part, False, False

    def _end(self, force: bool = False) -> None:
        if self.line or force:
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False

    def block(self, margin: bool) -> None:
        self._end()
        self.margin |= margin

    def br(self) -> None:
        self._end(force=True)

    def done(self) -> list[str]:
        self._end()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def _indented(lines: list[str], first: str, rest: str) -> list[str]:
    return [(first if i == 0 else rest) + x if x else x for i, x in enumerate(lines)] or [first.rstrip()]


def _put(page: Page, lines: list[str], margin: bool) -> None:
    page.block(margin)
    for x in lines:
        if page.margin and page.lines:
            page.lines.append("")
        page.margin = False
        page.lines.append(x.rstrip())
    page.block(margin)


def _span(cell: Node, name: str, most: int) -> int:
    m = re.match(r"\s*(\d{1,9})", cell.attrs.get(name, ""))
    return min(int(m[1]), most) if m else 1


def _table(node: Node) -> list[str]:
    """Rows of cells, each column as wide as its widest cell; lines of a cell stay in its column."""
    caption, rows = [], []
    todo = list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            continue
        if x.tag in ("thead", "tbody", "tfoot"):
            todo.extend(reversed(x.children))
        elif x.tag == "tr":
            rows.append([c for c in x.children if isinstance(c, Node) and c.tag in ("td", "th")])
        elif x.tag == "caption":
            caption += lay_out(x.children)
    grid: dict[tuple[int, int], list[str]] = {}
    until: dict[int, int] = {}  # by column, the first row that no cell above reaches
    for r, cells in enumerate(rows):
        c = 0
        for cell in cells:
            while until.get(c, 0) > r:
                c += 1
            # the HTML standard's bounds; no rowspan (0): all rows that are left
            wide, high = _span(cell, "colspan", 1000) or 1, _span(cell, "rowspan", 65534) or len(rows) - r
            for k in range(c, c + wide):
                until[k] = max(until.get(k, 0), r + high)
            grid[r, c] = lay_out(cell.children)
            c += wide
    width: dict[int, int] = {}
    for (_, c), lines in grid.items():
        width[c] = max(width.get(c, 0), max(map(_width, lines), default=0))
    columns = sorted(c for c, w in width.items() if w)
    out = caption
    for r in range(len(rows)):
        cells = [grid.get((r, c), []) for c in columns]
        for i in range(max(map(len, cells), default=0)):
            line = [x[i] if i < len(x) else "" for x in cells]
            out.append("  ".join(x + " " * (width[c] - _width(x)) for x, c in zip(line, columns, strict=True)).rstrip())
    return out


def lay_out(children: list, keep: bool = False) -> list[str]:
    """The lines that the given nodes make."""
    page, todo = Page(), [(c, keep, None) for c in reversed(children)]
    while todo:
        node, keep, after = todo.pop()
        if after is not None:
            page.block(after)
        elif isinstance(node, str):
            page.text(node, keep)
        elif node.tag == "br":
            page.br()
        elif node.tag == "table":
            _put(page, _table(node), True)
        elif node.tag in ("ul", "ol", "menu", "dir"):
            start, lines, down = _whole(node.attrs.get("start", "")), [], "reversed" in node.attrs
            number = start if start is not None else sum(isinstance(x, Node) and x.tag == "li" for x in node.children) if down else 1
            for item in node.children:
                if isinstance(item, Node):
                    value = _whole(item.attrs.get("value", ""))
                    number = value if value is not None and item.tag == "li" else number
                    mark = f"{number}. " if node.tag == "ol" else "- "
                    if item.tag != "li":
                        lines += _indented(lay_out([item], keep), "  ", "  ")
                    else:
                        lines += _indented(lay_out(item.children, keep), mark, " " * len(mark))
                        number += -1 if down else 1
                elif isinstance(item, str) and item.strip():
                    lines += _indented(lay_out([item]), "  ", "  ")
            _put(page, lines, True)
        elif node.tag == "blockquote":
            _put(page, ["  " + x if x else x for x in lay_out(node.children, keep)], True)
        elif node.tag == "hr":
            _put(page, ["---"], False)
        else:
            if node.tag in BLOCK:
                page.block(node.tag in SPACED)
                todo.append((node, keep, node.tag in SPACED))
            todo.extend((c, keep or node.tag in ("pre", "textarea"), None) for c in reversed(node.children))
    return page.done()


def render(html: str | None) -> str:
    """Visible text of a page; empty for null."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    prune(builder.root, style_rules(builder.styles))
    return "\n".join(lay_out(builder.root.children))


def _render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[["id", "id_none"]].assign(text=[render(h) for h in batch["html"]])


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: id, text (all visible text, laid out), n_chars, n_lines.

    Null or empty pages: empty text, 0 characters, 0 lines. Text without tags is text. Elements nested deeper
    than 256 hang on the last one within. Text and elements that a table can't hold stand before it. Of style sheets the
    rules for any screen count: those within print or conditional media don't. Visibility is inherited, closed dialogs and details aren't shown
    (but for the summary), an unclosed comment takes the rest, marked sections are comments. Repeated rows and null ids keep their rows. Empty input: no rows.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    text = ids_from_python(ids_for_python(rows).mapInPandas(lean(_render), f"id {kind}, id_none boolean, text string"))
    lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0)
    return text.select(F.col("id").alias(id_col), "text", F.length("text").cast("long").alias("n_chars"), lines.cast("long").alias("n_lines"))
