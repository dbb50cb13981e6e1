"""Text of web pages as it would be laid out: a tree with implied tags, then its rendering."""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed facts of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template noscript title iframe object audio video canvas "
             "datalist".split())
FOREIGN = {"svg", "math"}
UNDRAWN = {"defs", "desc", "metadata", "symbol", "annotation", "annotation-xml"}  # in these two
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset "
            "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
            "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption"
            .split())
SPACED = set("p blockquote h1 h2 h3 h4 h5 h6 ul ol menu dl pre table figure".split())
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "caption", "legend"}
# An opening tag ends these open tags, up to the nearest of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "caption"}, {"table"}),
    "thead": ({"tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
    "body": ({"head"}, {"html"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
}
SCOPES = {"table", "td", "th", "caption", "button", "html"}
BLANKS = re.compile(r"[ \t\n\r\f]+")
UNSEEN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))"
                    r"\s*(?:!important\s*)?(?:;|$)")
GAP = "  "
MOST_COLUMNS = 1000     # that a cell may span: fixed by HTML


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def hidden(self) -> bool:
        return (self.tag in HIDDEN or "hidden" in self.attrs
                or bool(UNSEEN.search(self.attrs.get("style") or "")))


class TreeBuilder(HTMLParser):
    """A tree from any input: unclosed, misnested and missing tags are repaired."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def _end(self, tags: set[str], limits: set[str]) -> None:
        """Close the outermost open tag among ``tags`` that is inside the nearest limit."""
        cut = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in limits:
                break
            if self.open[i].tag in tags:
                cut = i
        if cut is not None:
            del self.open[cut:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in ENDS_P:
            self._end({"p"}, SCOPES)
        if tag not in ("meta", "link", "title", "script", "style", "base", "noscript", "template"):
            self._end({"head"}, set())
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr", {}))
        node = Node(tag, dict(attrs))
        if tag in UNDRAWN and self._foreign():
            node.attrs["hidden"] = ""
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML itself
        if tag not in VOID and self.open[-1].tag == tag and self._foreign():
            del self.open[-1]

    def _foreign(self) -> bool:
        return any(n.tag in FOREIGN for n in reversed(self.open))

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("table", "td", "th") and tag not in (
                    "table", "tr", "tbody", "thead", "tfoot", "body"):
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Character data in drawings and formulas; elsewhere such a section is a comment."""
        end = self.rawdata.find("]]>", i)
        if self.rawdata.startswith("<![CDATA[", i) and end >= 0 and self._foreign():
            self.handle_data(self.rawdata[i + 9:end])
            return end + 3
        return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self._end({"head"}, set())
        self.open[-1].children.append(data)


class Layout:
    """Lines of text; blanks collapse outside of pre, blocks stand on lines of their own."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.space, self.gap, self.marker = "", False, False, ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._add(first)
            for more in rest:
                self.feed(True)
                self._add(more)
            return
        for i, word in enumerate(BLANKS.split(data)):
            self.space = self.space or i > 0
            if word:
                self._add((" " if self.space and self.line else "") + word)
                self.space = False

    def _add(self, text: str) -> None:
        if text:
            if self.gap and self.lines and not self.line:
                self.lines.append("")
            if not self.line:
                text = self.marker + text
                self.marker = " " * len(self.marker) if self.marker.strip() else self.marker
            self.gap = False
            self.line += text

    def feed(self, always: bool = False) -> None:
        if self.line or always:
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False

    def result(self) -> list[str]:
        self.feed()
        return self.lines


NUMBER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]+)")


def number_in(value: str | None, default: int) -> int:
    """The whole number that an attribute begins with; one of many digits counts as none."""
    found = NUMBER.match(value or "")
    return int(found[1]) if found and len(found[1]) < 10 else default


def lines_of(top: Node) -> list[str]:
    """Lines of all visible text below ``top``.

    Tables, lists and their parts are generators that ask for the lines of what they contain by
    yielding its generator. They wait on a stack here, so that no nesting is too deep.
    """
    waiting, lines = [render(top)], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(lines))
            lines = None
        except StopIteration as done:
            waiting.pop()
            lines = done.value
    return lines


def render(top: Node) -> Generator:
    """Lines of all visible text below ``top``; tables and lists start a layout of their own."""
    out = Layout()
    todo: list[tuple] = [("open", c, False) for c in reversed(top.children)]
    while todo:
        step, node, pre = todo.pop()
        if step == "close":
            out.feed()
            out.gap = out.gap or node in SPACED
        elif isinstance(node, str):
            out.text(node, pre)
        elif node.hidden():
            continue
        elif node.tag == "br":
            out.feed(True)
        elif node.tag == "hr":
            out.feed()
            out.text("-" * 8, True)
            out.feed()
        elif node.tag == "img":
            if node.attrs.get("alt"):
                out.text(node.attrs["alt"], False)
        elif node.tag in ("table", "ul", "ol", "menu"):
            lines = yield table_lines(node) if node.tag == "table" else list_lines(node)
            out.feed()
            nested = top.tag == "li"
            out.gap = (out.gap or node.tag == "table" or not nested) and bool(out.lines)
            for line in lines:
                out._add(line)
                out.feed(True)
            out.gap = not nested
        else:
            block = node.tag in BLOCK or node.tag in ("option", "optgroup")
            if block:
                out.feed()
                out.gap = out.gap or node.tag in SPACED
                todo.append(("close", node.tag, pre))
            elif node.tag == "q":
                todo.append(("text", '"', True))
                out.text(("" if not out.space else " ") + '"', True)
            inner = pre or node.tag == "pre"
            todo += [("open", c, inner) for c in reversed(node.children)]
    return out.result()


def list_lines(node: Node) -> Generator:
    lines, number = [], number_in(node.attrs.get("start"), 1)
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                lines.append(BLANKS.sub(" ", child).strip())
        elif not child.hidden():
            if child.tag != "li":
                box = Node("div", {})
                box.children = [child]
                lines += yield render(box)
                continue
            number = number_in(child.attrs.get("value"), number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            for i, line in enumerate((yield render(child)) or [""]):
                lines.append(((mark if i == 0 else " " * len(mark)) + line).rstrip())
    return lines


def table_lines(node: Node) -> Generator:
    """Rows with cells aligned in columns; a cell may span columns and rows and hold several lines."""
    captions, rows, todo = [], [], list(reversed(node.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str) or child.hidden():
            if isinstance(child, str) and child.strip():
                captions.append(BLANKS.sub(" ", child).strip())
        elif child.tag == "tr":
            captions += [BLANKS.sub(" ", c).strip() for c in child.children
                         if isinstance(c, str) and c.strip()]  # shown before the table
            rows.append([c for c in child.children if isinstance(c, Node) and not c.hidden()])
        elif child.tag in ("tbody", "thead", "tfoot", "colgroup"):
            todo += reversed(child.children)
        else:
            box = Node("div", {})
            box.children = [child]
            captions += yield render(box)
    grid, widths, taken = [], [], {}
    for cells in rows:
        line, at, below = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in cells:
            box = cell
            if cell.tag not in ("td", "th"):
                box = Node("td", {})
                box.children = [cell]
            while at in taken:      # by a cell of a row above
                at += 1
            span = min(max(number_in(cell.attrs.get("colspan"), 1), 1), MOST_COLUMNS)
            down = number_in(cell.attrs.get("rowspan"), 1)
            down = min(down if down > 0 else len(rows), len(rows) - len(grid))
            text = yield render(box)
            line.append((at, span, text))
            below.update({c: down - 1 for c in range(at, at + span) if down > 1})
            if span == 1:
                widths += [0] * (at + 1 - len(widths))
                widths[at] = max([widths[at], *map(len, text)])
            at += span
        grid.append(line)
        taken = below
    for line in grid:  # a spanning cell widens the last of its columns
        for at, span, text in line:
            widths += [0] * (at + span - len(widths))
            have = sum(widths[at:at + span]) + len(GAP) * (span - 1)
            widths[at + span - 1] += max(0, max(map(len, text), default=0) - have)
    lines = list(captions)
    for line in grid:
        for k in range(max((len(t) for _, _, t in line), default=0)):
            shown, upto = "", 0
            for at, span, text in line:
                shown += "".join(" " * w + GAP for w in widths[upto:at])
                upto = at + span
                width = sum(widths[at:at + span]) + len(GAP) * (span - 1)
                shown += (text[k] if k < len(text) else "").ljust(width) + GAP
            lines.append(shown.rstrip())
    return lines


def page_text(html: str | None) -> str:
    """All visible text of a page; blank lines between paragraphs, none in a row."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines_of(builder.root))).strip("\n")


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"key": batch["key"], "text": [page_text(h) for h in batch["html"]]})


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text) per row.

    A null or empty page has an empty text; broken markup is repaired and never fails, however
    deep it is nested; pages of any length are laid out whole. Repeated rows and null keys are rows
    like all others, and rows never meet. An empty table gives an empty result.
    """
    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInPandas(
        _extract, f"key {kind}, text string").withColumnRenamed("key", key)
