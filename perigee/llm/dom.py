"""A forgiving page parser: elements with their place, attributes and texts, in page order."""

from __future__ import annotations

import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup of the page: code, names of pages, and what browsers with scripts don't show.
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td tfoot th thead tr ul button".split())
#: Raw elements that, without an end, hold the rest of the page.
CODE = frozenset("script style".split())
#: The implied block of a run of text that stands in no block element, and all elements that are judged as blocks.
RUN = "#run"
SCORED = BLOCK - {"html", "body", "hr"} | {RUN}
#: Elements whose start ends an open paragraph, and elements whose start ends an open one of the listed kinds.
ENDS_P = BLOCK - {"body", "html", "option", "button", "caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr", "select"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
#: Elements an implied end doesn't reach across.
WALLS = frozenset("table td th ul ol dl button caption html body article section div aside nav main form fieldset".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Page:
    """Elements as parallel lists (0 is the page itself) and texts as (element, block number, text).

    A run of text in no block element but body or html gets an implied element RUN, after all others, whose parent is
    the element of its first word; within has the element each text was written in.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.attributes = ["#page"], [-1], [""]
        self.texts: list[tuple[int, int, str]] = []
        self.block = 0
        stack = [0]
        self._where: dict[str, list[int]] = {}  # depths of the open elements of each name
        unclosed: set[str] = set()  # raw elements without a further end
        at = 0
        while True:
            m = _TAG.search(source, at)
            end = m.start() if m else len(source)
            if end > at:
                self._text(stack[-1], source[at:end])
            if not m:
                break
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                if name == "br":
                    self._text(stack[-1], " ")
                elif self._where.get(name):
                    self._shut(stack, self._where[name][-1])
                    self._edge(name)
                continue
            self._start(stack, name, m[3])
            if name in RAW and not m[3].rstrip().endswith("/"):
                close = None if name in unclosed else re.compile(f"</{name}(?=[\\s/>])", re.I).search(source, at)
                self._shut(stack, len(stack) - 1)
                if not close:
                    if name in CODE:
                        break
                    unclosed.add(name)  # only the tag is left out
                    continue
                shut = source.find(">", close.start())
                at = len(source) if shut < 0 else shut + 1
        self.within = [element for element, _, _ in self.texts]
        self._imply_runs()

    def _imply_runs(self) -> None:
        inside = [False] * len(self.tag)
        for i in range(1, len(inside)):
            inside[i] = inside[self.parent[i]] or self.tag[i] in SCORED
        runs: dict[int, int] = {}
        for element, block, text in self.texts:
            if not inside[element] and block not in runs and text.strip():
                runs[block] = len(self.tag)
                self.tag.append(RUN)
                self.parent.append(element)
                self.attributes.append(self.attributes[element])
        if runs:
            self.texts = [(e if inside[e] else runs.get(block, e), block, text) for e, block, text in self.texts]

    def _shut(self, stack: list[int], depth: int) -> None:
        """Ends the open elements from this depth on; each element is ended once, so all ends cost as much as all starts."""
        while len(stack) > depth:
            self._where[self.tag[stack.pop()]].pop()

    def _depth(self, names: set[str] | frozenset[str]) -> int:
        """Depth of the innermost open element of these names, 0 for none."""
        return max((self._where[n][-1] for n in names if self._where.get(n)), default=0)

    def _edge(self, name: str) -> None:
        if name in BLOCK:
            self.block += 1

    def _text(self, element: int, text: str) -> None:
        self.texts.append((element, self.block, html.unescape(text) if "&" in text else text))

    def _start(self, stack: list[int], name: str, attributes: str) -> None:
        if name in ENDS_P:
            self._imply(stack, {"p"}, WALLS)
        if name in ENDS:
            self._imply(stack, ENDS[name], WALLS - ENDS[name])
        self._edge(name)
        if name == "br":
            self._text(stack[-1], " ")
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.attributes.append(attributes)
        if name not in VOID and not (attributes.rstrip().endswith("/") and name not in BLOCK):
            self._where.setdefault(name, []).append(len(stack))
            stack.append(len(self.tag) - 1)

    def _imply(self, stack: list[int], ended: set[str] | frozenset[str], walls: frozenset[str] | set[str]) -> None:
        """Ends the open elements of these kinds on this side of a wall, of paragraphs the innermost."""
        wall = self._depth(walls - ended)
        while (depth := self._depth(ended)) > wall:
            self._shut(stack, depth)
            self.block += 1
            if ended == {"p"}:
                return

    def named(self, element: int) -> dict[str, str]:
        return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(self.attributes[element])}


def joined(page: Page, keep) -> str:
    """Texts of the elements for which keep holds: white space inside a block is one blank, blocks are two line ends apart."""
    blocks: dict[int, list[str]] = {}
    for element, block, text in page.texts:
        if keep[element]:
            blocks.setdefault(block, []).append(text)
    done = (" ".join("".join(x).split()) for _, x in sorted(blocks.items()))
    return "\n\n".join(x for x in done if x)
