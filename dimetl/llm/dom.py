"""A small HTML tree builder for extraction: tags, labels and text, no layout."""

from __future__ import annotations

import html as _html
import re

#: A tag's attributes may hold quoted ``>``; quotes are not followed past a ``<``, so broken ones cost no second scan.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*(?:>|\Z))""", re.S
)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ODD = re.compile(r"[^a-z0-9:_-]")
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:[\s=>]|\Z)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody tfoot thead tr ul".split()
)
_CELLS = frozenset(("td", "th"))
#: An open element that a start tag of the key closes, and the elements beyond which it does not look.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
#: Elements beyond which a block does not look for an open paragraph to close.
_P_SCOPE = frozenset("table td th caption html body article section div li main aside button object".split())
#: Elements nested deeper stay in the tree as siblings at this depth.
MAX_NEST = 256


class Node:
    """Element: ``label`` is the tag with its class, id and role words, ``names`` are these attributes' whole tokens, ``classes`` those of the class; children are nodes and strings."""

    __slots__ = ("tag", "names", "classes", "label", "children", "hidden")

    def __init__(self, tag: str, words: tuple[str, ...] = (), hidden: bool = False, names: tuple[str, ...] = (), classes: tuple[str, ...] = ()):
        self.tag, self.names, self.classes, self.hidden = tag, names, classes, hidden
        self.label = tag if not words else f"{tag}.{'.'.join(words)}"
        self.children: list = []


def _words(attributes: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """Lower-case words of class, id and role, without the digits that number things, the attributes' whole tokens, and those of the class."""
    found, names, classes = set(), [], []
    for m in _CLASS.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        found.update(re.findall(r"[a-z]+", value))
        names += value.split()
        if m[1].lower() == "class":
            classes += value.split()
    return tuple(sorted(found)), tuple(names), tuple(classes)


def parse(text: str) -> Node:
    """Tree of a page; any text gives a tree, however broken its markup."""
    root = Node("#root")
    stack = [root]
    at = 0
    while True:
        m = _TOKEN.search(text, at)
        end = m.start() if m else len(text)
        if end > at:
            stack[-1].children.append(_html.unescape(text[at:end]))
        if not m:
            return root
        at = m.end()
        if not m[2]:
            continue
        tag = _ODD.sub("_", m[2].lower())
        if m[1]:
            _close(stack, tag)
            continue
        if tag in BLOCK:
            _close_open(stack, ("p",), _P_SCOPE)
        if tag in _CLOSES:
            _close_open(stack, *_CLOSES[tag])
        attributes = m[3]
        plain = len(attributes) < 4
        words, names, classes = ((), (), ()) if plain else _words(attributes)
        node = Node(tag, words, not plain and _HIDDEN.search(attributes) is not None, names, classes)
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(text, at)
            if not stop:
                return root
            at = text.find(">", stop.end() - 1) + 1 or len(text)
        elif tag not in VOID and not attributes.endswith("/>") and len(stack) < MAX_NEST:
            stack.append(node)


def _close_open(stack: list[Node], tags: tuple[str, ...], scope) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in scope:
            return


def _close(stack: list[Node], tag: str) -> None:
    """An end tag closes its element; inline ones do not reach out of a block, unmatched ones do nothing."""
    inline = tag not in BLOCK and tag not in _CELLS
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if inline and (stack[i].tag in BLOCK or stack[i].tag in _CELLS):
            return
        if stack[i].tag == "table" and tag not in ("html", "body", "article", "main", "section", "div"):
            return
