"""Main text of web pages by wrapper induction.

Pages of one host are built from one template.  Every page's tree is reduced
to its shape: element labels, equal siblings as one node, and for each block
the signatures of its runs of text.  Shapes of a host are aligned by simple
tree matching (the order-preserving matching of children with the most matched
nodes) and merged to the host's template, whose nodes count their pages and the
pages of each text, so that a text is known to be the same on most of them
(constant) or not (varying), also beside varying texts of equal siblings.  All
pages take part: every task merges the pages it reads, and the tasks'
templates, not the pages, are shuffled and merged, a hot host in salted parts
first.

From the template a wrapper is read: constant texts belong to the template,
and the lowest container of all varying texts is the content, so that outside
it there is only template and noise.  A page is aligned with its host's wrapper
again, and its blocks without the template's and the noise are its text.
Zones that are never the article (menus, forms, adverts, comments, ...) are
told by element and by name, since their text may vary as well; a name counts
only for a block that the host's template has on a share of its pages, and a
compound class only if the block holds the lesser part of the host's text.
Whatever their names, blocks of the template that stand beside the container of
most of the host's text and hold little but links are lists of other pages.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import OWN, materialise
from dimetl.llm.dom import BLOCK, RAW, Node, parse

#: Share of a host's pages that must have a text in the same place for it to be template.
TEXT_SHARE = 0.5
#: Pages with different contents among them; copies of one article are one content however many there are.
DIFFERENT = 3
#: Counts of a node's texts may miss this share of its pages (lossy counting; texts that are rarer go).
MISSED = 1 / 16
#: Share of a host's pages that must have a zone for its name to count; two pages at least, unless the host has but one.
ZONE_SHARE = 0.1
#: Nodes kept of a template; beyond, the least supported go (their texts are then judged by structure alone).
MAX_NODES = 2000
#: Nesting that shapes look at; deeper elements are slots.
MAX_DEPTH = 40
#: Wrappers go to every task up to so many characters; beyond, they are joined by host and salt.
BROADCAST_CHARS = 16_000_000
SALTS = 16

_NOISE_TAGS = frozenset("nav footer aside form noscript template button select option head dialog menu svg canvas object audio video label".split()) | RAW
#: Names (whole class, id or role tokens) of zones that are not the article. Fixed word list.
_NOISE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies"
    " disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related reply"
    " replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: These are noise only outside an article, whose own header holds its title.
_HEADER_WORDS = frozenset(("header", "masthead"))

#: Never noise by their names: a page's body or article may carry names of what else it holds.
_WHOLE = frozenset(("html", "body", "article", "main"))
#: Blocks that names tell nothing about: headings and the like are named after what they say.
_UNNAMED = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figcaption caption li dt dd summary hr".split())
_MAIN = frozenset(("article", "main"))
#: Words that a compound class of reader comments begins or ends with, also inside an article.
_COMMENT_WORDS = frozenset(("comment", "comments"))
#: A block beside the content with so many links that hold so much of its text is a list of other pages.
LINKS, LINK_SHARE = 3, 0.75
#: Words before a zone's name that say what a block has, not what it is, as in ``with-sidebar``.
_HAVING_WORDS = frozenset("has have with without no non not".split())


def _compound_zone(classes, in_article: bool) -> bool:
    """Whether a compound class (``sidebar-left``, ``cookie_banner``) names a zone by its first or last word."""
    for name in classes:
        words = re.split(r"[-_]+", name.strip("-_"))
        if len(words) < 2 or words[0] in _HAVING_WORDS or words[:2] == ["ad", "hoc"]:
            continue
        ends = {words[0], words[-1]}
        if not ends.isdisjoint(_COMMENT_WORDS if in_article else _NOISE_WORDS):
            return True
    return False


def is_noise(tag: str, names, in_article: bool, holds_main: Callable[[], bool], supported: bool = True, classes=(), minor: bool = False) -> bool:
    """Whether an element is a zone that is never the article.

    Names tell zones among blocks only, not among inline elements, headings
    and paragraphs, and only if the host's template has the zone
    (``supported``).  Zones told by names, forms and page headers are not noise
    if they hold an article or main element (``holds_main``): they are wrapped
    around the page.  A compound class name tells a zone only of a block that
    holds the lesser part of the host's text (``minor``), so no wrapper of the
    content; inside an article only one of reader comments does.  Compound ids
    tell nothing: they are anchors, named after what a section says.
    """
    if tag in _WHOLE:
        return False
    if tag in _NOISE_TAGS and tag != "form":
        return True
    named = supported and tag in BLOCK and tag not in _UNNAMED
    found = tag == "form" or named and not _NOISE_WORDS.isdisjoint(names)
    found = found or named and minor and _compound_zone(classes, in_article)
    if not in_article and not found:
        found = tag == "header" or named and not _HEADER_WORDS.isdisjoint(names)
    return found and not holds_main()


def _holds_main(node: Node) -> bool:
    return any(not isinstance(c, str) and (c.tag in _MAIN or _holds_main(c)) for c in node.children)


def _link_list(node: Node) -> bool:
    """Whether links hold nearly all of an element's text."""
    links, linked, chars, todo = 0, 0, 0, [(node, False)]
    while todo:
        at, inside = todo.pop()
        if isinstance(at, str):
            n = len(_plain([at]))
            chars += n
            linked += n * inside
        elif not _never_text(at):
            links += at.tag == "a"
            todo += [(c, inside or at.tag == "a") for c in at.children]
    return links >= LINKS and linked >= LINK_SHARE * chars


def _holds_content(node: Node, roles: list) -> bool:
    """Whether one container below holds most of the host's text, so that the others stand beside it."""
    labels = dict.fromkeys(c.label for c in node.children if not isinstance(c, str))
    return any(own[0][1] and not own[0][2] and label.split(".")[0] not in _UNNAMED for label, own in zip(labels, roles[1], strict=False))


# --------------------------------------------------------------- shapes and templates

#: A shape or template node: [label, pages, text signature (None: no text, -1: varying), characters, children, texts].
#: Texts: by signature, pages that were counted, pages that may have been missed, and contents of up to DIFFERENT pages.
LABEL, PAGES, TEXT, CHARS, KIDS, TEXTS = range(6)


def _plain(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def _text_signature(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _never_text(node: Node) -> bool:
    return node.hidden or node.tag in _NOISE_TAGS and node.tag != "form"


def shape_of(root: Node) -> list:
    """Shape of a page's tree; equal siblings are merged to one node, at the place of the first.

    A block's texts are its runs of inline content between other blocks.
    """
    contents: list[int] = []  # signatures of the texts outside zones told by element
    page: list[int] = []  # the signature of all of them, known at the end

    def run_ends(parts: list[str], texts: dict, noise: bool) -> int:
        joined = _plain(parts)
        parts.clear()
        if joined:
            own = _text_signature(joined)
            texts[str(own)] = [1, 0, page]
            if not noise:
                contents.append(own)
        return len(joined)

    def shape(node: Node, depth: int, outer: tuple | None, noise: bool) -> list:
        parts, texts = outer or ([], {})
        chars, kids, place = 0, [], {}
        for child in node.children:
            if isinstance(child, str):
                parts.append(child)
                continue
            block, never = child.tag in BLOCK, _never_text(child)
            if block:
                chars += run_ends(parts, texts, noise)
            elif child.tag in ("br", "td", "th"):
                parts.append(" ")
            kid = shape(child, depth + 1, None if block or never else (parts, texts), noise or never)
            if depth < MAX_DEPTH:
                at = place.setdefault(child.label, len(kids))
                if at < len(kids):
                    kids[at] = merge(kids[at], kid, same_page=True)
                else:
                    kids.append(kid)
        if outer:
            return [node.label, 1, None, 0, kids, {}]
        chars += run_ends(parts, texts, noise)
        text = None if not texts else int(next(iter(texts))) if len(texts) == 1 else -1
        return [node.label, 1, text, chars, kids, texts]

    out = shape(root, 0, None, False)
    page.append(zlib.crc32(repr(contents).encode()))
    return out


def signature(shape: list) -> str:
    """Labels of a shape: shapes with equal signatures align node by node."""
    return f"{shape[LABEL]}({','.join(map(signature, shape[KIDS]))})" if shape[KIDS] else shape[LABEL]


def matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: size of the best matching of two nodes, and the matched children."""
    if a[LABEL] != b[LABEL]:
        return 0, []
    x, y = a[KIDS], b[KIDS]
    if [k[LABEL] for k in x] == [k[LABEL] for k in y]:
        return 1 + sum(matching(p, q)[0] for p, q in zip(x, y, strict=True)), [(i, i) for i in range(len(x))]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    size = [[matching(p, q)[0] if p[LABEL] == q[LABEL] else 0 for q in y] for p in x]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size[i - 1][j - 1])
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if size[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + size[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[-1][-1], pairs[::-1]


def merge(a: list, b: list, same_page: bool = False) -> list:
    """Template of two aligned nodes; children without a partner are kept in order."""
    _, pairs = matching(a, b)
    kids, i, j = [], 0, 0
    for p, q in [*pairs, (len(a[KIDS]), len(b[KIDS]))]:
        kids += a[KIDS][i:p] + b[KIDS][j:q]
        if p < len(a[KIDS]):
            kids.append(merge(a[KIDS][p], b[KIDS][q], same_page))
        i, j = p + 1, q + 1
    if a[TEXT] is None or b[TEXT] is None:
        # Text on some of the pages only: the slot is optional, its text may still be constant.
        text = b[TEXT] if a[TEXT] is None else a[TEXT]
    else:
        text = a[TEXT] if a[TEXT] == b[TEXT] else -1
    pages = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    return [a[LABEL], pages, text, a[CHARS] + b[CHARS], kids, _merged_texts(a, b, same_page)]


def _merged_texts(a: list, b: list, same_page: bool) -> dict:
    """Texts of two aligned nodes, by lossy counting: no text on more than ``MISSED`` of the pages goes."""
    x, y = (t[TEXTS] if len(t) > TEXTS else {} for t in (a, b))
    if same_page:
        return {**x, **y}
    missed_x, missed_y = int(a[PAGES] * MISSED), int(b[PAGES] * MISSED)
    out = {k: [n, m + missed_y, c] for k, (n, m, c) in x.items()} if missed_y else dict(x)
    for k, (n, m, c) in y.items():
        if k in x:
            n0, m0, c0 = x[k]
            out[k] = [n0 + n, m0 + m, c0 if len(c0) >= DIFFERENT else sorted({*c0, *c})[:DIFFERENT]]
        else:
            out[k] = [n, m + missed_x, c]
    least = int((a[PAGES] + b[PAGES]) * MISSED)
    if least > max(missed_x, missed_y):
        out = {k: v for k, v in out.items() if v[0] + v[1] > least}
    return out


def _nodes(t: list) -> int:
    return 1 + sum(map(_nodes, t[KIDS]))


def bounded(t: list, most: int = MAX_NODES) -> list:
    """The template without its least supported nodes if it has more than ``most``."""
    least = 2
    while _nodes(t) > most:
        t = _supported(t, least)
        least *= 2
    return t


def _supported(t: list, least: int) -> list:
    return [*t[:KIDS], [_supported(k, least) for k in t[KIDS] if k[PAGES] >= least], *t[TEXTS:]]


# --------------------------------------------------------------- wrappers

#: A wrapper node: [label, role, children]; a role is the signatures of the template's constant texts, whether the
#: template has the node on a share of the host's pages, and whether the node holds the lesser part of the host's text.
ROLE, PARTS = 1, 2
_BLANK = (frozenset(), False, False)


def wrapper_of(template: list) -> list:
    """Roles of a template's nodes.

    The content is the lowest container of all varying texts.  It needs no
    role of its own: whatever a page has outside it is constant or noise.
    """
    pages = template[PAGES]
    least = max(min(2, pages), ZONE_SHARE * pages)

    weights: dict[int, int] = {}

    def weigh(t: list) -> int:
        # Elements whose text is never the article say nothing about where it is.
        own = 0 if t[LABEL].split(".")[0] in _NOISE_TAGS else t[CHARS] + sum(map(weigh, t[KIDS]))
        weights[id(t)] = own
        return own

    all_text = weigh(template)

    def roles(t: list) -> list:
        constant = [int(k) for k, (n, _, contents) in t[TEXTS].items() if n >= TEXT_SHARE * pages and len(contents) >= DIFFERENT]
        return [t[LABEL], [sorted(constant), t[PAGES] >= least, 2 * weights.get(id(t), 0) < all_text], [roles(k) for k in t[KIDS]]]

    return roles(template)


def _as_template(w: list) -> list:
    """A wrapper seen as a template, for matching."""
    return [w[0], (frozenset(w[ROLE][0]), *w[ROLE][1:]), None, 0, [_as_template(k) for k in w[PARTS]]]


def _aligned(wrapper: list, shape: list) -> list:
    """Roles of a shape's nodes: [role, children], from the wrapper node that each is matched to."""
    _, pairs = matching(wrapper, shape)
    partner = {q: wrapper[KIDS][p] for p, q in pairs}
    return [wrapper[PAGES], [_aligned(partner[i], k) if i in partner else _aligned([k[LABEL], _BLANK, None, 0, []], k) for i, k in enumerate(shape[KIDS])]]


# --------------------------------------------------------------- text

def _collect(node: Node, roles: list, runs: list[tuple[list[str], frozenset]], constant: frozenset, in_article: bool, wrapped: bool, in_content: bool = False) -> None:
    """Runs of text of a node's blocks without noise, each with the constant texts of its block."""
    in_article = in_article or node.tag == "article"
    in_content = in_content or in_article or not _holds_content(node, roles)
    place: dict[str, int] = {}
    # Without a wrapper there is no template to ask, and names count by themselves.
    blank = [_BLANK if wrapped else (frozenset(), True, False), []]
    for child in node.children:
        if isinstance(child, str):
            runs[-1][0].append(child)
            continue
        kid = place.setdefault(child.label, len(place))
        own = roles[1][kid] if kid < len(roles[1]) else blank
        block = child.tag in BLOCK
        if block:
            runs.append(([], own[0][0]))
        elif child.tag in ("br", "td", "th"):
            runs[-1][0].append(" ")
        noise = child.hidden or is_noise(child.tag, child.names, in_article, partial(_holds_main, child), own[0][1], child.classes, own[0][2])
        beside = not in_content and block and child.tag not in _UNNAMED and own[0][1] and own[0][2]
        if not noise and not (beside and not _holds_main(child) and _link_list(child)):
            _collect(child, own, runs, own[0][0] if block else constant, in_article, wrapped, in_content or beside)
        if block:
            runs.append(([], constant))


def main_text(html: str, wrapper: str | None) -> str:
    """Blocks of a page that are neither template nor noise, joined by newlines; without a wrapper no text is template."""
    root = parse(html)
    roles = _roles(wrapper, signature(shape_of(root))) if wrapper else [(frozenset(), True, False), []]
    runs: list[tuple[list[str], frozenset]] = [([], roles[0][0])]
    _collect(root, roles, runs, roles[0][0], False, bool(wrapper))
    lines = ((_plain(parts), constant) for parts, constant in runs)
    return "\n".join(x for x, constant in lines if x and not (constant and _text_signature(x) in constant))


@lru_cache(maxsize=4096)
def _roles(wrapper: str, shape_signature: str) -> list:
    return _aligned(_as_template(json.loads(wrapper)), _shape_from(shape_signature))


def _shape_from(text: str) -> list:
    """Shape with the labels of a signature (labels hold no brackets or commas)."""
    stack, label = [["", 0, None, 0, []]], ""
    for c in text + ",":
        if c in "(),":
            if label:
                stack[-1][KIDS].append([label, 0, None, 0, []])
                label = ""
            if c == "(":
                stack.append(stack[-1][KIDS][-1])
            elif c == ")":
                stack.pop()
        else:
            label += c
    return stack[0][KIDS][0]


# --------------------------------------------------------------- Spark

def host_of(url: str = "url"):
    """Lower-case host of a URL; empty for a null URL or one without a host."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _template_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Templates of the hosts in the pages of one task; equal shapes are merged first, without matching."""
    held: dict[str, dict[str, list]] = {}

    def flush() -> pd.DataFrame:
        rows = []
        for host, by_shape in held.items():
            template = None
            for t in by_shape.values():
                template = t if template is None else bounded(merge(template, t))
            rows.append((host, json.dumps(template, separators=(",", ":"))))
        held.clear()
        return pd.DataFrame(rows, columns=["host", "template"])

    kept = 0
    for batch in batches:
        for host, html in zip(batch["host"], batch["html"], strict=True):
            shape = shape_of(parse(html))
            own = held.setdefault(host, {})
            key = signature(shape)
            if key not in own:
                kept += 1
            own[key] = merge(own[key], shape) if key in own else shape
            if kept >= 2000:
                yield flush()
                kept = 0
    if held:
        yield flush()


def _merge_templates(group: pd.DataFrame) -> pd.DataFrame:
    template = None
    for t in group["template"].sort_values():
        template = json.loads(t) if template is None else bounded(merge(template, json.loads(t)))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "template": [json.dumps(template, separators=(",", ":"))]})


def _merge_to_wrapper(group: pd.DataFrame) -> pd.DataFrame:
    template = json.loads(_merge_templates(group)["template"].iloc[0])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(wrapper_of(template), separators=(",", ":"))]})


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` of frames ``host, html``, over all pages."""
    partial = pages.mapInPandas(_template_batches, "host string, template string")
    # A host on many tasks: merged in salted parts first, so that no task gets all of its templates.
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("template"), F.lit(SALTS)))
    parts = salted.groupBy("host", "salt").applyInPandas(_merge_templates, "host string, template string")
    return parts.groupBy("host").applyInPandas(_merge_to_wrapper, "host string, wrapper string")


def _text_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = batch[["page_id", "url"]].copy()
        out["page_id"] = out["page_id"].astype("Int64")
        out["text"] = [main_text(h, w) for h, w in zip(batch["html"], batch["wrapper"], strict=True)]
        yield out


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from the whole html.

    ``text`` is the main text: blocks in page order joined by newlines, white
    space inside a block as one space, character references decoded; empty if
    there is none.  Null html counts as empty, null urls share the empty host,
    null ids stay null, repeated rows are pages of their own, and an empty
    table gives an empty result.
    """
    src = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        host_of(url_column).alias("host"),
        F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit("")).alias("html"),
    )
    wrappers = materialise(induce_wrappers(src.select("host", "html")), "page-wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    if size <= broadcast_chars:
        joined = src.join(F.broadcast(wrappers), "host", "left")
    else:
        salt = f"{OWN}salt"
        many = wrappers.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = src.withColumn(salt, F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.lit(SALTS)).cast("int")).join(many, ["host", salt], "left")
    found = joined.select("page_id", "url", "html", "wrapper").mapInPandas(_text_batches, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
