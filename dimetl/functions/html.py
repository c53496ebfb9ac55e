"""HTML extraction as column expressions over a stored ``html`` column.

A page is split once into tag and text tokens (``tokens``); an element is the
run of tokens from its start tag to the end tag of its own depth, so like tags
nested inside do not end it.  Everything is a lazy column expression evaluated by
the JVM on each page in parallel; a malformed page gives NULL (or an empty
array), never an error.  Attributes may come in any order and either quotes,
texts may hold markup and character references, named or numeric, and each
lookup is scoped to the block it belongs to, so a like-named element elsewhere
is not taken.

Every function takes the html column, or the page's ``Tokens`` where several
lookups share one split.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimetl.functions.text import digit_sum, parse_price

# Fixed values -------------------------------------------------------------
# Element lookups of the detail page: field -> (tag, attribute, value).
ELEMENT_MAP: dict[str, tuple[str, str, str]] = {
    "id": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_ref"),
    "listing_type": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_finalidade"),
    "property_type": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_tipo_imovel"),
    "asking_price": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_preco_venda"),
    "district": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_distrito"),
    "county": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_concelho"),
    "parish": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_freguesia"),
    "city": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_distrito"),
    "gross_area": ("span", "id", "ctl00_ContentPlaceHolder1_lbl_imovel_show_area_bruta"),
}
# <meta property=...> lookups: field -> property.
META_MAP: dict[str, str] = {
    "listing_url": "og:url",
    "summary": "og:title",
    "avatar_url": "og:image",
}
# Icon indicator titles -> field.
INDICATOR_MAP: dict[str, str] = {
    "Bedrooms": "bedrooms",
    "Bathroom": "bathrooms",
    "Parking": "parking_spaces",
}
ENERGY_TITLE_PREFIX = "Energ. Cert.:"
# Labels of the detail list items (matched case-insensitively).
LABELS: dict[str, str] = {
    "price": "Preço",
    "listing_type": "Estado",
    "energy_certificate": "Certificado energético",
    "parking": "Tipo de estacionamento",
}
# --------------------------------------------------------------------------

_META = "^$.*+?()[]{}|\\"


def regex_literal(text: str) -> str:
    """Escape regex metacharacters only, so the pattern reads the same in Java regex and RE2."""
    return "".join("\\" + ch if ch in _META else ch for ch in text)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _nullif_empty(c: Column) -> Column:
    return _let(c, lambda v: F.when(v == "", F.lit(None).cast("string")).otherwise(v))


#: Named references: the standard names of HTML 4 and the apostrophe.
_NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}


def _code_point(number: Column) -> Column:
    """The character of a code point (1-10FFFF but surrogates), else NULL; the no-break space reads as a space."""
    good = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    wide = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.when(number == 160, F.lit(" ")).when(good, F.decode(wide, "UTF-32"))


def decode_references(c: Column) -> Column:
    """Named and numeric character references as their characters; unknown ones stay as they are."""
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")

    def decoded(piece: Column) -> Column:
        body = F.substring(piece, F.lit(2), F.length(piece) - 2)
        code = F.when(
            body.rlike("^#[xX]"), F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10)
        ).otherwise(F.substring(body, F.lit(2), F.length(body))).try_cast("bigint")
        char = F.when(body.startswith("#"), _code_point(code)).otherwise(F.try_element_at(names, body))
        return F.when(piece.rlike("^&.+;$"), F.coalesce(char, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(c, F.lit("&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[a-zA-Z][a-zA-Z0-9]{1,31});|[^&]+|&"), 0)
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces, decoded), "")).otherwise(c)


def inner_text(c: Column) -> Column:
    """Text of a piece of HTML: markup removed, references decoded, trimmed; empty gives NULL."""
    return _let(F.regexp_replace(c, r"<[^>]*>", ""), lambda v: _nullif_empty(F.trim(decode_references(v))))


# ------------------------------------------------------------------ tokens

#: Comments, whole scripts and styles, tags (a quoted value may hold ``>``; an unpaired quote ends at it), stray signs, texts.
_TOKEN = (
    r"<!--[\s\S]*?-->|(?i:<(script|style)\b[^>]*>[\s\S]*?</\1\s*>)"
    r"|</?[A-Za-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[A-Za-z][^>]*>|<|[^<]+"
)


@dataclass(frozen=True)
class Tokens:
    """A page's tokens as written, ``array<string>``; only those that a lookup needs are read further."""

    column: Column


def tokens(html: str | Column) -> Column:
    return F.regexp_extract_all(_c(html), F.lit(_TOKEN), 0)


def _name(raw: Column) -> Column:
    """Name of a tag; empty for texts, comments and stray signs."""
    return F.lower(F.regexp_extract(raw, "^</?([A-Za-z][A-Za-z0-9]*)", 1))


def _tagged(raw: Column, *names: str) -> Column:
    """Whether a token is a tag of one of the names; texts are told by their first sign."""
    return raw.startswith("<") & raw.rlike(f"^</?(?i:{'|'.join(names)})(?![A-Za-z0-9])")


def _closing(raw: Column) -> Column:
    return raw.startswith("</")


def _in_tokens(page: str | Column | Tokens, body: Callable[[Column], Column]) -> Column:
    """``body`` of a page's tokens; a page that is not split yet is split once, however often ``body`` names them."""
    return body(page.column) if isinstance(page, Tokens) else _let(tokens(page), body)


def _marks(toks: Column, names: Sequence[str], hit: Callable[[Column], Column]) -> Column:
    """Place, name, direction of every tag of these names (of every token but texts if there are none), and whether it is ``hit``."""

    def mark(r: Column, i: Column) -> Column:
        return F.when(_tagged(r, *names) if names else r.startswith("<"), F.struct((i + 1).alias("at"), _name(r).alias("name"), _closing(r).alias("closing"), hit(r).alias("hit")))

    return F.filter(F.transform(toks, mark), lambda m: m.isNotNull())


def _end_of(tags: Column, start: Column) -> Column:
    """Place of the end tag of the element that starts at the mark ``start``; 0 if it has none."""

    def step(s: Column, t: Column) -> Column:
        moved = F.struct((s["depth"] + F.when(t["closing"], -1).otherwise(1)).alias("depth"), F.lit(0).alias("end"))
        ended = F.struct(F.lit(0).alias("depth"), t["at"].alias("end"))
        return F.when(s["end"] > 0, s).when(t["closing"] & (s["depth"] == 1), ended).otherwise(moved)

    like = F.filter(tags, lambda t: (t["at"] > start["at"]) & (t["name"] == start["name"]))
    return F.aggregate(like, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("end")), step)["end"]


def _inside(toks: Column, tags: Column, start: Column) -> Column:
    """Tokens inside the element that starts at the mark ``start``; NULL without a start, or if it never ends."""
    found = _let(_end_of(tags, start), lambda end: F.when(end > 0, F.slice(toks, start["at"] + 1, end - start["at"] - 1)))
    return F.when(start.isNotNull(), found)


def element_tokens(toks: Column, tag: str, wanted: Callable[[Column], Column]) -> Column:
    """Tokens inside the first element ``tag`` whose start tag is ``wanted``; NULL if there is none or it never ends.

    ``toks`` is a column or a value bound by ``_let``: it is named more than once.
    """

    def found(marks: Column) -> Column:
        return _let(F.try_element_at(F.filter(marks, lambda m: m["hit"]), F.lit(1)), lambda start: _inside(toks, marks, start))

    return _let(_marks(toks, [tag], lambda r: ~_closing(r) & wanted(r)), found)


def _element_tokens_each(toks: Column, specs: Sequence[tuple[str, str, str]], body: Callable[[Column], Column]) -> Column:
    """``body`` of ``element_tokens`` for every ``(name, word, pattern)`` of a start tag (any name if empty), as an array in their order.

    The page is gone through once for the tags of these names and the start tags
    that fit any pattern, which hold its word; each pattern is then tried on
    these alone, and ends are looked for among the tags.
    """
    names, either = sorted({name for name, _, _ in specs}), "|".join(pattern for _, _, pattern in specs)
    words = reduce(lambda a, b: lambda r: a(r) | b(r), [lambda r, w=w: F.contains(r, F.lit(w)) for w in sorted({w for _, w, _ in specs})])

    def fitting(m: Column) -> Column:
        raw = F.element_at(toks, m["at"])
        fits = [F.rlike(raw, F.lit(pattern)) if name == "" else (m["name"] == name) & F.rlike(raw, F.lit(pattern)) for name, _, pattern in specs]
        return F.struct(m["at"].alias("at"), m["name"].alias("name"), F.array(*fits).alias("fits"))

    def each(p: Column) -> Column:
        def one(n: Column) -> Column:
            start = F.try_element_at(F.filter(p["starts"], lambda c: F.element_at(c["fits"], n)), F.lit(1))
            return _let(start, lambda at: _let(_inside(toks, p["tags"], at), body))

        return F.transform(F.array(*[F.lit(n + 1) for n in range(len(specs))]), one)

    def places(marks: Column) -> Column:
        starts = F.transform(F.filter(marks, lambda m: m["hit"]), fitting)
        return _let(F.struct(F.filter(marks, lambda m: m["name"] != "").alias("tags"), starts.alias("starts")), each)

    return _let(_marks(toks, [] if "" in names else names, lambda r: ~_closing(r) & words(r) & F.rlike(r, F.lit(either))), places)


def start_tag(toks: Column, wanted: Callable[[Column], Column]) -> Column:
    """The first start tag that is ``wanted``, as written; NULL if there is none."""
    return F.try_element_at(F.filter(toks, lambda r: r.startswith("<") & ~_closing(r) & wanted(r)), F.lit(1))


def text_of(toks: Column) -> Column:
    """Text of tokens, trimmed; empty gives NULL. Only texts and stray signs have one."""
    texts = F.filter(toks, lambda r: ~r.startswith("<") | (r == "<"))
    return _nullif_empty(F.trim(F.array_join(F.transform(texts, decode_references), "")))


def item_tokens(block: Column) -> Column:
    """Tokens of every item of the outermost lists of a block, in order; lists nested inside belong to their item.

    An item ends at its end tag, at the next item or at the end of its list.
    """

    def first_level(marks: Column) -> Column:
        # Inside a list the items stand at depth 0, in a block around lists at depth 1.
        first = F.try_element_at(F.filter(marks, lambda t: ~t["closing"]), F.lit(1))
        return F.when(first["name"] == "li", 0).otherwise(1)

    def step(s: Column, t: Column) -> Column:
        at, is_list = t["at"], t["name"].isin("ul", "ol")
        own = (t["name"] == "li") & (s["depth"] == s["level"])
        over = own | (is_list & t["closing"] & (s["depth"] == s["level"]))
        ended = F.array(F.struct(s["begin"].alias("a"), at.alias("b")))
        return F.struct(
            s["level"].alias("level"),
            (s["depth"] + F.when(is_list, F.when(t["closing"], -1).otherwise(1)).otherwise(0)).alias("depth"),
            F.when(over, F.when(t["closing"], 0).otherwise(at)).otherwise(s["begin"]).alias("begin"),
            F.when(over & (s["begin"] > 0), F.concat(s["items"], ended)).otherwise(s["items"]).alias("items"),
        )

    nothing = F.array().cast("array<struct<a:int,b:int>>")

    def places(marks: Column) -> Column:
        begin = F.struct(first_level(marks).alias("level"), F.lit(0).alias("depth"), F.lit(0).alias("begin"), nothing.alias("items"))
        return F.aggregate(marks, begin, step, finish)

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["begin"].alias("a"), (F.size(block) + 1).alias("b")))
        return F.when(s["begin"] > 0, F.concat(s["items"], last)).otherwise(s["items"])

    marks = _marks(block, ("ul", "ol", "li"), lambda r: F.lit(True))
    return F.transform(_let(marks, places), lambda p: F.slice(block, p["a"] + 1, p["b"] - p["a"] - 1))


def _with_attribute(tag: str, attr: str, value: str) -> str:
    """Pattern of a start tag that has ``attr`` equal to ``value``, in either quotes."""
    return f"<{tag}\\b(?=[^>]*\\s{attr}\\s*=\\s*(?:\"{regex_literal(value)}\"|'{regex_literal(value)}'))[^>]*>"


def _with_class(tag: str, word: str) -> str:
    """Pattern of a start tag one of whose class words is ``word``."""
    return f"<{tag}\\b(?=[^>]*\\sclass\\s*=\\s*[\"'](?:[^\"'>]*\\s)?{regex_literal(word)}[\\s\"'])[^>]*>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag, in either quotes; NULL if absent or empty."""
    found = F.regexp_extract(tag, f"\\s{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')", 0)
    return inner_text(F.regexp_replace(found, f"^\\s{name}\\s*=\\s*[\"']|[\"']$", ""))


def _is(tag: str, attr: str, value: str) -> Callable[[Column], Column]:
    pattern = _with_attribute(tag, attr, value)
    return lambda r: F.contains(r, F.lit(value)) & r.rlike(pattern) & (_name(r) == tag)


def _classed(tag: str, word: str) -> Callable[[Column], Column]:
    pattern = _with_class(tag, word)
    return lambda r: F.contains(r, F.lit(word)) & r.rlike(pattern) & (_name(r) == tag)


def element_texts(page: str | Column | Tokens, specs: Sequence[tuple[str, str | None, str | None]]) -> Column:
    """Texts of the first ``<tag>`` whose ``attr`` is ``value`` (any ``<tag>`` without ``attr``), as an array in the order of ``specs``."""
    wanted = [(tag, value, _with_attribute(tag, attr, value)) if attr else (tag, "", f"<{tag}") for tag, attr, value in specs]
    return _in_tokens(page, lambda toks: _element_tokens_each(toks, wanted, text_of))


#: The three lists of a page: tag (any if empty) and class of the block around them.
DETAILS, ICONS, TAGS = ("ul", "caret-list"), ("", "bloco-caracteristicas"), ("ul", "tags-list")


def block_items(page: str | Column | Tokens, blocks: Sequence[tuple[str, str]] = (DETAILS, ICONS, TAGS)) -> Column:
    """Tokens of the items of the first block of each kind, as an array in the order of ``blocks``; NULL for a block that is not there."""
    wanted = [(tag, word, _with_class(tag or "[A-Za-z0-9]+", word)) for tag, word in blocks]
    return _in_tokens(page, lambda toks: _element_tokens_each(toks, wanted, item_tokens))


def element_text(page: str | Column | Tokens, tag: str, attr: str, value: str) -> Column:
    """Text of the first ``<tag>`` whose ``attr`` is ``value``."""
    return element_texts(page, [(tag, attr, value)])[0]


def tag_text(page: str | Column | Tokens, tag: str) -> Column:
    """Text of the first ``<tag>``, markup nested inside removed."""
    return element_texts(page, [(tag, None, None)])[0]


def element_map(page: str | Column | Tokens, mapping: dict[str, tuple[str, str, str]] | None = None) -> Column:
    """Struct of the texts of all mapped elements."""
    mapping = ELEMENT_MAP if mapping is None else mapping
    return _let(element_texts(page, list(mapping.values())), lambda found: F.struct(*[found[n].alias(name) for n, name in enumerate(mapping)]))


def meta_content(page: str | Column | Tokens, prop: str) -> Column:
    return attribute(_in_tokens(page, lambda toks: start_tag(toks, _is("meta", "property", prop))), "content")


def meta_map(page: str | Column | Tokens, mapping: dict[str, str] | None = None) -> list[Column]:
    mapping = META_MAP if mapping is None else mapping
    return [meta_content(page, prop).alias(name) for name, prop in mapping.items()]


def _before_strong(item: Column) -> Column:
    at = F.array_position(F.transform(item, lambda r: _tagged(r, "strong")), True)
    return _let(at, lambda i: F.when(i > 0, F.slice(item, F.lit(1), i - 1)).otherwise(item))


def details_of(items: Column) -> Column:
    """``array<struct<label, value>>`` of list items: text before and in each item's ``<strong>``."""
    return F.transform(
        items,
        lambda li: F.struct(
            text_of(_before_strong(li)).alias("label"), text_of(element_tokens(li, "strong", lambda r: F.lit(True))).alias("value")
        ),
    )


def details(page: str | Column | Tokens) -> Column:
    """``details_of`` the details list."""
    return details_of(block_items(page, [DETAILS])[0])


def label_value(found: Column, label: str) -> Column:
    """Value of the first detail whose label starts with ``label``; ``found`` are the ``details``."""
    hit = F.filter(found, lambda d: F.lower(d["label"]).startswith(label.lower()))
    return F.try_element_at(hit, F.lit(1))["value"]


def label_values(page: str | Column | Tokens) -> list[Column]:
    """``label_fields`` of a page; where the details are a column already, ``label_fields`` reads the page no more."""
    return label_fields(details(page))


def label_fields(found: Column) -> list[Column]:
    """Price (number), listing type, energy certificate and parking spaces; ``found`` are the ``details``."""
    return [
        parse_price(label_value(found, LABELS["price"])).alias("price"),
        label_value(found, LABELS["listing_type"]).alias("listing_type"),
        label_value(found, LABELS["energy_certificate"]).alias("energy_certificate"),
        digit_sum(label_value(found, LABELS["parking"])).alias("parking_spaces"),
    ]


def icons_of(items: Column) -> Column:
    """``array<struct<title, num>>`` of list items: title of the first titled span, text of the number span."""
    return F.transform(
        items,
        lambda li: F.struct(
            attribute(start_tag(li, lambda r: _tagged(r, "span") & r.rlike(r"\stitle\s*=")), "title").alias("title"),
            text_of(element_tokens(li, "span", _classed("span", "num"))).alias("num"),
        ),
    )


def indicator_items(page: str | Column | Tokens) -> Column:
    """``icons_of`` the icon block."""
    return icons_of(block_items(page, [ICONS])[0])


def indicator(found: Column, title: str) -> Column:
    """Number of the first icon with the title; ``found`` are the ``indicator_items``."""
    return F.try_element_at(F.filter(found, lambda i: (i["title"] == title) & i["num"].isNotNull()), F.lit(1))["num"]


def energy_icon(found: Column) -> Column:
    """Energy class: the rest of the first icon title that starts with the energy prefix and has no number."""
    hit = F.filter(found, lambda i: i["title"].startswith(ENERGY_TITLE_PREFIX) & i["num"].isNull())
    return _nullif_empty(F.trim(F.replace(F.try_element_at(hit, F.lit(1))["title"], F.lit(ENERGY_TITLE_PREFIX), F.lit(""))))


def indicators(page: str | Column | Tokens) -> list[Column]:
    """``indicator_fields`` of a page; where the icons are a column already, ``indicator_fields`` reads the page no more."""
    return indicator_fields(indicator_items(page))


def indicator_fields(found: Column) -> list[Column]:
    """Numbers of the mapped icons and the energy class; ``found`` are the ``indicator_items``."""
    cols = [indicator(found, title).alias(name) for title, name in INDICATOR_MAP.items()]
    return [*cols, energy_icon(found).alias("energy_certificate_icon")]


COORD_PATTERN = r"query=([+-]?[0-9]*\.?[0-9]+),([+-]?[0-9]*\.?[0-9]+)"


def coordinates(page: str | Column | Tokens) -> list[Column]:
    """Latitude and longitude in the ``onclick`` of the map image."""
    image = _in_tokens(page, lambda toks: start_tag(toks, _classed("img", "img_mapa")))
    lat = _nullif_empty(F.regexp_extract(image, COORD_PATTERN, 1)).try_cast("double")
    lon = _nullif_empty(F.regexp_extract(image, COORD_PATTERN, 2)).try_cast("double")
    return [lat.alias("latitude"), lon.alias("longitude")]


def amenities_of(items: Column) -> Column:
    """Texts of list items (empty array if there is no list)."""
    return F.coalesce(F.transform(items, text_of), F.array().cast("array<string>"))


def amenities(page: str | Column | Tokens) -> Column:
    """``amenities_of`` the first tags list."""
    return amenities_of(block_items(page, [TAGS])[0])


def links(html: str | Column) -> Column:
    """Every ``href`` target, in page order."""
    found = F.regexp_extract_all(_c(html), F.lit(r"\shref\s*=\s*(\"[^\"]*\"|'[^']*')"), 1)
    return F.transform(found, lambda h: F.substring(h, F.lit(2), F.length(h) - 2))


# The results table and the paging link of an index page.
RESULTS_TABLE_ID = "ctl00_ContentPlaceHolder1_DataList_imoveis"
NEXT_PAGE_ID = "ctl00_ContentPlaceHolder1_lnkNext"


def listing_links(page: str | Column | Tokens) -> Column:
    """Targets of the anchors with an id inside the results table of an index page, in page order."""
    block = _in_tokens(page, lambda toks: element_tokens(toks, "table", _is("table", "id", RESULTS_TABLE_ID)))
    anchors = F.filter(block, lambda r: _tagged(r, "a") & ~_closing(r) & r.rlike(r"\sid\s*="))
    return F.filter(F.transform(anchors, lambda r: attribute(r, "href")), lambda h: h.isNotNull())


def next_page(page: str | Column | Tokens, link_id: str = NEXT_PAGE_ID) -> Column:
    """Target of the paging link; NULL on the last page, where it has none."""
    return attribute(_in_tokens(page, lambda toks: start_tag(toks, _is("a", "id", link_id))), "href")
