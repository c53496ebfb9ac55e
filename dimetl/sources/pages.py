"""Listing extraction from stored pages and nested API pages.

The input is a table of pages (``page_id, url, html``) or of JSON API pages;
every function is one lazy projection over the whole table, evaluated per
page by the JVM in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.functions import html as H
from dimetl.functions.text import absolute_url, digit_sum, parse_price, remove_unicode, rename_mapped
from dimetl.operators.filters import const_columns
from dimetl.schemas import LISTING_PAGE_SCHEMA

# Fixed value: API field -> listing field.
API_FIELD_MAP: dict[str, str] = {
    "ContractNumber": "contract_number",
    "Title": "name",
    "Description": "description",
    "PriceCurrencyFormated": "asking_price",
    "PropertyType": "property_type",
    "FullLocation": "full_location",
    "Bedrooms": "bedrooms",
    "Bathrooms": "bathrooms",
    "AreaGross": "gross_area",
    "AreaNet": "net_area",
    "Photo": "avatar_url",
    "URLSEOv2": "listing_url",
    "Latitude": "latitude",
    "Longitude": "longitude",
}


def page_extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One listing record per stored page.

    The two page layouts carry some attributes in different places (element
    ids, labelled list items, icon indicators); each such attribute is the
    first value found, in that order.
    """
    keep = [c for c in pages.columns if c != html_col]
    # A page is split once, and its elements and lists are read once; every field is a lookup in them.
    h = H.Tokens(F.col("__tokens"))
    split = pages.select(*keep, H.tokens(F.col(html_col)).alias("__tokens"))
    elements = [*H.ELEMENT_MAP.values(), ("title", None, None), ("h1", None, None)]
    split = split.select(*keep, "__tokens", H.element_texts(h, elements).alias("__elements"), H.block_items(h).alias("__blocks"))
    items = F.col("__blocks")
    found = split.select(
        *keep, "__tokens", "__elements", H.details_of(items[0]).alias("__details"), H.icons_of(items[1]).alias("__icons"), items[2].alias("__tags")
    )
    el = {name: F.col("__elements")[n] for n, name in enumerate([*H.ELEMENT_MAP, "title", "headline"])}
    lab = {c: H.label_value(F.col("__details"), H.LABELS[c]) for c in H.LABELS}
    ind = {name: H.indicator(F.col("__icons"), title) for title, name in H.INDICATOR_MAP.items()}
    return found.select(
        *keep,
        remove_unicode(el["title"]).alias("title"),
        remove_unicode(el["headline"]).alias("headline"),
        *H.meta_map(h),
        *[el[n].alias(n) for n in H.ELEMENT_MAP if n != "listing_type"],
        F.coalesce(el["listing_type"], lab["listing_type"]).alias("listing_type"),
        parse_price(lab["price"]).alias("price"),
        F.coalesce(lab["energy_certificate"], H.energy_icon(F.col("__icons"))).alias("energy_certificate"),
        ind["bedrooms"].alias("bedrooms"),
        ind["bathrooms"].alias("bathrooms"),
        F.coalesce(ind["parking_spaces"].try_cast("int"), digit_sum(lab["parking"])).alias("parking_spaces"),
        *H.coordinates(h),
        H.amenities_of(F.col("__tags")).alias("amenities"),
    )


def next_pages(pages: DataFrame, site: str, key_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Absolute address of the page after each index page: ``(key, next_url)``; NULL on a last page."""
    return pages.select(key_col, absolute_url(site, H.next_page(F.col(html_col))).alias("next_url"))


def index_links(pages: DataFrame, site: str, key_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Absolute listing links of index pages: ``(key, link_pos, listing_url)``."""
    found = pages.select(F.col(key_col), F.posexplode(H.listing_links(F.col(html_col))).alias("link_pos", "href"))
    return found.select(key_col, "link_pos", absolute_url(site, "href").alias("listing_url"))


def page_links(pages: DataFrame, key_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every link of every page: ``(key, link_pos, href)``."""
    return pages.select(F.col(key_col), F.posexplode(H.links(F.col(html_col))).alias("link_pos", "href"))


def listing_explode(
    api_pages: DataFrame,
    json_col: str = "body",
    mapping: dict[str, str] | None = None,
    site: str | None = None,
    constants: dict[str, str] | None = None,
) -> DataFrame:
    """Nested API pages (``Properties[]``) -> one row per listing, renamed through ``mapping``.

    ``site`` completes the relative ``listing_url``; ``constants`` (broker,
    country) are added to every listing.
    """
    mapping = API_FIELD_MAP if mapping is None else mapping
    parsed = api_pages.select(F.from_json(F.col(json_col), LISTING_PAGE_SCHEMA).alias("p"))
    rows = parsed.select(F.col("p.CurrentPage").alias("current_page"), F.explode("p.Properties").alias("l")).select(
        "current_page", "l.*"
    )
    out = rename_mapped(rows, {"current_page": "current_page", **mapping})
    if site:
        out = out.withColumn("listing_url", absolute_url(site.rstrip("/") + "/", F.ltrim(F.col("listing_url"), F.lit("/"))))
    return const_columns(out, constants) if constants else out
