"""Stored-page extraction and whole-text functions over ``pages`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimetl.functions import html as H
from dimetl.functions.text import absolute_url, digit_sum, limit_length, remove_unicode, strip_tags
from dimetl.sources.pages import index_links, next_pages, page_extract, page_links
from dimetl.verify.adapters import INDEX_PAGE_SIZE, a_index_page, a_listing_page, table, with_views
from dimetl.verify.q_listings import sql_strip_tags
from dimetl.verify.registry import register

def sql_digit_sum(e: str) -> str:
    return (
        f"CASE WHEN {e} IS NULL THEN NULL ELSE CAST(COALESCE(list_sum(list_transform("
        f"regexp_extract_all({e}, '\\d', 0), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) END"
    )


def _pages(spark, d):
    return table(spark, d, "pages")


# The oracle of the extraction reads the columns that the listing pages were built from, not the pages.
ICONS = "c_custkey % 2 = 0"
ENERGY = "substr('ABCDE', CAST(c_custkey % 5 + 1 AS INTEGER), 1)"
SQL_PRICE = "TRY_CAST(regexp_extract(replace(PriceCurrencyFormated, ' ', ''), '^([^,€$£]+)', 1) AS DOUBLE)"
META_SQL = "'http://listings.example/' || CAST(c_custkey AS VARCHAR) AS listing_url, PropertyType AS summary, Photo AS avatar_url"
ELEMENTS = {
    "id": "ContractNumber", "listing_type": "'Venda'", "property_type": "PropertyType", "asking_price": "PriceCurrencyFormated",
    "district": "County", "county": "Country", "parish": "Parish", "city": "County", "gross_area": "AreaGross",
}
ELEMENT_SQL = {n: f"CASE WHEN {ICONS} THEN {e} END" for n, e in ELEMENTS.items()}
COORD_SQL = "CAST(Latitude AS DOUBLE) AS latitude, CAST(Longitude AS DOUBLE) AS longitude"
AMENITIES = f"CASE WHEN {ICONS} THEN '' ELSE County || '|Pool & Sauna' END"
FROM_LISTING = " FROM a_listing"


@register(
    "page_extract",
    with_views("a_listing")
    + "SELECT c_custkey AS page_id, 'http://listings.example/' || CAST(c_custkey AS VARCHAR) AS url, 'Home & ' || ContractNumber AS title, "
    f"'Flat ' || ContractNumber AS headline, {META_SQL}, "
    + ", ".join(f"{e} AS {n}" for n, e in ELEMENT_SQL.items() if n != "listing_type")
    + f", CASE WHEN {ICONS} THEN 'Venda' ELSE 'Arrendamento' END AS listing_type, CASE WHEN {ICONS} THEN NULL ELSE {SQL_PRICE} END AS price, "
    f"{ENERGY} AS energy_certificate, CASE WHEN {ICONS} THEN Bedrooms END AS bedrooms, CASE WHEN {ICONS} THEN Bathrooms END AS bathrooms, "
    f"CAST(c_custkey % 4 + CASE WHEN {ICONS} THEN 0 ELSE 1 END AS INTEGER) AS parking_spaces, {COORD_SQL}, {AMENITIES} AS amenities" + FROM_LISTING,
)
def q_page_extract(spark, d):
    return page_extract(a_listing_page(spark, d)).withColumn("amenities", F.array_join("amenities", "|"))


@register(
    "html_element_map",
    with_views("a_listing") + "SELECT c_custkey AS page_id, " + ", ".join(f"{e} AS {n}" for n, e in ELEMENT_SQL.items()) + FROM_LISTING,
)
def q_html_element_map(spark, d):
    return a_listing_page(spark, d).select("page_id", H.element_map(F.col("html")).alias("e")).select("page_id", "e.*")


@register("html_meta", with_views("a_listing") + f"SELECT c_custkey AS page_id, 'Home & ' || ContractNumber AS title, {META_SQL}" + FROM_LISTING)
def q_html_meta(spark, d):
    h = H.Tokens(F.col("tokens"))
    split = a_listing_page(spark, d).select("page_id", H.tokens("html").alias("tokens"))
    return split.select("page_id", remove_unicode(H.tag_text(h, "title")).alias("title"), *H.meta_map(h))


@register(
    "html_label_value",
    with_views("a_listing")
    + f"SELECT c_custkey AS page_id, CASE WHEN {ICONS} THEN NULL ELSE {SQL_PRICE} END AS price, "
    f"CASE WHEN {ICONS} THEN NULL ELSE 'Arrendamento' END AS listing_type, CASE WHEN {ICONS} THEN NULL ELSE {ENERGY} END AS energy_certificate, "
    f"CASE WHEN {ICONS} THEN NULL ELSE CAST(c_custkey % 4 + 1 AS INTEGER) END AS parking_spaces" + FROM_LISTING,
)
def q_html_label_value(spark, d):
    found = a_listing_page(spark, d).select("page_id", H.details(F.col("html")).alias("found"))
    return found.select("page_id", *H.label_fields(F.col("found")))


@register(
    "html_indicators",
    with_views("a_listing")
    + f"SELECT c_custkey AS page_id, CASE WHEN {ICONS} THEN Bedrooms END AS bedrooms, CASE WHEN {ICONS} THEN Bathrooms END AS bathrooms, "
    f"CASE WHEN {ICONS} THEN CAST(c_custkey % 4 AS VARCHAR) END AS parking_spaces, CASE WHEN {ICONS} THEN {ENERGY} END AS energy_certificate_icon"
    + FROM_LISTING,
)
def q_html_indicators(spark, d):
    found = a_listing_page(spark, d).select("page_id", H.indicator_items(F.col("html")).alias("found"))
    return found.select("page_id", *H.indicator_fields(F.col("found")))


@register("extract_coords", with_views("a_listing") + f"SELECT c_custkey AS page_id, {COORD_SQL}" + FROM_LISTING)
def q_extract_coords(spark, d):
    return a_listing_page(spark, d).select("page_id", *H.coordinates(F.col("html")))


@register(
    "amenity_array",
    with_views("a_listing")
    + f"SELECT c_custkey AS page_id, CAST(CASE WHEN {ICONS} THEN 0 ELSE 2 END AS INTEGER) AS n_items, {AMENITIES} AS items_text" + FROM_LISTING,
)
def q_amenity_array(spark, d):
    items = a_listing_page(spark, d).select("page_id", H.amenities(F.col("html")).alias("items"))
    return items.select("page_id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items_text"))


SQL_LINKS = (
    "SELECT page_id, url, CAST(unnest(range(0, len(l))) AS INTEGER) AS link_pos, unnest(l) AS href "
    "FROM (SELECT page_id, url, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS l FROM pages)"
)


@register("page_links", f"SELECT page_id, link_pos, href FROM ({SQL_LINKS})")
def q_page_links(spark, d):
    return page_links(_pages(spark, d))


@register(
    "index_links",
    f"SELECT CAST(c_custkey // {INDEX_PAGE_SIZE} AS BIGINT) AS page_id, "
    f"CAST(row_number() OVER (PARTITION BY c_custkey // {INDEX_PAGE_SIZE} ORDER BY c_custkey) - 1 AS INTEGER) AS link_pos, "
    "'http://listings.example/buy/' || CAST(c_custkey AS VARCHAR) || '?a=1&b=2' AS listing_url FROM customer",
)
def q_index_links(spark, d):
    """The listing links of every index page: anchors with an id in the results table, tables nested inside or not."""
    return index_links(a_index_page(spark, d), "http://listings.example")


@register(
    "next_page",
    f"SELECT DISTINCT CAST(c_custkey // {INDEX_PAGE_SIZE} AS BIGINT) AS page_id, "
    f"CASE WHEN c_custkey // {INDEX_PAGE_SIZE} < (SELECT max(c_custkey // {INDEX_PAGE_SIZE}) FROM customer) "
    f"THEN 'http://listings.example/index/' || CAST(c_custkey // {INDEX_PAGE_SIZE} + 1 AS VARCHAR) END AS next_url FROM customer",
)
def q_next_page(spark, d):
    return next_pages(a_index_page(spark, d), "http://listings.example")


@register(
    "absolute_url",
    "SELECT page_id, link_pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || href "
    f"ELSE href END AS link_url FROM ({SQL_LINKS})",
)
def q_absolute_url(spark, d):
    p = _pages(spark, d)
    links = p.select("page_id", "url", F.posexplode(H.links(F.col("html"))).alias("link_pos", "href"))
    host = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    return links.select(
        "page_id", "link_pos",
        F.when(F.col("href").startswith("/"), absolute_url(host, "href")).otherwise(F.col("href")).alias("link_url"),
    )


@register("strip_tags", "SELECT page_id, " + sql_strip_tags("html") + " AS text FROM pages")
def q_strip_tags(spark, d):
    return _pages(spark, d).select("page_id", strip_tags("html").alias("text"))


@register("digit_sum", f"SELECT doc_id, {sql_digit_sum('text')} AS digit_sum FROM documents")
def q_digit_sum(spark, d):
    return table(spark, d, "documents").select("doc_id", digit_sum("text").alias("digit_sum"))


@register("limit_length", "SELECT doc_id, substring(text, 1, 250) AS text FROM documents")
def q_limit_length(spark, d):
    return table(spark, d, "documents").select("doc_id", limit_length("text", 250).alias("text"))
