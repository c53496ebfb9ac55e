"""Projections of the driver tables onto the two subject models.

The driver tables hold no songs or listings, so each model is a projection of
them (same rules in Spark and in the DuckDB oracle text below):

``a_events``   events ⋈ customer: a listening log; 'purchase' plays 'NextSong'.
``a_play``     lineitem ⋈ orders ⋈ part ⋈ customer: plays with title, artist,
               duration; session = order, item = line; returned lines are 'Home'
               page views; every tenth part is logged under an unknown title.
               Titles number the parts in fifties, so they grow with them.
``a_song``     part: one song per part; artist = brand.
``a_listing``  customer ⋈ nation ⋈ region ⋈ supplier: every customer, or one
               weekly snapshot per order year (a listing is on the market in
               snapshot k when its customer ordered in year 1997 + k); price
               changes when ``c_custkey % 3 = k``.  Some 15 customers share a
               broker (supplier).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.operators.filters import slice_of
from dimetl.session import apply_runtime_conf

SNAPSHOT_BASE_YEAR = 1997
SNAPSHOT_DATES = ["2024-01-01", "2024-01-08", "2024-01-15"]
API_PAGE_SIZE = 50
CUSTOMERS_PER_SUPPLIER = 15
PARTS_PER_TITLE = 50
#: Customers whose pages one task builds and reads: AQE would join such small rows in one task.
CUSTOMERS_PER_TASK = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------- Spark


def dealt(df: DataFrame, rows: int, per_task: int, *by: str | Column) -> DataFrame:
    """``df`` dealt by hash over as many tasks as ``rows`` need at ``per_task`` each; a given count is not joined by AQE."""
    return df.repartition(max(1, -(-rows // per_task)), *by)


def a_events(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    cu = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    ts = F.col("ts").cast("timestamp")
    purchase = F.col("event_type") == "purchase"
    return ev.join(cu, ev.user_id == cu.c_custkey, "left").select(
        "event_id",
        ts.alias("start_time"),
        F.unix_millis(ts).alias("ts_ms"),
        "user_id",
        F.when(purchase, F.lit("NextSong")).otherwise(F.col("event_type")).alias("page"),
        F.when(purchase, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.col("user_id") * 1000 + F.dayofyear(ts)).alias("session_id"),
        F.col("event_id").alias("item_in_session"),
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("location"),
        F.concat(F.lit("agent/"), F.col("event_type")).alias("user_agent"),
        "value",
    )


def _title() -> Column:
    """Song title of a part: its name and a number that some tens of parts share, so titles grow with the parts."""
    return F.concat("p_name", F.lit(" "), F.floor(F.col("p_partkey") / PARTS_PER_TITLE).cast("string"))


def a_play(spark: SparkSession, d: str, part: tuple[int, int] | None = None) -> DataFrame:
    """``part``: the orders of slice ``i`` of ``n``; they meet their customers before the lines, which are shuffled once less so."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")
    od = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    pt = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    cu = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    song = F.when(F.col("l_partkey") % 10 == 0, F.lit("missing")).otherwise(_title())
    if part is None:
        j = (
            li.join(od, li.l_orderkey == od.o_orderkey)
            .join(pt, li.l_partkey == pt.p_partkey)
            .join(cu, od.o_custkey == cu.c_custkey, "left")
        )
    else:
        od = slice_of(od, ["o_orderkey"], part).join(cu, od.o_custkey == cu.c_custkey, "left")
        lines = slice_of(li, ["l_orderkey"], part).join(pt, li.l_partkey == pt.p_partkey).withColumn("song", song)
        j, song = lines.join(od, F.col("l_orderkey") == F.col("o_orderkey")), F.col("song")
    ts_ms = (
        F.unix_millis(F.col("l_shipdate").cast("timestamp"))
        + (F.col("l_orderkey") % 86400) * 1000
        + F.col("l_linenumber")
    )
    return j.select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_linenumber").alias("item_in_session"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        F.col("p_brand").alias("artist"),
        song.alias("song"),
        F.col("p_retailprice").alias("length"),
        ts_ms.alias("ts_ms"),
        F.timestamp_millis(ts_ms).alias("start_time"),
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("location"),
        F.concat(F.lit("agent/"), F.col("l_linestatus")).alias("user_agent"),
        F.when(F.col("l_returnflag") == "R", F.lit("Home")).otherwise(F.lit("NextSong")).alias("page"),
        F.col("c_acctbal").alias("registration"),
    )


def a_song(spark: SparkSession, d: str) -> DataFrame:
    pt = table(spark, d, "part")
    return pt.select(
        F.lit(1).cast("bigint").alias("num_songs"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("SO"), F.col("p_partkey").cast("string")).alias("song_id"),
        _title().alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


def a_listing(spark: SparkSession, d: str, k: int | None = None) -> DataFrame:
    """Raw listing attributes (text, as crawled) of all customers, or of snapshot ``k``; plus ``c_custkey``."""
    cu = table(spark, d, "customer")
    na = table(spark, d, "nation")
    rg = table(spark, d, "region")
    su = table(spark, d, "supplier").select("s_suppkey", "s_name")
    if k is not None:
        od = table(spark, d, "orders").where(F.year("o_orderdate") == SNAPSHOT_BASE_YEAR + k).select("o_custkey")
        cu = cu.join(od, cu.c_custkey == od.o_custkey, "left_semi")
    c = (
        cu.join(na, cu.c_nationkey == na.n_nationkey)
        .join(rg, na.n_regionkey == rg.r_regionkey)
        .join(su, su.s_suppkey == F.floor(cu.c_custkey / CUSTOMERS_PER_SUPPLIER), "left")
    )
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint") + F.when(F.col("c_custkey") % 3 == (k or 0), F.lit(100)).otherwise(F.lit(0))
    a = F.abs(cents)
    price_text = F.concat(
        F.when(cents < 0, F.lit("-")).otherwise(F.lit("")),
        ((a - a % 100) / 100).cast("bigint").cast("string"),
        F.lit(","),
        F.lpad((a % 100).cast("string"), 2, "0"),
        F.lit(" €"),
    )
    return c.select(
        "c_custkey",
        F.col("s_name").alias("Broker"),
        F.col("c_name").alias("ContractNumber"),
        F.col("r_name").alias("Country"),
        F.col("n_name").alias("County"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("Parish"),
        F.concat(F.lit("<b>"), F.col("c_mktsegment"), F.lit("</b> listing “"), F.col("c_name"), F.lit("”")).alias("Title"),
        F.concat(
            F.lit("<p>Listing of <a href=\"/c/"), F.col("c_custkey").cast("string"), F.lit("\">"), F.col("c_name"),
            F.lit("</a> in <i>"), F.col("n_name"), F.lit("</i></p>"),
        ).alias("Description"),
        price_text.alias("PriceCurrencyFormated"),
        F.col("c_mktsegment").alias("PropertyType"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit(None).cast("string")).otherwise((F.col("c_nationkey") % 3 + 1).cast("string")).alias("Bathrooms"),
        (F.col("c_nationkey") % 5 + 1).cast("string").alias("Bedrooms"),
        (F.col("c_custkey") % 200 + 50).cast("string").alias("AreaNet"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".5")).alias("Latitude"),
        F.concat(F.lit("-"), F.col("n_regionkey").cast("string"), F.lit(".25")).alias("Longitude"),
        F.concat(
            F.col("r_name"), F.lit(", "), F.col("n_name"), F.lit(" (Distrito), "), F.col("c_mktsegment"),
            F.lit(", Parish "), F.col("c_nationkey").cast("string"), F.lit(", City"),
        ).alias("FullLocation"),
        (F.col("c_custkey") % 300 + 60).cast("string").alias("AreaGross"),
        F.concat(F.lit("/photos/"), F.col("c_custkey").cast("string"), F.lit(".jpg")).alias("Photo"),
        F.concat(F.lit("buy/"), F.lower("n_name"), F.lit("/"), F.col("c_custkey").cast("string")).alias("URLSEOv2"),
    )


def a_listing_page(spark: SparkSession, d: str) -> DataFrame:
    """Stored listing pages in two layouts: one per listing of ``a_listing``, with decoys, odd quoting and missing fields."""
    # A few customer file splits grow into many pages: they are dealt out before they are built.
    c = dealt(a_listing(spark, d), table(spark, d, "customer").count(), CUSTOMERS_PER_TASK, "c_custkey")
    key = F.col("c_custkey").cast("string")
    q = F.when(F.col("c_custkey") % 3 == 1, F.lit("'")).otherwise(F.lit('"'))

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def meta(prop: str, value: Column) -> Column:
        forward = text("<meta property=", q, prop, q, " content=", q, value, q, ">")
        return F.when(F.col("c_custkey") % 3 == 0, text("<meta content=", q, value, q, " property=", q, prop, q, "/>")).otherwise(forward)

    def span(name: str, value: Column) -> Column:
        full = f"ctl00_ContentPlaceHolder1_lbl_imovel_show_{name}"
        # A like tag nested in front of the value, and one after it.
        return F.coalesce(text("<span class='v' id=", q, full, q, "><span class='i'></span><b>", value, "</b><span> </span></span>"), F.lit(""))

    def icon(title: str, value: Column) -> Column:
        return F.coalesce(text("<li class='i'><span title=", q, title, q, "></span> <span class=", q, "big num", q, ">", value, "</span></li>"), F.lit(""))

    # The currency sign as a numeric reference, decimal or hexadecimal.
    sign = F.when(F.col("c_custkey") % 4 < 2, F.lit("&#8364;")).otherwise(F.lit("&#x20aC;"))
    price = F.regexp_replace("PriceCurrencyFormated", "€", sign)
    energy = F.substring(F.lit("ABCDE"), (F.col("c_custkey") % 5 + 1).cast("int"), F.lit(1))
    parking = (F.col("c_custkey") % 4).cast("string")
    head = text(
        "<!DOCTYPE html><html><head><title>Home &amp; “", F.col("ContractNumber"), "”</title>",
        meta("og:url", text("http://listings.example/", key)), meta("og:title", F.col("PropertyType")), meta("og:image", F.col("Photo")),
        "</head><body><ul><li>Estado: <strong>menu</strong></li></ul><span title=\"Bedrooms\"></span><span class=\"num\">99</span>",
        "<a href=\"?query=0.0,0.0\">map</a><h1 class=t>Flat <b>", F.col("ContractNumber"), "</b></h1>",
    )
    icons = text(
        span("ref", F.col("ContractNumber")), span("finalidade", F.lit("Venda")), span("tipo_imovel", F.col("PropertyType")),
        span("preco_venda", price), span("distrito", F.col("County")), span("concelho", F.col("Country")),
        span("freguesia", F.col("Parish")), span("area_bruta", F.col("AreaGross")),
        "<div class=", q, "bloco-caracteristicas row", q, "><ul>", icon("Bedrooms", F.col("Bedrooms")), icon("Bathroom", F.col("Bathrooms")),
        icon("Parking", parking), "<li><span title=", q, "Energ. Cert.: ", energy, q, "></span></li></ul></div>",
    )
    details = text(
        "<div class='property-details-list'><ul class=", q, "caret-list multi-columns", q, "><li class=\"p\">Preço: <strong>", price,
        "</strong></li><li>Vista: <strong>Bom estado geral</strong><ul class='caret-list'><li>Estado: <strong>mar</strong></li></ul><li>Estado: <strong>Arrendamento</strong></li>",
        "<li>Certificado energético: <strong>", energy, "</strong></li><li>Tipo de estacionamento: <strong>", parking, " Box + 1</strong></li></ul></div>",
        "<ul class=", q, "tags-list", q, "><li>", F.col("County"), "<!-- <li>not one</li> --></li><li class='a'><i>Pool</i> &amp; <ul><li>Sauna</li></ul></li></ul>",
    )
    foot = text("<img src='m.png' class=", q, "img_mapa", q, " onclick=\"open('?query=", F.col("Latitude"), ",", F.col("Longitude"), "')\"></body></html>")
    body = F.when(F.col("c_custkey") % 2 == 0, icons).otherwise(details)
    return c.select(F.col("c_custkey").alias("page_id"), text("http://listings.example/", key).alias("url"), text(head, body, foot).alias("html"))


INDEX_PAGE_SIZE = 20


def a_index_page(spark: SparkSession, d: str) -> DataFrame:
    """Index pages of ``INDEX_PAGE_SIZE`` customers each: a results table with nested tables, other links, a paging link."""
    c = table(spark, d, "customer").select("c_custkey")
    row = F.concat(
        F.lit("<tr><td><table><tr><td><a href='/map/"), F.col("c_custkey"), F.lit("'>map</a></td></tr></table><a title='a > b' id='l"), F.col("c_custkey"),
        F.lit("' href=\"/buy/"), F.col("c_custkey"), F.lit("?a=1&amp;b=2\">x</a></td></tr>"),
    )
    page = F.floor(F.col("c_custkey") / INDEX_PAGE_SIZE).cast("bigint")
    # The pages are built where their customers are dealt to.
    by_page = dealt(c.withColumn("page_id", page), c.count(), CUSTOMERS_PER_TASK, "page_id")
    rows = by_page.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("c_custkey", row.alias("r")))).alias("rows"), F.max("c_custkey").alias("last"))
    last = c.agg(F.max(page).alias("last_page"))
    body = F.concat(
        F.lit("<html><body><a id='logo' href='/home'>home</a><table id='ctl00_ContentPlaceHolder1_DataList_imoveis'>"),
        F.array_join(F.transform("rows", lambda x: x["r"]), ""),
        F.lit("</table><table><tr><td><a id='other' href='/other'>o</a></td></tr></table><a id=\"ctl00_ContentPlaceHolder1_lnkNext\""),
        F.when(F.col("page_id") < F.col("last_page"), F.concat(F.lit(" href='/index/"), F.col("page_id") + 1, F.lit("'"))).otherwise(F.lit("")),
        F.lit(">next</a></body></html>"),
    )
    return rows.join(last).select("page_id", body.alias("html"))


def log_json_frame(ev: DataFrame) -> DataFrame:
    """``a_events`` in the player's JSON layout (camelCase, epoch-ms ``ts``, text ``userId``)."""
    return ev.select(
        F.lit(None).cast("string").alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("first_name").alias("firstName"),
        "gender",
        F.col("item_in_session").alias("itemInSession"),
        F.col("last_name").alias("lastName"),
        F.col("value").alias("length"),
        "level",
        "location",
        F.lit("PUT").alias("method"),
        "page",
        F.lit(None).cast("double").alias("registration"),
        F.col("session_id").alias("sessionId"),
        F.lit(None).cast("string").alias("song"),
        F.lit(200).alias("status"),
        F.col("ts_ms").alias("ts"),
        F.col("user_agent").alias("userAgent"),
        F.col("user_id").cast("string").alias("userId"),
    )


def play_log_json_frame(play: DataFrame) -> DataFrame:
    """``a_play`` in the player's JSON layout (camelCase, epoch-ms ``ts``, text ``userId``)."""
    return play.select(
        "artist",
        F.lit("Logged In").alias("auth"),
        F.col("first_name").alias("firstName"),
        "gender",
        F.col("item_in_session").cast("bigint").alias("itemInSession"),
        F.col("last_name").alias("lastName"),
        "length",
        "level",
        "location",
        F.lit("PUT").alias("method"),
        "page",
        "registration",
        F.col("session_id").alias("sessionId"),
        "song",
        F.lit(200).alias("status"),
        F.col("ts_ms").alias("ts"),
        F.col("user_agent").alias("userAgent"),
        F.col("user_id").cast("string").alias("userId"),
    )


def csv_event_frame(play: DataFrame) -> DataFrame:
    """``a_play`` in the CSV export layout (17 text columns; blank song fields on non-plays)."""
    is_play = F.col("page") == "NextSong"

    def s(c):
        return F.col(c).cast("string")

    return play.select(
        F.when(is_play, F.col("artist")).otherwise(F.lit("")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("first_name").alias("firstName"),
        "gender",
        s("item_in_session").alias("itemInSession"),
        F.col("last_name").alias("lastName"),
        F.when(is_play, s("length")).otherwise(F.lit("")).alias("length"),
        "level",
        "location",
        F.lit("PUT").alias("method"),
        "page",
        s("registration").alias("registration"),
        s("session_id").alias("sessionId"),
        F.when(is_play, F.col("song")).otherwise(F.lit("")).alias("song"),
        F.lit("200").alias("status"),
        s("ts_ms").alias("ts"),
        s("user_id").alias("userId"),
    )


# -------------------------------------------------------------------- DuckDB

SQL_A_EVENTS = """a_events AS (
  SELECT e.event_id, e.ts AS start_time, epoch_us(e.ts) // 1000 AS ts_ms, e.user_id,
    CASE WHEN e.event_type = 'purchase' THEN 'NextSong' ELSE e.event_type END AS page,
    CASE WHEN e.event_type = 'purchase' THEN 'paid' ELSE 'free' END AS level,
    c.c_name AS first_name, c.c_mktsegment AS last_name,
    CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    e.user_id * 1000 + dayofyear(e.ts) AS session_id,
    e.event_id AS item_in_session,
    'nation-' || CAST(c.c_nationkey AS VARCHAR) AS location,
    'agent/' || e.event_type AS user_agent, e.value
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)"""

SQL_A_PLAY = """a_play AS (
  SELECT l.l_orderkey AS session_id, l.l_linenumber AS item_in_session, o.o_custkey AS user_id,
    c.c_name AS first_name, c.c_mktsegment AS last_name,
    CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'paid' ELSE 'free' END AS level,
    p.p_brand AS artist,
    CASE WHEN l.l_partkey % 10 = 0 THEN 'missing' ELSE p.p_name || ' ' || CAST(p.p_partkey // 50 AS VARCHAR) END AS song,
    p.p_retailprice AS length,
    epoch_ms(l.l_shipdate) + (l.l_orderkey % 86400) * 1000 + l.l_linenumber AS ts_ms,
    make_timestamp((epoch_ms(l.l_shipdate) + (l.l_orderkey % 86400) * 1000 + l.l_linenumber) * 1000) AS start_time,
    'nation-' || CAST(c.c_nationkey AS VARCHAR) AS location,
    'agent/' || l.l_linestatus AS user_agent,
    CASE WHEN l.l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page,
    c.c_acctbal AS registration
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

SQL_A_SONG = """a_song AS (
  SELECT CAST(1 AS BIGINT) AS num_songs, p_brand AS artist_id, CAST(p_size AS DOUBLE) AS artist_latitude,
    CAST(NULL AS DOUBLE) AS artist_longitude, p_type AS artist_location, p_brand AS artist_name,
    'SO' || CAST(p_partkey AS VARCHAR) AS song_id, p_name || ' ' || CAST(p_partkey // 50 AS VARCHAR) AS title, p_retailprice AS duration, p_size AS year
  FROM part)"""


def sql_a_listing(k: int | None) -> str:
    kept = "" if k is None else f" WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = {SNAPSHOT_BASE_YEAR + k})"
    return f"""a_listing{'' if k is None else k} AS (
  SELECT c.c_custkey, s.s_name AS Broker, c.c_name AS ContractNumber, r.r_name AS Country, n.n_name AS County,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE c.c_mktsegment END AS Parish,
    '<b>' || c.c_mktsegment || '</b> listing “' || c.c_name || '”' AS Title,
    '<p>Listing of <a href="/c/' || CAST(c.c_custkey AS VARCHAR) || '">' || c.c_name || '</a> in <i>' || n.n_name || '</i></p>' AS Description,
    (CASE WHEN cents < 0 THEN '-' ELSE '' END) || CAST(abs(cents) // 100 AS VARCHAR) || ','
      || lpad(CAST(abs(cents) % 100 AS VARCHAR), 2, '0') || ' €' AS PriceCurrencyFormated,
    c.c_mktsegment AS PropertyType,
    CASE WHEN c.c_nationkey % 4 = 0 THEN NULL ELSE CAST(c.c_nationkey % 3 + 1 AS VARCHAR) END AS Bathrooms,
    CAST(c.c_nationkey % 5 + 1 AS VARCHAR) AS Bedrooms,
    CAST(c.c_custkey % 200 + 50 AS VARCHAR) AS AreaNet,
    CAST(c.c_nationkey AS VARCHAR) || '.5' AS Latitude,
    '-' || CAST(n.n_regionkey AS VARCHAR) || '.25' AS Longitude,
    r.r_name || ', ' || n.n_name || ' (Distrito), ' || c.c_mktsegment || ', Parish ' || CAST(c.c_nationkey AS VARCHAR) || ', City' AS FullLocation,
    CAST(c.c_custkey % 300 + 60 AS VARCHAR) AS AreaGross, '/photos/' || CAST(c.c_custkey AS VARCHAR) || '.jpg' AS Photo,
    'buy/' || lower(n.n_name) || '/' || CAST(c.c_custkey AS VARCHAR) AS URLSEOv2
  FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) + CASE WHEN c_custkey % 3 = {k or 0} THEN 100 ELSE 0 END AS cents
        FROM customer{kept}) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey // {CUSTOMERS_PER_SUPPLIER})"""


SQL_LOG_JSON = """a_log_json AS (
  SELECT CAST(NULL AS VARCHAR) AS artist, 'Logged In' AS auth, first_name AS firstName, gender,
    item_in_session AS itemInSession, last_name AS lastName, value AS length, level, location, 'PUT' AS method,
    page, CAST(NULL AS DOUBLE) AS registration, session_id AS sessionId, CAST(NULL AS VARCHAR) AS song,
    CAST(200 AS INTEGER) AS status, ts_ms AS ts, user_agent AS userAgent, CAST(user_id AS VARCHAR) AS userId
  FROM a_events)"""

SQL_CSV_EVENTS = """a_csv AS (
  SELECT CASE WHEN page = 'NextSong' THEN artist ELSE '' END AS artist, 'Logged In' AS auth,
    first_name AS firstName, gender, CAST(item_in_session AS VARCHAR) AS itemInSession, last_name AS lastName,
    CASE WHEN page = 'NextSong' THEN CAST(length AS VARCHAR) ELSE '' END AS length, level, location,
    'PUT' AS method, page, CAST(registration AS VARCHAR) AS registration, CAST(session_id AS VARCHAR) AS sessionId,
    CASE WHEN page = 'NextSong' THEN song ELSE '' END AS song, '200' AS status, CAST(ts_ms AS VARCHAR) AS ts,
    CAST(user_id AS VARCHAR) AS userId
  FROM a_play)"""

# Dependencies between the oracle views.
_SQL_VIEWS: dict[str, tuple[str, list[str]]] = {
    "a_events": (SQL_A_EVENTS, []),
    "a_play": (SQL_A_PLAY, []),
    "a_song": (SQL_A_SONG, []),
    "a_log_json": (SQL_LOG_JSON, ["a_events"]),
    "a_csv": (SQL_CSV_EVENTS, ["a_play"]),
    "a_listing": (sql_a_listing(None), []),
    **{f"a_listing{k}": (sql_a_listing(k), []) for k in range(3)},
}


def register_view(name: str, sql: str, deps: list[str] | None = None) -> None:
    _SQL_VIEWS[name] = (sql, list(deps or []))


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named oracle views and their dependencies, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in _SQL_VIEWS[n][1]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(_SQL_VIEWS[n][0] for n in ordered) + "\n"
