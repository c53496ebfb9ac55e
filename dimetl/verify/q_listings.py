"""Listing model queries: cleaning, staging, SCD2 dimensions, stock fact, calendar."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.functions.keys import row_hash
from dimetl.functions.text import (
    fill_missing,
    parse_price,
    parse_price_text,
    remove_unicode,
    rename_mapped,
    rename_snake,
    split_location,
)
from dimetl.functions.time import calendar_columns, date_spine_between
from dimetl.operators import quality as Q
from dimetl.operators.filters import const_columns
from dimetl.operators.scd2 import Scd2Table, scd2_apply, scd2_bulk, scd2_close, scd2_open
from dimetl.plans import listings as L
from dimetl.schemas import DIMENSIONS, LISTING_ATTRIBUTES, OPEN_END_DATE
from dimetl.session import scratch_path
from dimetl.sources.pages import API_FIELD_MAP, listing_explode
from dimetl.verify.adapters import API_PAGE_SIZE, SNAPSHOT_DATES, a_listing, register_view, table, with_views
from dimetl.verify.registry import register
from dimetl.verify.sqlfn import sql_hash_key, sql_sha256

# ------------------------------------------------------------------ Spark


def raw(spark, d, k=None):
    return a_listing(spark, d, k).select(*LISTING_ATTRIBUTES)


def clean(spark, d, k):
    return L.clean_listings(raw(spark, d, k))


def empty_dim(spark, staging, id_column):
    schema = T.StructType(
        [T.StructField(id_column, T.StringType())]
        + list(staging.schema.fields)
        + [T.StructField("record_start_date", T.DateType()), T.StructField("record_end_date", T.DateType())]
    )
    return spark.createDataFrame([], schema)


STAGING_BUILDERS = {
    "dim_broker": L.staging_broker,
    "dim_geography": L.staging_geography,
    "dim_asset": L.staging_asset,
}


def staged(spark, d, dim, k):
    return STAGING_BUILDERS[dim](clean(spark, d, k))


def cleaned_snapshots(spark, d, n=3):
    """Each cleaned snapshot staged once as Parquet (shared by all dimensions and the fact)."""
    out = {}
    for k in range(n):
        path = scratch_path(spark, f"clean{k}")
        clean(spark, d, k).write.parquet(path)
        out[k] = spark.read.parquet(path)
    return out


def dim_after(spark, d, dim, loads):
    """In-plan replay of ``loads`` snapshot loads (whole table after the last)."""
    spec = DIMENSIONS[dim]
    target = None
    for k in range(loads):
        s = staged(spark, d, dim, k)
        if target is None:
            target = empty_dim(spark, s, spec.id_column)
        target = scd2_apply(target, s, spec.match_columns, SNAPSHOT_DATES[k], spec.id_column)
    return target


def dim_stored(spark, d, dim, loads):
    """Replay through the Parquet store (lineage cut at every load)."""
    spec = DIMENSIONS[dim]
    store = Scd2Table(spark, scratch_path(spark, dim), spec.match_columns, spec.id_column)
    for k in range(loads):
        store.load(staged(spark, d, dim, k), SNAPSHOT_DATES[k])
    return store.read()


# ----------------------------------------------------------------- oracle

TRACKED = {
    "dim_broker": ["broker"],
    "dim_geography": ["country", "county", "parish"],
    "dim_asset": DIMENSIONS["dim_asset"].tracked_columns,
}
KEYS = {n: DIMENSIONS[n].match_columns for n in DIMENSIONS}
IDS = {n: DIMENSIONS[n].id_column for n in DIMENSIONS}

PRICE_RE = "^([^,€$£]+)"


def sql_strip_tags(e: str) -> str:
    """Anchors are protected with chr(1), every other tag on one line removed, anchors restored."""
    protect = f"regexp_replace({e}, '<(/?a[>\\t\\n\\x0B\\f\\r ])', chr(1) || '\\1', 'g')"
    strip = f"regexp_replace({protect}, '<[^>\\n\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]*>', '', 'g')"
    return f"replace({strip}, chr(1), '<')"


def sql_num(e: str) -> str:
    t = f"TRY_CAST({e} AS DOUBLE)"
    return f"COALESCE(CASE WHEN {t} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {t} END, -1)"


def sql_clean(k: int) -> str:
    price = f"NULLIF(regexp_extract(replace(PriceCurrencyFormated, ' ', ''), '{PRICE_RE}', 1), '')"
    return f"""clean{k} AS (
  SELECT COALESCE(Broker, 'Unknown') AS broker, ContractNumber AS contract_number,
    COALESCE(Country, 'Unknown') AS country, COALESCE(County, 'Unknown') AS county, COALESCE(Parish, 'Unknown') AS parish,
    substring({sql_strip_tags("COALESCE(Title, 'Unknown')")}, 1, 250) AS title,
    substring({sql_strip_tags("COALESCE(Description, 'Unknown')")}, 1, 250) AS description,
    {sql_num(price)} AS price, COALESCE(PropertyType, 'Unknown') AS property_type,
    {sql_num('Bathrooms')} AS bathrooms, {sql_num('Bedrooms')} AS bedrooms, {sql_num('AreaNet')} AS area_net,
    {sql_num('Latitude')} AS latitude, {sql_num('Longitude')} AS longitude
  FROM a_listing{k})"""


def sql_staging(dim: str, k: int) -> str:
    cols = TRACKED[dim]
    c = ", ".join(cols)
    return f"stg_{dim}{k} AS (SELECT {c}, {sql_sha256(*cols)} AS hash FROM (SELECT DISTINCT {c} FROM clean{k}))"


def sql_stock(k: int) -> str:
    return (
        f"stock{k} AS (SELECT broker, contract_number, country, county, parish, price, CAST(1 AS INTEGER) AS quantity, "
        f"DATE '{SNAPSHOT_DATES[k]}' AS stock_date FROM clean{k})"
    )


def sql_dim_closed_form(dim: str, loads: int) -> str:
    """SCD2 rows after ``loads`` loads: change points of the hash per key, end = next start - 1."""
    keys = ", ".join(KEYS[dim])
    cols = ", ".join(TRACKED[dim])
    snaps = " UNION ALL ".join(f"SELECT *, DATE '{SNAPSHOT_DATES[k]}' AS d FROM stg_{dim}{k}" for k in range(loads))
    return f"""scd_{dim}{loads} AS (
  SELECT {sql_hash_key(*KEYS[dim], 'd')} AS {IDS[dim]}, {cols}, hash, d AS record_start_date,
    COALESCE(CAST(lead(d) OVER (PARTITION BY {keys} ORDER BY d) - INTERVAL 1 DAY AS DATE), DATE '{OPEN_END_DATE}') AS record_end_date
  FROM (SELECT *, lag(hash) OVER (PARTITION BY {keys} ORDER BY d) AS prev FROM ({snaps}))
  WHERE prev IS NULL OR prev <> hash)"""


for _k in range(3):
    register_view(f"clean{_k}", sql_clean(_k), [f"a_listing{_k}"])
    register_view(f"stock{_k}", sql_stock(_k), [f"clean{_k}"])
    for _dim in TRACKED:
        register_view(f"stg_{_dim}{_k}", sql_staging(_dim, _k), [f"clean{_k}"])
for _dim in TRACKED:
    for _n in (1, 2, 3):
        register_view(f"scd_{_dim}{_n}", sql_dim_closed_form(_dim, _n), [f"stg_{_dim}{k}" for k in range(_n)])


def _sel(view: str, cols: str = "*") -> str:
    return with_views(view) + f"SELECT {cols} FROM {view}"


# -------------------------------------------------------- sources, renames

RAW_COLS = ", ".join(LISTING_ATTRIBUTES)


@register(
    "listing_explode",
    with_views("a_listing")
    + f"SELECT CAST(c_custkey // {API_PAGE_SIZE} AS INTEGER) AS current_page, "
    + ", ".join(
        f"'https://listings.example/' || {src} AS {dst}" if dst == "listing_url" else f"{src} AS {dst}" for src, dst in API_FIELD_MAP.items()
    ) + ", 'Example Homes' AS broker, 'Portugal' AS country FROM a_listing",
)
def q_listing_explode(spark, d):
    lst = a_listing(spark, d)
    props = F.struct(*[F.col(c) for c in LISTING_ATTRIBUTES + ["FullLocation", "AreaGross", "Photo", "URLSEOv2"]])
    pages = lst.groupBy((F.col("c_custkey") / API_PAGE_SIZE).cast("bigint").alias("page")).agg(
        F.collect_list(props).alias("Properties")
    )
    api = pages.select(
        F.to_json(F.struct(F.col("page").cast("int").alias("CurrentPage"), F.col("Properties"))).alias("body")
    )
    return listing_explode(api, site="https://listings.example", constants={"broker": "Example Homes", "country": "Portugal"})


@register(
    "fill_missing",
    with_views("a_listing")
    + "SELECT " + ", ".join(
        f"{sql_num(c)} AS {c}" if c in L.NUMERIC_ATTRIBUTES else
        (f"COALESCE({c}, 'Unknown') AS {c}" if c in L.TEXTUAL_ATTRIBUTES else c)
        for c in LISTING_ATTRIBUTES
    ) + " FROM a_listing",
)
def q_fill_missing(spark, d):
    return fill_missing(raw(spark, d), L.NUMERIC_ATTRIBUTES, L.TEXTUAL_ATTRIBUTES)


def _snake(c: str) -> str:
    from dimetl.functions.text import snake_case

    return snake_case(c)


@register(
    "rename_snake",
    with_views("a_listing") + "SELECT " + ", ".join(f"{c} AS {_snake(c)}" for c in LISTING_ATTRIBUTES) + " FROM a_listing",
)
def q_rename_snake(spark, d):
    return rename_snake(raw(spark, d))


@register(
    "rename_mapped",
    with_views("a_listing") + "SELECT " + ", ".join(f"{s} AS {t}" for s, t in API_FIELD_MAP.items()) + " FROM a_listing",
)
def q_rename_mapped(spark, d):
    return rename_mapped(a_listing(spark, d), API_FIELD_MAP)


@register(
    "const_columns",
    with_views("a_listing")
    + "SELECT ContractNumber, Broker, CAST(1 AS INTEGER) AS quantity, 'Portugal' AS country_name FROM a_listing",
)
def q_const_columns(spark, d):
    return const_columns(a_listing(spark, d).select("ContractNumber", "Broker"), {"quantity": 1, "country_name": "Portugal"})


@register(
    "split_location",
    with_views("a_listing")
    + "SELECT ContractNumber, "
    + ", ".join(
        f"trim(regexp_extract(string_split(FullLocation, ',')[{i}], '^[^(]+', 0)) AS {n}"
        for i, n in ((2, "district"), (3, "county"), (4, "parish"))
    )
    + " FROM a_listing",
)
def q_split_location(spark, d):
    lst = a_listing(spark, d)
    return lst.select("ContractNumber", split_location("FullLocation").alias("loc")).select("ContractNumber", "loc.*")


@register(
    "parse_price",
    with_views("a_listing")
    + "SELECT ContractNumber, PriceCurrencyFormated, "
    f"COALESCE(NULLIF(regexp_extract(replace(PriceCurrencyFormated, ' ', ''), '{PRICE_RE}', 1), ''), 'Unknown') AS price_text, "
    f"TRY_CAST(NULLIF(regexp_extract(replace(PriceCurrencyFormated, ' ', ''), '{PRICE_RE}', 1), '') AS DOUBLE) AS price "
    "FROM a_listing",
)
def q_parse_price(spark, d):
    lst = a_listing(spark, d)
    return lst.select("ContractNumber", "PriceCurrencyFormated", parse_price_text("PriceCurrencyFormated").alias("price_text"),
                      parse_price("PriceCurrencyFormated").alias("price"))


@register(
    "remove_unicode",
    with_views("a_listing") + "SELECT ContractNumber, translate(Title, '“”❤️', '') AS title FROM a_listing",
)
def q_remove_unicode(spark, d):
    return a_listing(spark, d).select("ContractNumber", remove_unicode("Title").alias("title"))


@register(
    "row_hash",
    "SELECT c_custkey, " + sql_sha256("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment") + " AS hash FROM customer",
)
def q_row_hash(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", row_hash("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").alias("hash"))


# ---------------------------------------------------------------- staging


@register("listing_staging_broker", _sel("stg_dim_broker0"))
def q_stg_broker(spark, d):
    return L.staging_broker(clean(spark, d, 0))


@register("listing_staging_geography", _sel("stg_dim_geography0"))
def q_stg_geography(spark, d):
    return L.staging_geography(clean(spark, d, 0))


@register("listing_staging_asset", _sel("stg_dim_asset0"))
def q_stg_asset(spark, d):
    return L.staging_asset(clean(spark, d, 0))


@register("listing_staging_stock", _sel("stock0"), dates=("stock_date",))
def q_stg_stock(spark, d):
    return L.staging_stock(clean(spark, d, 0), SNAPSHOT_DATES[0])


# ------------------------------------------------------------------- SCD2

ASSET_OUT = ", ".join(["asset_id", *TRACKED["dim_asset"], "hash", "record_start_date", "record_end_date"])


@register(
    "scd2_close",
    with_views("scd_dim_asset1", "stg_dim_asset1")
    + "SELECT t.asset_id, " + ", ".join(f"t.{c}" for c in TRACKED["dim_asset"]) + ", t.hash, t.record_start_date, "
    f"DATE '{SNAPSHOT_DATES[1]}' - INTERVAL 1 DAY AS record_end_date "
    "FROM scd_dim_asset1 t JOIN stg_dim_asset1 s ON t.contract_number = s.contract_number WHERE t.hash <> s.hash",
    dates=("record_start_date", "record_end_date"),
)
def q_scd2_close(spark, d):
    target = dim_after(spark, d, "dim_asset", 1)
    return scd2_close(target, staged(spark, d, "dim_asset", 1), ["contract_number"], SNAPSHOT_DATES[1])


@register(
    "scd2_open",
    with_views("scd_dim_asset1", "stg_dim_asset1")
    + "SELECT " + sql_hash_key("s.contract_number", f"DATE '{SNAPSHOT_DATES[1]}'") + " AS asset_id, s.*, "
    f"DATE '{SNAPSHOT_DATES[1]}' AS record_start_date, DATE '{OPEN_END_DATE}' AS record_end_date "
    "FROM stg_dim_asset1 s LEFT JOIN scd_dim_asset1 t ON t.contract_number = s.contract_number "
    f"AND t.record_end_date = DATE '{OPEN_END_DATE}' WHERE t.hash IS NULL OR t.hash <> s.hash",
    dates=("record_start_date", "record_end_date"),
)
def q_scd2_open(spark, d):
    target = dim_after(spark, d, "dim_asset", 1)
    return scd2_open(target, staged(spark, d, "dim_asset", 1), ["contract_number"], SNAPSHOT_DATES[1], "asset_id")


@register("scd2_merge", _sel("scd_dim_asset2", ASSET_OUT), dates=("record_start_date", "record_end_date"))
def q_scd2_merge(spark, d):
    return dim_after(spark, d, "dim_asset", 2).select(*ASSET_OUT.split(", "))


@register("scd2_three_loads", _sel("scd_dim_asset3", ASSET_OUT), dates=("record_start_date", "record_end_date"))
def q_scd2_three_loads(spark, d):
    return dim_stored(spark, d, "dim_asset", 3).select(*ASSET_OUT.split(", "))


def sql_same_day() -> str:
    """Two loads on the first date (the later one wins where it names a key), the third snapshot on the second."""
    one = f"SELECT * FROM stg_dim_asset1 UNION ALL SELECT * FROM stg_dim_asset0 a WHERE NOT EXISTS (SELECT 1 FROM stg_dim_asset1 b WHERE a.contract_number IS NOT DISTINCT FROM b.contract_number)"
    snaps = f"SELECT *, DATE '{SNAPSHOT_DATES[0]}' AS d FROM ({one}) UNION ALL SELECT *, DATE '{SNAPSHOT_DATES[1]}' FROM stg_dim_asset2"
    cols = ", ".join(TRACKED["dim_asset"])
    return f"""SELECT {sql_hash_key('contract_number', 'd')} AS asset_id, {cols}, hash, d AS record_start_date,
  COALESCE(CAST(lead(d) OVER (PARTITION BY contract_number ORDER BY d) - INTERVAL 1 DAY AS DATE), DATE '{OPEN_END_DATE}') AS record_end_date
FROM (SELECT *, lag(hash) OVER (PARTITION BY contract_number ORDER BY d) AS prev FROM ({snaps})) WHERE prev IS NULL OR prev <> hash"""


@register(
    "scd2_same_day",
    with_views("stg_dim_asset0", "stg_dim_asset1", "stg_dim_asset2") + sql_same_day(),
    dates=("record_start_date", "record_end_date"),
)
def q_scd2_same_day(spark, d):
    """A version opened and replaced on one day, then closed by a later load: the replaced one is no history."""
    store = Scd2Table(spark, scratch_path(spark, "dim_same_day"), KEYS["dim_asset"], IDS["dim_asset"])
    for k, day in ((0, 0), (1, 0), (2, 1)):
        store.load(staged(spark, d, "dim_asset", k), SNAPSHOT_DATES[day])
    return store.read().select(*ASSET_OUT.split(", "))


@register("scd2_bulk", _sel("scd_dim_asset3", ASSET_OUT), dates=("record_start_date", "record_end_date"))
def q_scd2_bulk(spark, d):
    snaps = None
    for k in range(3):
        s = staged(spark, d, "dim_asset", k).withColumn("snapshot_date", F.lit(SNAPSHOT_DATES[k]).cast("date"))
        snaps = s if snaps is None else snaps.unionByName(s)
    return scd2_bulk(snaps, ["contract_number"], "snapshot_date", "asset_id").select(*ASSET_OUT.split(", "))


@register(
    "dq_scd2_unique",
    with_views("scd_dim_asset3", "scd_dim_broker3", "scd_dim_geography3")
    + " UNION ALL ".join(
        f"SELECT 'scd2_unique' AS check_name, '{dim}' AS subject, count(*) AS observed, CAST(0 AS BIGINT) AS expected, "
        f"count(*) = 0 AS passed FROM (SELECT {', '.join(KEYS[dim])} FROM scd_{dim}3 "
        f"WHERE record_end_date = DATE '{OPEN_END_DATE}' GROUP BY ALL HAVING count(*) > 1)"
        for dim in ("dim_asset", "dim_broker", "dim_geography")
    ),
)
def q_dq_scd2_unique(spark, d):
    dims = ("dim_asset", "dim_broker", "dim_geography")
    cleans = cleaned_snapshots(spark, d)
    tables = L.load_dimensions(
        spark, scratch_path(spark, "dims"), dims, lambda dim, k: STAGING_BUILDERS[dim](cleans[k]), SNAPSHOT_DATES
    )
    return Q.dq_scd2_unique({dim: (tables[dim], KEYS[dim]) for dim in dims})


@register(
    "dq_scd2_overlap",
    with_views("scd_dim_asset3")
    + f""", planted AS (
  SELECT contract_number, record_start_date, CASE WHEN contract_number LIKE '%7' THEN DATE '{OPEN_END_DATE}' ELSE record_end_date END AS record_end_date
  FROM scd_dim_asset3),
v AS (SELECT *, lead(record_start_date) OVER (PARTITION BY contract_number ORDER BY record_start_date) AS nxt FROM planted),
c AS (SELECT 'planted' AS subject, count(*) FILTER (nxt <= record_end_date) AS n FROM v UNION ALL SELECT 'stored', 0)
SELECT 'scd2_overlap' AS check_name, subject, n AS observed, CAST(0 AS BIGINT) AS expected, n = 0 AS passed FROM c""",
)
def q_dq_scd2_overlap(spark, d):
    """The stored dimension has no overlap; with the ends of some closed versions put off, all of those are found."""
    dim = dim_stored(spark, d, "dim_asset", 3)
    late = F.when(F.col("contract_number").like("%7"), F.lit(OPEN_END_DATE).cast("date")).otherwise(F.col("record_end_date"))
    keys = KEYS["dim_asset"]
    return Q.dq_scd2_overlap({"stored": (dim, keys), "planted": (dim.withColumn("record_end_date", late), keys)})


@register(
    "dq_staging_keys",
    with_views("clean0")
    + "SELECT 'unique_keys' AS check_name, 'by_contract' AS subject, count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed "
    "FROM (SELECT contract_number FROM clean0 GROUP BY 1 HAVING count(*) > 1) UNION ALL "
    "SELECT 'unique_keys', 'by_broker', count(*), 0, count(*) = 0 FROM (SELECT broker FROM clean0 GROUP BY 1 HAVING count(*) > 1) UNION ALL "
    "SELECT 'null_keys', 'by_contract', count(*) FILTER (contract_number IS NULL), 0, count(*) FILTER (contract_number IS NULL) = 0 FROM clean0",
)
def q_dq_staging_keys(spark, d):
    """Key gates of the staging rows: contract numbers are unique, brokers (as a key of listings) are not."""
    rows = clean(spark, d, 0)
    return Q.dq_suite(
        Q.dq_unique_keys({"by_contract": (rows, ["contract_number"]), "by_broker": (rows, ["broker"])}),
        Q.dq_null_keys({"by_contract": (rows, ["contract_number"])}),
    )


# ------------------------------------------------------------------- fact


SQL_FACT_STOCK = (
    with_views("stock2", "scd_dim_asset3", "scd_dim_broker3", "scd_dim_geography3")
    + "SELECT " + sql_hash_key("f.broker", "f.contract_number", "f.stock_date") + " AS id, b.broker_id, a.asset_id, g.geography_id, "
    "f.price, f.quantity, CAST(strftime(f.stock_date, '%Y%m%d') AS INTEGER) AS date_id FROM stock2 f "
    "LEFT JOIN scd_dim_asset3 a ON f.contract_number IS NOT DISTINCT FROM a.contract_number AND a.record_start_date <= f.stock_date AND a.record_end_date >= f.stock_date "
    "LEFT JOIN scd_dim_broker3 b ON f.broker = b.broker AND b.record_start_date <= f.stock_date AND b.record_end_date >= f.stock_date "
    "LEFT JOIN scd_dim_geography3 g ON f.country = g.country AND f.county = g.county AND f.parish = g.parish "
    "AND g.record_start_date <= f.stock_date AND g.record_end_date >= f.stock_date"
)


@register("fact_stock", SQL_FACT_STOCK)
def q_fact_stock(spark, d):
    cleans = cleaned_snapshots(spark, d)
    dims = L.load_dimensions(
        spark, scratch_path(spark, "dims"), ("dim_broker", "dim_asset", "dim_geography"),
        lambda dim, k: STAGING_BUILDERS[dim](cleans[k]), SNAPSHOT_DATES,
    )
    stock = L.staging_stock(cleans[2], SNAPSHOT_DATES[2])
    return L.fact_stock(stock, dims["dim_broker"], dims["dim_asset"], dims["dim_geography"])


STOCK_KEYS = "broker, contract_number"


@register(
    "fact_new_stock",
    with_views("stock0", "stock1") + f"SELECT * FROM stock1 WHERE ({STOCK_KEYS}) NOT IN (SELECT ({STOCK_KEYS}) FROM stock0)",
    dates=("stock_date",),
)
def q_new_stock(spark, d):
    return L.new_stock(L.staging_stock(clean(spark, d, 1), SNAPSHOT_DATES[1]), L.staging_stock(clean(spark, d, 0), SNAPSHOT_DATES[0]))


@register(
    "fact_deleted_stock",
    with_views("stock0", "stock1") + f"SELECT * FROM stock0 WHERE ({STOCK_KEYS}) NOT IN (SELECT ({STOCK_KEYS}) FROM stock1)",
    dates=("stock_date",),
)
def q_deleted_stock(spark, d):
    return L.deleted_stock(L.staging_stock(clean(spark, d, 1), SNAPSHOT_DATES[1]), L.staging_stock(clean(spark, d, 0), SNAPSHOT_DATES[0]))


@register(
    "fact_price_oscillations",
    with_views("stock0", "stock1")
    + "SELECT c.broker, c.contract_number, p.stock_date AS previous_date, p.price AS previous_price, "
    "c.stock_date AS current_date, c.price AS current_price FROM stock1 c JOIN stock0 p "
    "ON c.broker = p.broker AND c.contract_number = p.contract_number WHERE c.price <> p.price",
    dates=("previous_date", "current_date"),
)
def q_price_osc(spark, d):
    return L.price_oscillations(L.staging_stock(clean(spark, d, 1), SNAPSHOT_DATES[1]), L.staging_stock(clean(spark, d, 0), SNAPSHOT_DATES[0]))


# --------------------------------------------------------------- calendar


@register(
    "dim_date",
    "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, strftime(d, '%Y-%m-%d') AS full_date, "
    "CAST(year(d) AS INTEGER) AS year_number, CAST(week(d) AS INTEGER) AS week_iso_number, "
    "CAST(dayofyear(d) AS INTEGER) AS day_number, CAST(quarter(d) AS INTEGER) AS quarter_number, "
    "CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, "
    "CAST(dayofweek(d) + 1 AS INTEGER) AS weekday_number, dayname(d) AS day_name, "
    "CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS is_weekday, "
    "CASE WHEN last_day(d) = d THEN 1 ELSE 0 END AS is_last_of_month "
    "FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)",
)
def q_dim_date(spark, d):
    """Calendar over the span of the fact dates (the spine grows with the calendar span, not the rows)."""
    li = table(spark, d, "lineitem")
    bounds = li.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    return date_spine_between(bounds, "lo", "hi").select(*calendar_columns("full_date")).orderBy("date_id")


@register(
    "dim_date_spine",
    "SELECT CAST(row_number() OVER (ORDER BY d) AS BIGINT) AS position, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, "
    "CAST(week(d) AS INTEGER) AS week_iso_number, coalesce(n, 0) AS n_orders FROM "
    f"(SELECT CAST(lo + to_days(CAST(i AS INTEGER)) AS DATE) AS d FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo FROM orders), range({L.CALENDAR_DAYS + 1}) t(i)) "
    "LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)",
)
def q_dim_date_spine(spark, d):
    """The calendar of 10,951 days from the first order on, in its stored order, with the orders of each day."""
    orders = table(spark, d, "orders")
    first = orders.agg(F.min(F.col("o_orderdate").cast("date")).cast("string")).first()[0]
    path = scratch_path(spark, "calendar")
    # One file keeps the order in which the calendar hands its rows over.
    L.dim_date(spark, first, L.CALENDAR_DAYS).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path).select((F.col("_metadata.row_index") + 1).alias("position"), "date_id", "week_iso_number")
    counts = orders.groupBy(F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd").cast("int").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return stored.join(counts, F.col("date_id") == F.col("day"), "left").select(
        "position", "date_id", "week_iso_number", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@register("date_id", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id FROM orders")
def q_date_id(spark, d):
    from dimetl.functions.time import date_id

    return table(spark, d, "orders").select("o_orderkey", date_id("o_orderdate").alias("date_id"))


SQL_WEEKS_FACT = SQL_FACT_STOCK.replace(
    with_views("stock2", "scd_dim_asset3", "scd_dim_broker3", "scd_dim_geography3"),
    with_views("stock0", "stock1", "stock2", "scd_dim_asset3", "scd_dim_broker3", "scd_dim_geography3"),
).replace(" FROM stock2 f ", " FROM (SELECT * FROM stock0 UNION ALL SELECT * FROM stock1 UNION ALL SELECT * FROM stock2) f ")


@register("listing_week_job", SQL_WEEKS_FACT)
def q_listing_week_job(spark, d):
    """Three weekly loads end to end: raw listing JSON -> staging -> SCD2 stores -> stock fact."""
    from dimetl.plans.jobs import run_listing_week

    out = scratch_path(spark, "listing_wh")
    paths = None
    for k, day in enumerate(SNAPSHOT_DATES):
        raw_path = scratch_path(spark, f"listing_raw{k}")
        a_listing(spark, d, k).drop("c_custkey").write.json(raw_path)
        paths = run_listing_week(spark, raw_path, out, day)
    return spark.read.parquet(paths["fact_stock"])
