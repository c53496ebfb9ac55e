import datetime as dt

from pyspark.sql import functions as F

from dimetl.functions import keys as K
from dimetl.functions import text as X
from dimetl.functions import time as TM


def one(spark, value, expr, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_strip_tags_keeps_anchors(spark):
    html = 'T2 <b>flat</b> <a href="/x">link</a> <br/>end <abbr>x</abbr>'
    assert one(spark, html, X.strip_tags("v")) == 'T2 flat <a href="/x">link</a> end x'


def test_strip_tags_does_not_cross_lines(spark):
    assert one(spark, "a <b\nc> d", X.strip_tags("v")) == "a <b\nc> d"


def test_limit_length(spark):
    assert one(spark, "abcdef", X.limit_length("v", 3)) == "abc"
    assert one(spark, None, X.limit_length("v", 3)) is None


def test_remove_unicode(spark):
    assert one(spark, "“quoted” ❤️ ok", X.remove_unicode("v")) == "quoted  ok"


def test_parse_price(spark):
    assert one(spark, "250 000,00 €", X.parse_price("v")) == 250000.0
    assert one(spark, "€ on request", X.parse_price_text("v")) == "Unknown"
    assert one(spark, "€ on request", X.parse_price("v")) is None
    assert one(spark, "$1200", X.parse_price_text("v")) == "Unknown"
    assert one(spark, "1200$", X.parse_price("v")) == 1200.0


def test_split_location(spark):
    r = one(spark, "Portugal, Porto (Distrito), Maia, Moreira, Moreira", X.split_location("v"))
    assert (r["district"], r["county"], r["parish"]) == ("Porto", "Maia", "Moreira")
    r = one(spark, "Portugal, Lisboa", X.split_location("v"))
    assert (r["district"], r["county"], r["parish"]) == ("Lisboa", None, None)


def test_digit_sum(spark):
    assert one(spark, "2 Box + 1 lugar", X.digit_sum("v")) == 3
    assert one(spark, "none", X.digit_sum("v")) == 0
    assert one(spark, None, X.digit_sum("v")) is None


def test_snake_case():
    assert X.snake_case("PriceCurrencyFormated") == "price_currency_formated"
    assert X.snake_case("AreaNet") == "area_net"
    assert X.snake_case("already_snake") == "already_snake"


def test_fill_missing_casts_before_fill(spark):
    df = spark.createDataFrame([("3", None), (None, "x"), ("oops", None)], "n string, t string")
    out = X.fill_missing(df, ["n"], ["t"]).collect()
    assert [r["n"] for r in out] == [3.0, -1.0, -1.0]
    assert [r["t"] for r in out] == ["Unknown", "x", "Unknown"]


def test_clean_strings(spark):
    df = spark.createDataFrame([("", "   ", "abcdef")], "a string, b string, c string")
    r = X.clean_strings(df, {"c": 3}).first()
    assert r["a"] is None and r["b"] is None and r["c"] == "abc"


def test_row_hash_tells_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    h = [r["h"] for r in df.select(K.row_hash("x", "y").alias("h")).collect()]
    assert h[0] != h[1]


def test_hash_key_is_deterministic_and_wide(spark):
    df = spark.createDataFrame([("k1", dt.date(2024, 1, 1))] * 2, "k string, d date")
    ids = {r["i"] for r in df.select(K.hash_key("k", "d").alias("i")).collect()}
    assert len(ids) == 1 and len(next(iter(ids))) == 32
    pairs = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), ("a|", "|b|c"), ("a\\", "b")], "x string, y string")
    assert pairs.select(K.hash_key("x", "y").alias("i")).distinct().count() == 4


def test_weekday_conventions(spark):
    d = dt.date(2024, 1, 7)  # a Sunday
    df = spark.createDataFrame([(d,)], "d date")
    r = df.select(TM.weekday("d", "sunday0").alias("a"), TM.weekday("d", "sunday1").alias("b"),
                  TM.weekday("d", "name").alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (0, 1, "Sunday")


def test_iso_year_and_week(spark):
    df = spark.createDataFrame([(dt.date(2018, 12, 31),)], "d date")
    r = df.select(TM.iso_year("d").alias("y"), TM.iso_week("d").alias("w"), TM.date_id("d").alias("i")).first()
    assert (r["y"], r["w"], r["i"]) == (2019, 1, 20181231)


def test_epoch_ms(spark):
    df = spark.createDataFrame([(1541121934796,)], "ts long")
    r = df.select(TM.epoch_ms_to_ts("ts").alias("a"), TM.epoch_ms_to_ts_seconds("ts").alias("b")).first()
    assert r["a"].microsecond == 796000 and r["b"].microsecond == 0


def test_date_spine_length(spark):
    from dimetl.plans.listings import dim_date

    cal = dim_date(spark)
    assert cal.count() == 10951
    last = cal.agg(F.max("full_date")).first()[0]
    assert last == "2047-12-25"
    r = cal.where(F.col("full_date") == "2018-01-31").first()
    assert r["is_last_of_month"] == 1 and r["weekday_number"] == 4 and r["is_weekday"] == 1


def test_fill_missing_canonical_zero(spark):
    df = spark.createDataFrame([("-0",), ("0",)], "n string")
    out = X.fill_missing(df, ["n"], []).withColumn("h", K.row_hash("n")).collect()
    assert out[0]["h"] == out[1]["h"] and str(out[0]["n"]) == "0.0"
