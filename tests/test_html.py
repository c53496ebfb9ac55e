from pyspark.sql import functions as F

from dimetl.sources.pages import page_extract, page_links

# Listing page as described in FIXTURES.md section 5 (invented sample).
PAGE = (
    '<meta property="og:url" content="http://x/y"><ul class="caret-list multi-columns">'
    "<li>Preço: <strong>250 000,00 €</strong></li><li>Certificado energético: <strong>B</strong></li>"
    "<li>Tipo de estacionamento: <strong>2 Box Fechada</strong></li></ul>"
    '<ul class="tags-list"><li>Garden</li><li>Pool</li></ul>'
    "<img class=\"img_mapa\" onclick=\"open('?query=41.15,-8.61')\">"
)

ICON_PAGE = (
    '<title>Flat “T2”</title><div class="bloco-caracteristicas"><ul>'
    '<li><span title="Bedrooms"></span><span class="num">3</span></li>'
    '<li><span title="Bathroom"></span><span class="num">2</span></li>'
    '<li><span title="Energ. Cert.: A+"></span></li></ul></div>'
    '<span id="ctl00_ContentPlaceHolder1_lbl_imovel_show_ref">REF-9</span>'
    '<a href="/a">a</a><a href="http://h/b">b</a>'
)


def test_listing_page(spark):
    df = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    r = page_extract(df).first()
    assert r["price"] == 250000.0
    assert r["energy_certificate"] == "B"
    assert r["parking_spaces"] == 2
    assert list(r["amenities"]) == ["Garden", "Pool"]
    assert (r["latitude"], r["longitude"]) == (41.15, -8.61)
    assert r["listing_url"] == "http://x/y"


def test_icon_page(spark):
    df = spark.createDataFrame([(2, "u", ICON_PAGE)], "page_id long, url string, html string")
    r = page_extract(df).first()
    assert (r["bedrooms"], r["bathrooms"]) == ("3", "2")
    assert r["energy_certificate"] == "A+"
    assert r["id"] == "REF-9"
    assert r["title"] == "Flat T2"
    links = [(x["link_pos"], x["href"]) for x in page_links(df).orderBy("link_pos").collect()]
    assert links == [(0, "/a"), (1, "http://h/b")]


def test_malformed_page_gives_nulls(spark):
    df = spark.createDataFrame([(3, "u", "<li><strong>unclosed"), (4, "u", None)], "page_id long, url string, html string")
    rows = page_extract(df).collect()
    for r in rows:
        assert r["price"] is None and r["latitude"] is None and r["title"] is None


def test_odd_markup(spark):
    from dimetl.functions import html as H

    page = (
        "<title>A &amp; B</title><h1>A <b>B</b></h1><meta content='c' property='og:title'>"
        "<ul class='x caret-list'><li>Vista: <strong>Bom estado geral</strong><li class=\"y\">Estado: <strong>Venda</strong></li></ul>"
    )
    h = F.lit(page)
    r = spark.range(1).select(
        H.tag_text(h, "title").alias("t"), H.tag_text(h, "h1").alias("h"), H.meta_content(h, "og:title").alias("m"),
        H.label_value(H.details(h), "Estado").alias("e"),
    ).first()
    assert (r["t"], r["h"], r["m"], r["e"]) == ("A & B", "A B", "c", "Venda")


def test_index_page_links(spark):
    from dimetl.functions import html as H
    from dimetl.sources.pages import index_links

    page = (
        "<a id='logo' href='/home'>x</a><table id='ctl00_ContentPlaceHolder1_DataList_imoveis'><a id='l1' href='/a'>1</a>"
        "<a href='/no-id'>2</a><a href=\"/b\" id=\"l2\">3</a></table><a id='ctl00_ContentPlaceHolder1_lnkNext' href='/p2'>next</a>"
    )
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    got = [(r["page_id"], r["listing_url"]) for r in index_links(df, "http://s").orderBy("link_pos").collect()]
    assert got == [(1, "http://s/a"), (1, "http://s/b")]
    assert [r["n"] for r in df.orderBy("page_id").select(H.next_page("html").alias("n")).collect()] == ["/p2", None, None]


def test_nested_like_tags_and_references(spark):
    from dimetl.functions import html as H

    page = (
        "<!-- <span id='x'>no</span> --><script>var a = \"<span id='x'>no</span>\";</script>"
        "<span id='x' title='1 > 0'>a <span>b <span>c</span></span> d &#8364;&#x20AC;&eacute;&nbsp;&unknown;&#0;&#xD800;& e</span> f"
        "<ul class='tags-list'><li>one<ul><li>two</li></ul> three</li><li>four<li>five &lt;b&gt;</ul><ul class='tags-list'><li>six</li></ul>"
        "<table id='t'><tr><td><table><tr><td>in</td></tr></table>out</td></tr></table>"
    )
    h = F.col("html")
    df = spark.createDataFrame([(page,), ("<span id='x'>never ends <b>",), ("",), (None,), ("< <a title=\"broken>x</a> <span id=x>",)], "html string")
    rows = df.select(
        H.element_text(h, "span", "id", "x").alias("x"), H.amenities(h).alias("a"), H.element_text(h, "table", "id", "t").alias("t"), H.tag_text(h, "a").alias("l")
    ).collect()
    assert rows[0]["x"] == "a b c d €€é &unknown;&#0;&#xD800;& e"
    assert list(rows[0]["a"]) == ["onetwo three", "four", "five <b>"] and rows[0]["t"] == "inout"
    assert [r["x"] for r in rows[1:]] == [None] * 4 and [list(r["a"] or []) for r in rows[1:]] == [[]] * 4
    assert rows[4]["l"] == "x"


def test_long_pages(spark):
    from dimetl.functions import html as H

    deep = "<div>" * 3000 + "<div id='d'>" + "<div>x" * 500 + "</div>" * 500 + "</div>" + "</div>" * 3000
    wide = "<ul class='tags-list'>" + "".join(f"<li>i{n}</li>" for n in range(3000)) + "</ul>" + "<p>" * 20000
    big = "<p " + "a='1' " * 5000 + "id='d'>" + "word " * 200000 + "</p>"
    df = spark.createDataFrame([(deep,), (wide,), (big,)], "html string")
    h = F.col("html")
    rows = df.select(H.element_text(h, "div", "id", "d").alias("d"), F.size(H.amenities(h)).alias("n"), F.length(H.element_text(h, "p", "id", "d")).alias("p")).collect()
    assert (rows[0]["d"], rows[1]["n"], rows[2]["p"]) == ("x" * 500, 3000, 999999)


def test_a_lookup_splits_a_page_once(spark):
    from dimetl.functions import html as H

    h, df = F.col("html"), spark.createDataFrame([(PAGE,)], "html string")
    lookups = [H.element_map(h), H.tag_text(h, "title"), H.details(h), H.indicator_items(h), H.amenities(h), H.listing_links(h), H.next_page(h)]
    for found in lookups:
        plan = df.select(found.alias("found"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(html") == 1


def test_a_page_is_split_once(spark):
    df = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    plan = page_extract(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(html") == 1


def test_a_split_page_holds_its_tokens_alone(spark):
    from dimetl.functions import html as H

    page = "a < b &lt; <!-- <p id='x'>no</p> --><P id='x' class='num'>A < &amp;<br/> B</P><SPAN title='<meta property=\"og:url\">'></SPAN><meta property='og:url' content='u'>"
    split = spark.createDataFrame([(page,)], "html string").select(H.tokens("html").alias("t"))
    # Names and texts are read where a lookup asks for them, not kept for every token.
    assert split.dtypes == [("t", "array<string>")]
    h = H.Tokens(F.col("t"))
    r = split.select(H.text_of(F.col("t")).alias("all"), H.tag_text(h, "p").alias("p"), H.tag_text(h, "br").alias("br"), H.meta_content(h, "og:url").alias("m")).first()
    assert (r["all"], r["p"], r["br"], r["m"]) == ("a < b < A < & B", None, None, "u")
