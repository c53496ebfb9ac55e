"""Top-k search, page extraction and chat formatting against brute force."""

import hashlib
import json
import time
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimetl.llm import chat_format, dom, maxscore, wrappers

# --------------------------------------------------------------- top-k


def brute_top(rows, k, asks):
    usable = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[n] = (i, [math.floor(1024 * x) for x in v])
    out = []
    for q in sorted({i for i, _ in usable.values() if asks(i)}):
        x = next(v for i, v in usable.values() if i == q)
        found = sorted((-sum(a * b for a, b in zip(x, v, strict=False)), i) for i, v in usable.values() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard", "queries"), [(8192, 4096), (40, 3)])
def test_top_k_equals_brute_force(spark, shard, queries):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(12) * (1 + i % 5)).astype(float).tolist()) for i in range(-50, 250)]
    rows += [(300, rows[60][1]), (301, rows[60][1]), (302, None), (303, [1.0, None]), (304, [float("nan")] * 12), (305, [float("inf")] * 12), (None, rows[3][1]), (306, []), (307, [2.0])]
    df = spark.createDataFrame([(i, v, 7, "s") for i, v in rows], "vec_id long, embedding array<double>, rank int, v string").repartition(4)
    vectors = maxscore.integer_vectors(df, "vec_id", "embedding")
    got = maxscore.top_k(vectors.filter(F.col("id") % 25 == 0), vectors, shard_rows=shard, query_rows=queries)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, lambda i: i % 25 == 0)
    assert maxscore.top_k(vectors.limit(0), vectors).count() == 0
    assert maxscore.top_k(vectors, vectors.limit(0)).count() == 0


def test_large_components_take_part(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(60, [7e4, 0.0, -1.5]), (61, [-3e5, 1e5 + 0.25, 2.0]), (62, [0.0] * 5 + [2.0**31]), (70, [1e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = maxscore.integer_vectors(df, "vec_id", "embedding")
    got = maxscore.top_k(vectors.filter(F.col("id") % 10 == 0), vectors, shard_rows=25, query_rows=3)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, lambda i: i % 10 == 0)
    two = maxscore.integer_vectors(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    with pytest.raises(Exception, match="does not fit a long"):
        maxscore.top_k(two, two).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 6), st.integers(0, 10**6))
def test_blocks_with_small_tiles_are_exact(n, width, seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-3, 4, (n, width)).astype(float)
    ids = rng.permutation(n)
    got = maxscore.search_block(ids[:2], v[:2], ids, v, 4, tile=3)
    want = []
    for q, x in zip(ids[:2].tolist(), v[:2], strict=True):
        want += [(q, i, -s) for s, i in sorted((-int(x @ y), int(i)) for i, y in zip(ids, v, strict=True) if i != q)[:4]]
    assert [tuple(map(int, g)) for g in got] == want


def test_bars_leave_out_only_lower_scores():
    rng = np.random.default_rng(8)
    v = rng.integers(-3, 4, (400, 5)).astype(float)
    ids = rng.permutation(400)
    free = maxscore.search_block(ids[:20], v[:20], ids, v, 6, tile=50)
    bars = np.array([min(s for q, _, s in free if q == i) for i in ids[:20].tolist()], float)
    assert maxscore.search_block(ids[:20], v[:20], ids, v, 6, tile=50, bars=bars) == free
    assert maxscore.search_block(ids[:20], v[:20], ids, v, 6, tile=50, bars=np.full(20, 1e9)) == []


def test_repeated_query_ids_and_equal_rows_over_shards(spark):
    """The smallest of a repeated id's vectors asks; repeated rows rank as rows, in every shard."""
    rows = [(0, [1.0, 2.0]), (0, [3.0, -1.0]), *[(7, [2.0, 2.0])] * 25, *((i, [i / 8, -i / 16]) for i in range(20, 60))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    vectors = maxscore.integer_vectors(df, "vec_id", "embedding")
    got = maxscore.top_k(vectors.filter(F.col("id") % 10 == 0), vectors, shard_rows=9, query_rows=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, lambda i: i % 10 == 0)


def test_weak_dimensions_cannot_lift_a_vector():
    essential, weak = maxscore.split_terms(np.array([5.0, 1.0, 3.0, 1.0]), 4.5)
    assert set(weak) == {1, 3} and set(essential) == {0, 2}


# --------------------------------------------------------------- pages

MENU = '<nav><ul><li><a href="/{0}">{0}</a></ul></nav><header><h2>Site {0}</h2></header><div class="ad">Buy {0}</div>'
TAIL = '<aside>See also {0}</aside><div id="comments"><p>I like {0}</p></div><form><input><p>Name {0}</form><footer>&copy; {0}</footer><script>var a="</p>";</script>'


def page(n, body):
    return f"<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style></head><body>{MENU.format(n)}{body}{TAIL.format(n)}</body></html>"


def test_article_text_without_the_zones(spark):
    rows, want = [], {}
    for n in range(60):
        host = f"host{n % 3}.example"
        paras = [f"Para {n}.{k} &amp; more\n  words" for k in range(n % 4)]
        inner = f"<h1>Title {n}</h1>" + "".join(f"<p>{p}</p>" if k % 2 else f"<p><b>{p}<br>" for k, p in enumerate(paras))
        body = {0: f"<article>{inner}</article>", 1: f'<div class="wrap"><div class="post post-{n}">{inner}</div></div>', 2: f"<main>{inner}</main>"}[n % 3]
        rows.append((n, f"https://{host}/a/{n}", page(n, body), "x"))
        want[n] = "\n".join([f"Title {n}", *(f"Para {n}.{k} & more words" for k in range(n % 4))])
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    for size in (wrappers.BROADCAST_CHARS, 0):
        got = wrappers.extract_pages(df, broadcast_chars=size).collect()
        assert {r.page_id: r.text for r in got} == want
        assert all(r.n_chars == len(r.text) for r in got)


def test_constant_text_of_many_pages_is_template():
    shapes = [wrappers.shape_of(dom.parse(f"<body><div class=a><div class=tag>All rights reserved</div><p>Text {n}</p></div></body>")) for n in range(30)]
    template = shapes[0]
    for s in shapes[1:]:
        template = wrappers.merge(template, s)
    wrapper = json.dumps(wrappers.wrapper_of(template))
    assert wrappers.main_text("<body><div class=a><div class=tag>All rights reserved</div><p>New</p></div></body>", wrapper) == "New"


def test_copies_on_a_small_host_keep_their_text():
    one = wrappers.shape_of(dom.parse("<body><p>same words</p></body>"))
    template = wrappers.merge(wrappers.merge(one, one), one)
    assert wrappers.main_text("<body><p>same words</p></body>", json.dumps(wrappers.wrapper_of(template))) == "same words"


def wrapper_over(htmls):
    template = None
    for h in htmls:
        shape = wrappers.shape_of(dom.parse(h))
        template = shape if template is None else wrappers.merge(template, shape)
    return json.dumps(wrappers.wrapper_of(template))


@pytest.mark.parametrize("form", [
    "<div class=intro><p>Lead {0}</p></div><div class=story><p>{1}</p></div>", "<div class=page><h1>Lead {0}</h1><div class=body><p>{1}</p></div></div>",
    "<h1>Lead {0}</h1><article><p>{1}</p></article>",
])
def test_text_beside_the_story_container_is_kept(form):
    pages = [f"<body><nav>Menu</nav>{form.format(n, f'story {n} ' * 30)}<footer>Foot {n}</footer></body>" for n in range(30)]
    assert wrappers.main_text(pages[3], wrapper_over(pages)) == "Lead 3\n" + ("story 3 " * 30).strip()


ARTICLE_PARTS = [
    '<h2 id="related-work">Related {0}</h2>', '<h2 id="how-to-search">How {0}</h2>', '<h2 class="search">Find {0}</h2>', '<section id="social-impact">Impact {0}</section>',
    '<div id="ad-hoc-networks">Ad hoc {0}</div>', '<pre>x = {0} <span class="hljs-comment"># note {0}</span></pre>', '<p>a {0} <span class="comment">b {0}</span></p>',
]


@pytest.mark.parametrize("part", ARTICLE_PARTS)
def test_names_inside_the_article_lose_no_text(part):
    pages = [f"<body><article><p>Text {n}</p>{part.format(n)}<div class='ad'>Buy {n}</div></article></body>" for n in range(30)]
    plain = wrappers.main_text(f"<body>{part.format(3)}</body>".replace("comment", "x").replace("search", "x"), None)
    assert wrappers.main_text(pages[3], wrapper_over(pages)) == f"Text 3\n{plain}"


COMPOUNDS = ["comment-list", "comments-area", "reader_comments", "sidebar-left", "cookie-banner", "site-notice", "related-posts", "post_sidebar col"]


@pytest.mark.parametrize("name", COMPOUNDS)
@pytest.mark.parametrize("form", ["<article><p>{text}</p></article>{zone}", "<div class='post-body'><h1>{n}</h1><p>{text}</p></div>{zone}"])
def test_compound_names_tell_zones_beside_the_article(name, form):
    pages = [f"<body><div class='with-sidebar'>{form.format(n=n, text=f'Text {n} ' * 20, zone=f'<div class={name!r}><p>Varying {n}</p></div>')}</div></body>" for n in range(30)]
    text = ("Text 3 " * 20).strip()
    assert wrappers.main_text(pages[3], wrapper_over(pages)) == (text if "article" in form else f"3\n{text}")


def test_compound_names_without_support_or_around_the_content_lose_no_text():
    once = [f"<body><div class=a><p>Text {n}</p></div>{'<div class=related-posts><p>Kept</p></div>' if n == 3 else ''}</body>" for n in range(30)]
    assert wrappers.main_text(once[3], wrapper_over(once)) == "Text 3\nKept"
    around = [f"<body><div class='content-sidebar'><p>Text {n} and more of it</p></div><div class=x><p>Less {n}</p></div></body>" for n in range(30)]
    assert wrappers.main_text(around[3], wrapper_over(around)) == "Text 3 and more of it\nLess 3"
    inside = [f"<body><article><p>Text {n}</p><div class='related-work'>Work {n}</div><div class='ad-hoc'>Net {n}</div><div class='comment-list'>Me {n}</div></article></body>" for n in range(30)]
    assert wrappers.main_text(inside[3], wrapper_over(inside)) == "Text 3\nWork 3\nNet 3"


def links(words, n):
    return "<ul>" + "".join(f"<li><a href=/{n}/{k}>{words} {n} {k}</a></li>" for k in range(4)) + "</ul>"


def test_link_lists_are_left_out_beside_the_content_only():
    zone = "<div class=more-stories><h3>More {n}</h3>{list}</div>"
    pages = [
        f"<body><div class=post><p>{f'Text {n} ' * 40}</p><div class=sources>{links('Source', n)}</div></div>{zone.format(n=n, list=links('Another story', n))}"
        f"<div class=note><p>By author {n}, see <a href=/>here</a></p></div></body>" for n in range(30)
    ]
    want = [("Text 3 " * 40).strip(), *(f"Source 3 {k}" for k in range(4)), "By author 3, see here"]
    assert wrappers.main_text(pages[3], wrapper_over(pages)).split("\n") == want
    flat = [f"<body><p>{f'Text {n} ' * 40}</p>{links('Source', n)}</body>" for n in range(30)]
    assert wrappers.main_text(flat[3], wrapper_over(flat)).split("\n") == [want[0], *want[1:5]]


NO_NAMES = [("more-stories", True), ("x7", True), ("related-posts", False), ("cookie-banner", False), ("comments-area", False), ("sidebar-left", False)]


@pytest.mark.parametrize("size, precision, recall", [(2, 0.85, 0.95), (5, 0.95, 0.85), (40, 0.95, 0.95), (200, 0.95, 0.95)])
def test_blocks_of_generated_hosts(size, precision, recall):
    """Every block of the pages of generated hosts, whose zones stand in one order and miss on some pages, is labelled.

    On hosts of two pages a zone that one page lacks has no support; on hosts of a few pages a shared paragraph soon stands on half of them.
    """
    rng = np.random.default_rng(size)
    kept = right = wanted = 0
    for host in range(6):
        form = ["<article>{}</article>", "<div class=post-body>{}</div>", "<main><div class=c1>{}</div></main>"][host % 3]
        shared = [f"Paragraph {host} {k} that many articles of the host share." for k in range(5)]
        pages, good, order = [], [], [NO_NAMES[k] for k in rng.permutation(len(NO_NAMES))]
        for n in range(size):
            body = [f"Title {host} {n}", *(f"Own paragraph {host} {n} {k} " + "with some words " * int(rng.integers(2, 9)) for k in range(int(rng.integers(3, 8))))]
            body += [t for t in shared if rng.random() < 0.3]
            zones = "".join(
                f"<div class={name}>{links(f'Zone {name}', n) if linked else f'<p>Zone {name} {n}</p>'}</div>" for name, linked in order if rng.random() < 0.9
            )
            pages.append(f"<body><nav>Zone menu</nav>{form.format(''.join(f'<p>{t}</p>' for t in body))}{zones}<footer>Zone foot</footer></body>")
            good.append([" ".join(t.split()) for t in body])
        wrapper = wrapper_over(pages)
        for html, want in zip(pages, good, strict=True):
            got = wrappers.main_text(html, wrapper).split("\n")
            kept, wanted = kept + len(got), wanted + len(want)
            right += sum(t in want for t in got)
    assert right / kept >= precision
    assert right / wanted >= recall


def test_a_name_counts_with_support_of_the_host():
    pages = [f"<body><article><p>Text {n}</p>{'<section class=social>Society</section>' if n == 3 else ''}</article><div class='box share'>Share {n}</div></body>" for n in range(30)]
    assert wrappers.main_text(pages[3], wrapper_over(pages)) == "Text 3\nSociety"


def test_one_differing_page_leaves_the_others_text_constant():
    pages = [f"<body><div class=a><p>Text {n}</p></div><div class=b>(c) {2025 if n == 7 else 2024}</div></body>" for n in range(40)]
    wrapper = wrapper_over(pages)
    assert [wrappers.main_text(pages[n], wrapper) for n in (3, 7)] == ["Text 3", "Text 7\n(c) 2025"]


def test_constant_siblings_of_varying_text_are_template():
    pages = [f"<body><div>Home About</div><div><p>Share this</p><p>Text {n}</p><p>More {n} of <b>it</b></p></div><div>Imprint</div></body>" for n in range(30)]
    assert wrappers.main_text(pages[3], wrapper_over(pages)) == "Text 3\nMore 3 of it"


def test_template_is_told_from_copies_by_contents_not_by_a_page_count():
    form = "<body><div>Home</div><article><p>{0}</p></article><div>Imprint</div></body>"
    small = [form.format(f"Text {n}") for n in range(3)]
    assert wrappers.main_text(small[1], wrapper_over(small)) == "Text 1"
    copies = [form.format("same words")] * 60 + [form.format(f"Text {n}") for n in range(5)]
    assert wrappers.main_text(copies[0], wrapper_over(copies)) == "same words"


def test_text_counts_stay_bounded_and_keep_the_constants():
    template = None
    for n in range(1500):
        late = "<p>Late line</p>" if n >= 500 else ""
        shape = wrappers.shape_of(dom.parse(f"<body><div>{late}{''.join(f'<p>Text {n} {k}</p>' for k in range(5))}</div></body>"))
        template = shape if template is None else wrappers.merge(template, shape)
    node = template[wrappers.KIDS][0][wrappers.KIDS][0][wrappers.KIDS][0]
    assert node[wrappers.LABEL] == "p" and len(node[wrappers.TEXTS]) < 200
    assert wrappers.main_text("<body><div><p>Late line</p><p>New</p></div></body>", json.dumps(wrappers.wrapper_of(template))) == "New"


def test_tree_matching_keeps_order_and_counts():
    a = ["r", 1, None, 0, [["p", 1, 5, 3, []], ["q", 1, None, 0, []], ["s", 1, 7, 2, []]]]
    b = ["r", 1, None, 0, [["q", 1, None, 0, []], ["p", 1, 5, 3, []], ["s", 1, 8, 2, []]]]
    size, pairs = wrappers.matching(a, b)
    assert size == 3 and len(pairs) == 2
    merged = wrappers.merge(a, b)
    assert merged[wrappers.PAGES] == 2 and merged[wrappers.KIDS][-1][wrappers.TEXT] == -1


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b<br>c", "a\nb c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ("<div>" * 3000 + "deep", "deep"), ("<script>x", ""), ("<!-- a --><p>b</p><!-- c", "b"), ('<p title="a>b">q</p>', "q"), ("<p>x\xa0 \t y</p>", "x y"),
    ('<body class="has-sidebar"><div class="content with-sidebar"><article class="comments-open"><p>yes</article></div><div class="sidebar">no', "yes"),
    ("<form id=f><main>yes</main></form><form>no</form>", "yes"),
    ('<div style="display:none">no</div><p>yes', "yes"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<article><header><h1>T</h1></header>x</article>", "T\nx"),
])
def test_broken_and_odd_markup(html, text):
    assert wrappers.main_text(html or "", None) == text


def test_page_edge_rows(spark):
    rows = [(1, None, None), (None, "http://h/x", "<p>a</p>"), (2, "no url", ""), (3, "http://h/x", "<p>a</p>"), (3, "http://h/x", "<p>a</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in wrappers.extract_pages(df).collect()) == ["", "", "a", "a", "a"]
    assert wrappers.extract_pages(df.limit(0)).count() == 0


# --------------------------------------------------------------- chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "[TURN x] y", "<", "</s", "[INST", "", "a\nb", "[/TURN]", " [/SYS]", "é😀", "<<s>s>", "[[INST]"]


def test_conversations_round_trip(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(40):
        for t in range(int(rng.integers(1, 9))):
            role = str(rng.choice(["user", "assistant", "system", "tool", "we]ird[<%\\", ""]))
            rows.append((c, t, role, "".join(rng.choice(NASTY, rng.integers(0, 5)))))
    rows += [(50, 0, None, None), (51, None, "assistant", "x"), (51, 0, "assistant", None), (52, 1, "user", "b"), (52, 1, "user", "a")]
    df = spark.createDataFrame([(*r, "m") for r in rows], "conv_id long, turn long, role string, text string, record string").repartition(3)
    got = {r.conv_id: r for r in chat_format.conversation_digests(df).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        flat = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(flat.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat_format.conversation_digests(df.limit(0)).count() == 0


def test_escaped_texts_hold_no_control_strings(spark):
    df = spark.createDataFrame([(t,) for t in [*NASTY, "".join(NASTY)]], "t string")
    for r in df.select("t", chat_format.escape(F.col("t")).alias("e"), chat_format.unescape(chat_format.escape(F.col("t"))).alias("back")).collect():
        assert r.back == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST", "[/INST", "[TURN", "[/TURN", "[SYS", "[/SYS", "[OUT"))


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "q", "name": "n"}]}, "messages", [("user", "q")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "system": "be"}, "instruction", [("system", "be"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c"}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a", "context": "c"}, "question_answer", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"dialog": [{"speaker": "x", "utterance": "u"}]}, "dialog", [("x", "u")]),
    ({"unknown": 1}, None, None),
]


@pytest.mark.parametrize("layout", ["messages", "prompt_completion"])
def test_texts_beyond_the_parsers_limits_are_read(spark, layout):
    # Past 20,000,000 characters in one string.
    size = 20_500_000
    long = F.repeat(F.lit("x"), F.lit(size))
    if layout == "messages":
        record = F.to_json(F.struct(F.array(F.struct(F.lit("assistant").alias("role"), long.alias("content"))).alias("messages")))
    else:
        record = F.to_json(F.struct(F.lit("q").alias("prompt"), long.alias("completion")))
    out = chat_format.format_records(spark.range(1).select("id", record.alias("record")), "record", ["id"])
    [r] = out.select("layout", F.length("formatted").alias("n"), F.col("loss_spans")[0]["len"].alias("loss")).collect()
    assert r.layout == layout and r.loss == size and r.n > size


BARE = [
    ('{"a": "x\\"y", "b": ["p", "q:", {"c": "\\u00e9{"}], "d": 1}', '{"a": "", "b": ["", "", {"c": ""}], "d": 1}'), ('{"k\\"": {"m": "v"}}', '{"k\\"": {"m": ""}}'),
    ('["a" , "b"]', '["" , ""]'), ('no json', 'no json'), ('"a": "b"', '"a": ""'),
]


def test_field_paths_are_read_without_the_texts(spark):
    df = spark.createDataFrame([(r,) for r, _ in BARE], "r string")
    assert [r[0] for r in df.select(chat_format.without_texts(F.col("r"))).collect()] == [b for _, b in BARE]
    bad = spark.createDataFrame([('{"a": "x\ny"}',), ('{"a": "\\q"}',), ('{"a": "x}',)], "r string")
    assert all(r[0] is None for r in bad.select(chat_format.structure_of(F.col("r"))).collect())
    many = json.dumps({"messages": [{"role": "user", "content": f"{{{n}}}"} for n in range(50)] + [{"role": "x", "content": "y", "name": "z"}]})
    [r] = spark.createDataFrame([(many,)], "r string").select(
        chat_format.structure_of(F.col("r")), chat_format.structure_of(F.col("r"), 10), F.length(chat_format.without_texts(F.col("r"), 10))
    ).collect()
    assert r[0] == r[1] and r[2] < 150


def test_layouts_are_told_by_their_field_paths(spark):
    rows = [(n, json.dumps(r)) for n, (r, _, _) in enumerate(LAYOUTS)] + [(90, None), (91, "no json"), (92, "[]")]
    out = chat_format.format_records(spark.createDataFrame(rows, "id int, record string"), "record", ["id"])
    got = {r.id: r for r in out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).collect()}
    for n, (_, layout, turns) in enumerate(LAYOUTS):
        assert got[n].layout == layout
        assert (got[n].turns and [(t.role, t.text) for t in got[n].turns]) == turns
    assert all(got[n].layout is None and got[n].formatted is None for n in (90, 91, 92))
    assert len({got[n].fingerprint for n in range(9)}) == 9
    counts = {r.layout: r.n for r in chat_format.layout_counts(out).collect() if r.layout is None}
    assert counts  # records without output can be told


PART = {"type": "text", "text": "t"}
OTHER_RECORDS = [
    ({"messages": []}, "messages", []),
    ({"id": 7, "messages": [], "tags": ["x"]}, "messages", []),
    ({"dialog": [ ]}, "dialog", []),
    ({"messages": [{"role": "user", "content": "q", "weight": 0.5}, {"role": "assistant", "content": "[a]"}]}, "messages", [("user", "q"), ("assistant", "[a]")]),
    ({"id": "x", "meta": {"messages": 1}, "messages": [{"role": "user", "content": "q"}]}, "messages", [("user", "q")]),
    ({"messages": [{"role": "user", "content": [PART, {"type": "image", "url": "u"}, "{s}", {"text": "[u]"}]}]}, "messages", [("user", "t\n\n{s}\n\n[u]")]),
    ({"messages": [{"role": "user", "content": [PART]}, {"role": "assistant", "content": "[1, 2]"}]}, "messages", [("user", "t"), ("assistant", "[1, 2]")]),
    ({"messages": [{"role": "user", "text": "q", "n": None}]}, "message_texts", [("user", "q")]),
    ({"conversations": [{"from": "human", "value": "q", "x": {"y": []}}]}, "conversations", [("user", "q")]),
    ({"instruction": "do", "output": "done", "category": "c", "input": "[x"}, "instruction", [("user", "do\n\n[x"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c", "id": 3}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"prompt": {"a": 1}, "completion": "c"}, None, None),
    ({"messages": ["q"]}, None, None),
    ({"messages": {"role": "user", "content": "q"}}, None, None),
    ({}, None, None),
]


def test_records_with_other_fields_lists_of_parts_and_no_messages(spark):
    rows = [(n, json.dumps(r)) for n, (r, _, _) in enumerate(OTHER_RECORDS)]
    out = chat_format.format_records(spark.createDataFrame(rows, "id int, record string"), "record", ["id"])
    read = out.withColumns({"turns": chat_format.read_turns(F.col("formatted")), "loss": chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))})
    got = {r.id: r for r in read.collect()}
    for n, (record, layout, turns) in enumerate(OTHER_RECORDS):
        assert got[n].layout == layout, record
        assert (got[n].turns if turns is None else [(t.role, t.text) for t in got[n].turns]) == turns, record
        assert got[n].loss == (None if turns is None else "".join(t for r, t in turns if r == "assistant")), record


def test_a_conversation_of_many_turns_is_linear(spark):
    """100,000 turns in one conversation; texts of one piece, of none and over several pieces keep their places."""
    n = 100_000
    said = F.when(F.col("id") % 1001 == 1, F.repeat(F.lit("\\é😀"), F.lit(3000))).when(F.col("id") % 7 == 0, "").otherwise(F.concat(F.lit("</s>turn "), F.col("id").cast("string")))
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    began = time.time()
    [got] = chat_format.conversation_digests(rows).collect()
    assert time.time() - began < 60
    texts = [(r.role, r.text) for r in rows.orderBy("turn").collect()]
    loss = "".join(t for role, t in texts if role == "assistant")
    assert got.n_turns == n and got.loss_chars == len(loss)
    assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in texts).encode()).hexdigest()
