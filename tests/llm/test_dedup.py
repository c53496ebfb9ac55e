"""Exact and near dedup against brute force."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimetl.llm import exact_dedup, graph, simhash

DOCS = "doc_id long, text string, text_sha256 string, recipe int"


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)


LONG = "One sentence here. Another one there!\n" * 400


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for members in groups.values():
        keep = max((m for m in members if m is not None), default=None)
        out += [(i, keep, len(members)) for i in members]
    return sorted(out, key=repr)


ROWS = [(1, "a b c"), (2, "a b c"), (3, "a b c "), (4, None), (5, ""), (6, LONG), (7, LONG), (8, LONG + "x"), (9, "A b c"), (None, "a b c"), (10, "é" * 9000), (11, "é" * 9000)]


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup_equals_grouping_by_text(spark, bits):
    got = exact_dedup.exact_dedup(docs(spark, ROWS), hash_bits=bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=repr) == brute_exact(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None)


def test_colliding_hashes_do_not_merge_texts(spark):
    texts = [(n, f"{n % 40} " * 300) for n in range(80)]
    got = exact_dedup.exact_dedup(docs(spark, texts), hash_bits=1).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute_exact_ids(texts)


def brute_exact_ids(rows):
    return sorted(brute_exact(rows))


def test_repeated_rows_keep_exactly_one(spark):
    rows = [(1, "same"), (1, "same"), (1, "same"), (2, "other")]
    got = exact_dedup.exact_dedup(docs(spark, rows)).collect()
    assert len(got) == 4 and sorted(r.doc_id for r in got if r.kept) == [1, 2]
    left = exact_dedup.drop_exact_copies(docs(spark, rows))
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]
    assert left.columns == ["doc_id", "text", "text_sha256", "recipe"]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_exact_copies(none).count() == 0
    assert simhash.near_dedup(none).count() == 0
    assert simhash.one_of_each(none).count() == 0


def test_chunks_join_to_the_text_and_follow_content(spark):
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdefghinorsty"), rng.integers(1, 9))) for _ in range(4000))
    rows = spark.createDataFrame([(text,), ("Inserted in front. " + text,), ("x" * 10000,)], "text string")
    cut = [r.c for r in rows.select(exact_dedup.chunks_of(F.col("text")).alias("c")).collect()]
    assert ["".join(c) for c in cut] == [r.text for r in rows.collect()]
    assert max(len(c) for cs in cut for c in cs) <= exact_dedup.MAX_CHUNK
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 5 > 50


@pytest.mark.parametrize("letters, end, space", [("абвгдежзиклмн", ", ", " "), ("αβγδεζηθ", ". ", " "), ("语言模型数据处理", "。", ""), ("कखगघचछज", "। ", " ")])
def test_chunks_of_other_scripts_fall_into_step(spark, letters, end, space):
    rng = np.random.default_rng(2)
    clauses = [space.join("".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(8)) for _ in range(400)]
    text = end.join(clauses)
    rows = spark.createDataFrame([(text,), (letters + end + text,)], "text string")
    cut = [r.c for r in rows.select(exact_dedup.chunks_of(F.col("text")).alias("c")).collect()]
    assert ["".join(c) for c in cut] == [r.text for r in rows.collect()]
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 5 > 50


# --------------------------------------------------------------- SimHash

def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB \t\n\x0b\x0cé\xa0.", max_size=60))
def test_fingerprint_equals_its_definition(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_golay_decoder_is_perfect():
    error, heavy, change = simhash._decoder()
    assert len(np.unique(error)) == 2048 and heavy.sum() == 1771
    assert (np.sort(change[heavy], axis=1)[:, 0] > 0).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_close_fingerprints_share_a_key(x, bits):
    y = x
    for b in bits:
        y ^= 1 << b
    keys = [set(simhash.keys_of(np.array([v], np.uint64))[1].tolist()) for v in (x, y)]
    assert keys[0] & keys[1]


def components_by_force(values, max_bits=4):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= max_bits:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def near_texts(seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{n}" for n in range(500)]
    out = []
    for _ in range(12):
        base = rng.choice(words, 400).tolist()
        for copies in range(6):
            edited = list(base)
            for at in rng.choice(400, copies, replace=False):
                edited[at] = str(rng.choice(words))
            out.append(" ".join(edited))
    return [*out, None, "", "  \n", "one two", "ONE Two", out[0], LONG]


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_components_equal_brute_force(spark, block):
    rows = [(100 + n, t) for n, t in enumerate(near_texts())]
    prints = [brute_fingerprint(t or "") for _, t in rows]
    roots = components_by_force(prints)
    want = {i: (p, 100 + r) for (i, _), p, r in zip(rows, prints, roots, strict=True)}
    got = simhash.near_dedup(docs(spark, rows), block=block).withColumn("hex", simhash.hex_digits()).collect()
    assert {r.doc_id: (int(r.hex, 16), r.component_id) for r in got} == want
    assert len({r for r in roots}) < len(rows) - 20
    kept = simhash.one_of_each(docs(spark, rows), block=block)
    assert {r.doc_id for r in kept.collect()} == {100 + r for r in roots}


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    a, b, c = ("wide open water runs past the mill", "nothing like it grows in this dry land", "one more text that stands alone here")
    rows = [(3, a), (5, a), (5, b), (None, b), (7, c), (7, c), (None, "only without an id, twice"), (None, "only without an id, twice"), (8, None), (9, "")]
    kept = simhash.one_of_each(docs(spark, rows))
    assert kept.columns == [f.split()[0] for f in DOCS.split(", ")]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(3, a), (5, b), (7, c), (None, "only without an id, twice"), (8, None)], key=repr)


def test_null_ids_keep_their_rows(spark):
    got = simhash.near_dedup(docs(spark, [(None, "a b"), (None, "a b"), (5, "a b"), (None, "q r s t u v")])).collect()
    assert sorted((r.component_id is None, r.component_id or 0) for r in got) == [(False, 5), (False, 5), (False, 5), (True, 0)]


def test_more_bits_than_the_keys_cover_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_dedup(docs(spark, [(1, "a")]), max_bits=5)


def test_chains_and_stars_of_links(spark):
    chain = [(n, n + 1) for n in range(60)]
    star = [(1000, 1001 + n) for n in range(50)]
    loops = [(7000, 7000), (8000, 8001), (8001, 8000)]
    edges = spark.createDataFrame(chain + star + loops, "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {**{n: 0 for n in range(61)}, **{n: 1000 for n in range(1000, 1051)}, 8000: 8000, 8001: 8000}
    assert graph.components(edges.limit(0)).count() == 0
