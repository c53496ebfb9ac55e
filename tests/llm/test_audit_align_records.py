"""Filter audit, token alignment and token records against brute force."""

import hashlib
import os
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimetl.llm import align, audit, records
from dimetl.llm.byte_bpe import ByteEncoder
from dimetl.llm.queries import tokenizer_path

A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
LONG = "lorem ipsum dolor " * 20000
ODD = ["'s", "'ll", " ", "  ", "\n", "\t", "a", "é", "ſ", "5", "²", ".", "'", "!", " ", "　", "—", "日本", "<|endoftext|>", "</s>", "\x1c", "\x7f",
       "​", "ab", "\r\n", "x'", "'5", " ", "ё", "▁", "<0x0A>"]


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    schema = "doc_id long, text string, source string, mask int, part string, start long, n_a long, key string"
    return spark.createDataFrame([(i, t, s, 1, "x", 2, 3, "k") for i, t, s in rows], schema).repartition(3)


# --------------------------------------------------------------- filter audit


def fails(rows):
    out = []
    for i, t, s in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        bad = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        out.append((i, s or "", {k for k, v in bad.items() if v}))
    return out


def brute_audit(rows, good, toxic):
    out, marked = [], fails(rows)
    for part in {p for _, p, _ in marked}:
        own = [(i, f) for i, p, f in marked if p == part]
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                left = [x for x in own if not x[1] & set(order[:step])]
                gone = [x for x in left if letter in x[1]]
                shapley[letter] += len(gone)
                lines.append((part, "".join(order), step + 1, len(left) - len(gone), len(gone), sum(letter in f for _, f in own) - len(gone),
                              sum(f == {letter} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out)


PROSE = " ".join(f"w{n}" for n in range(220))
AUDIT_ROWS = [
    (1, PROSE, "a"), (2, PROSE, "a"), (3, PROSE, "b"), (3, PROSE, "b"), (4, None, None), (5, "", ""), (None, PROSE, "a"), (None, "", "b"),
    (6, "UP " * 300, "a"), (7, "x # y", "b"), (8, "\t\x0b " + PROSE.replace(" ", " ") + " ", "a"), (9, "one two " * 150 + "$", "b"), (9, "other", "b"),
    (10, PROSE.upper(), "c"), (11, LONG, "c"), (12, LONG + "|", "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, None), (6, 1, 1), (7, None, None), (9, 1, 1), (11, 1, 0), (None, 1, 1), (99, 1, 1)]


def test_audit_equals_brute_force(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = audit.audit_filters(docs(spark, AUDIT_ROWS), labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    good, toxic = {i for i, q, _ in LABELS if q == 1 and i is not None}, {i for i, _, t in LABELS if t == 1 and i is not None}
    assert sorted(map(tuple, got.collect())) == brute_audit(AUDIT_ROWS, good, toxic)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"


def test_audit_of_an_empty_table_and_of_more_parts_than_the_row_limit(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(docs(spark, []), labels).count() == 0
    cells = spark.range(3500).selectExpr("cast(id as string) AS part", "cast(id % 32 as int) AS mask", "1L AS docs", "0L AS good", "0L AS toxic")
    assert audit.prefix_metrics(cells).count() == 3500 * 325


# --------------------------------------------------------------- encoders


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(A_PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=10).map("".join), max_size=6), st.booleans())
def test_cached_ids_equal_the_library(texts, special_as_text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(A_PATH)
    plain.encode_special_tokens = special_as_text
    encoder = _ENCODERS.setdefault(special_as_text, ByteEncoder(A_PATH, special_as_text, max_words=40))
    flat, counts = encoder.encode(texts)
    got = np.split(flat, np.cumsum(counts)[:-1]) if texts else []
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


_ENCODERS: dict = {}


# --------------------------------------------------------------- alignment


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(A_PATH)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in plain)}
    spelt = {i: bytes(letters.get(c, 0) for c in entry) for entry, i in a_side.get_vocab().items()}
    found = []
    for i, text in rows:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [spelt[x] for x in a]
        b_bytes = [bytes([int(b_side.id_to_piece(x)[3:5], 16)]) if b_side.is_byte(x) else b_side.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = (" " + text).encode() if text else b""
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        cuts = sorted(set(a_end) & set(b_end))
        parts = [([x for x, e in zip(a, a_end) if s < e <= c], [x for x, e in zip(b, b_end) if s < e <= c]) for s, c in zip([0, *cuts], cuts)]
        found.append((i, a, b, parts))
    held = Counter()
    for _, _, _, parts in found:
        held.update({(x, y) for p, q in parts for x in p for y in q})
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for i, a, b, parts in found:
        links = [(x, y) for p, q in parts for x in p for y in q]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in parts)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(parts), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), digest))
    return sorted(out, key=repr)


ALIGN_ROWS = [
    (1, None), (2, ""), (None, "x y"), (3, "the cat sat on the mat"), (3, "the cat sat on the mat"), (4, " leading and trailing  "), (5, "a▁b"), (6, "日本語と<|endoftext|></s>"),
    (7, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 5), (8, "😀😀 don't\n\n\tstop"), (9, "<0x0A> <unk>"), (10, "the mat sat on the cat " * 300), (11, "\x00 nul"),
]


@pytest.mark.parametrize("block", [align.BLOCK_PRODUCTS, 7])
def test_alignment_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_PRODUCTS", block)
    rows = [*ALIGN_ROWS, *((100 + n, "".join(np.random.default_rng(n).choice(ODD, 12))) for n in range(40))]
    got = align.align_documents(docs(spark, [(i, t, "s") for i, t in rows]), A_PATH, B_PATH).collect()
    assert sorted(map(tuple, got), key=repr) == brute_alignment(rows)
    links = align.token_links(docs(spark, [(i, t, "s") for i, t in rows]), A_PATH, B_PATH).collect()
    assert len(links) == sum(r.n_links for r in got)
    by_doc = Counter(r.doc_id for r in links if r.doc_id not in (3, None))
    assert all(by_doc[r.doc_id] == r.n_links for r in got if r.doc_id not in (3, None))
    assert all(r.shared_bytes >= 0 for r in links) and sum(r.shared_bytes for r in links) == sum(len((" " + t).encode()) for i, t in rows if t and brute_n(got, i))


def brute_n(got, doc_id):
    return next(r.n_a for r in got if r.doc_id == doc_id)


def test_alignment_of_an_empty_table(spark):
    assert align.align_documents(docs(spark, []), A_PATH, B_PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 50))
def test_row_products_equal_dense_products(seed, block):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 3, shape) * rng.integers(0, 2, shape) for shape in ((6, 5), (5, 7)))
    x, y = (align.Csr.of_entries(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in (a, b))
    out = np.zeros((6, 7), np.int64)
    for i, j, v in align.row_products(x, y, block):
        out[i, j] += v
    assert np.array_equal(out, a @ b)
    t = y.transposed()
    assert np.array_equal(np.repeat(np.arange(7), np.diff(t.ptr)), np.nonzero(b.T)[0]) and np.array_equal(t.values, b.T[np.nonzero(b.T)])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.integers(0, 2**32 - 1))
def test_groups_end_where_both_sides_end(sizes, seed):
    rng, total = np.random.default_rng(seed), sum(sizes)
    a = np.array(sizes)
    b = np.diff([0, *sorted(rng.choice(np.arange(1, total), rng.integers(0, total), replace=False).tolist() if total > 1 else []), total])
    i, j, shared = align.overlap_links(a, b, block=5)
    assert shared.sum() == total
    ga, gb = align.groups(i, j)
    ends = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
    assert ga.tolist() == [sum(e < x for e in ends) for x in np.cumsum(a)] and gb.tolist() == [sum(e < x for e in ends) for x in np.cumsum(b)]


# --------------------------------------------------------------- records


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert slow_crc32c(b"123456789") == 0xE3069283
    rng, counts = np.random.default_rng(0), np.array([1, 2, 3, 5, 8, 17, 100, 1, 64])
    words = rng.integers(0, 2**32, counts.sum(), dtype=np.uint32)
    parts = np.split(words, np.cumsum(counts)[:-1])
    for block in (1 << 20, 4):
        assert records.crc32c(words, counts, block).tolist() == [slow_crc32c(p.tobytes()) for p in parts]


@pytest.mark.parametrize("narrow", [True, False])
def test_frames_are_read_back_and_damage_is_found(narrow):
    counts = np.array([1, 2, 5, 1000])
    ids = np.random.default_rng(1).integers(0, 65536, counts.sum()).astype(np.uint32)
    words, begin = records.frames(ids, counts, [5, -7, 2**62, 0], [True, True, True, False], narrow)
    data = words.tobytes()
    n = int.from_bytes(data[:8], "little")
    mask = lambda c: ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF
    assert int.from_bytes(data[8:12], "little") == mask(slow_crc32c(data[:8])) and int.from_bytes(data[12 + n : 16 + n], "little") == mask(slow_crc32c(data[12 : 12 + n]))
    got = records._rows("f", data)
    assert got["doc_id"].tolist()[:3] == [5, -7, 2**62] and got["doc_id"].isna().tolist() == [False] * 3 + [True]
    assert got["n_tokens"].tolist() == counts.tolist() and b"".join(got["ids"]) == ids.astype("<u4").tobytes()
    assert got["offset"].tolist() == (4 * begin).tolist()
    for at in (0, 9, 14, 30, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="f: "):
            records.parse(bytes(bad), "f")
    with pytest.raises(ValueError, match="f: no whole record"):
        records.parse(data[:-4], "f")


RECORD_ROWS = [
    (5, "b text"), (5, "a text"), (None, "no id"), (2, None), (2, ""), (9, LONG), (1, "x <|endoftext|> y"), (7, "same"), (7, "same"), (-3, "é日本"),
    *((100 + n, f"document number {n} " * (n % 5)) for n in range(60)),
]


def test_records_round_trip(spark, tmp_path, library):
    frame = docs(spark, [(i, t, "s") for i, t in RECORD_ROWS])
    folder = records.write_records(frame, A_PATH, str(tmp_path / "out"), file_bytes=2000)
    rows = sorted(records.record_digests(records.read_records(spark, folder)).collect(), key=lambda r: r.start)
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [records.END_ID] for _, t in RECORD_ROWS}
    crc = {t: zlib.crc32(np.array(v, "<u4").tobytes()) for t, v in ids.items()}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(ids[t]), crc[t]) for i, t in RECORD_ROWS)
    assert [r.doc_id for r in rows] == sorted(i for i, _ in RECORD_ROWS if i is not None) + [None]
    assert [r.start for r in rows] == (np.cumsum([r.n_tokens for r in rows]) - [r.n_tokens for r in rows]).tolist()
    # Files are bounded and named by the index; a file that no index row names is not read.
    index = records.read_index(spark, folder).collect()
    names = {r.file for r in index}
    assert len(names) >= 3 and names == set(os.listdir(tmp_path / "out" / "records"))
    (tmp_path / "out" / "records" / "part-000000-00000-left.records").write_bytes(b"left by a lost attempt")
    assert records.read_records(spark, folder).count() == len(RECORD_ROWS)
    # Shuffled reads: all records once, the same order for the same seed only.
    one, again, other = ([(r.file, r.offset, r.doc_id, bytes(r.ids)) for r in records.read_shuffled(spark, folder, s).collect()] for s in (1, 1, 2))
    assert one == again and one != other and Counter(one) == Counter(other)
    assert Counter((r[2], r[3]) for r in one) == Counter((i, np.array(ids[t], "<u4").tobytes()) for i, t in RECORD_ROWS)
    # A damaged file is an error, not a loss.
    victim = tmp_path / "out" / "records" / sorted(names)[0]
    victim.write_bytes(victim.read_bytes()[:-8])
    with pytest.raises(Exception, match="no whole record"):
        records.read_records(spark, folder).count()


def test_records_of_an_empty_table(spark):
    assert records.round_trip(docs(spark, []), A_PATH).count() == 0
