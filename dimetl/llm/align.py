"""Cross-tokenizer alignment by products of token-byte incidence matrices.

Both tokenizers cut the same bytes.  ``A[i, k]`` is 1 where byte k belongs to
the i-th token of the first, ``B[j, k]`` likewise of the second, both in
compressed sparse rows built here.  The row products of Gustavson's algorithm
give ``A Bt``: its entry (i, j) counts the bytes the two tokens share, and its
non-zero entries are the *overlap links*.  In row order they are a staircase;
where both tokens change from one link to the next, both tokenizers end at one
byte, and a new *group* begins.  With token-group incidences G and H, the
products ``G Ht`` are the *shared-group links*: all pairs of tokens of a group.

Corpus-wide counts of linked id pairs travel as chunks: a chunk of documents
of bounded text is one row with its distinct pairs, so each pair crosses the
network once a chunk and not once a document, and what comes back to a chunk is
bounded by its own text.  No table is broadcast, however many pairs there are.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.byte_bpe import ByteEncoder, encode_parts
from dimetl.llm.common import id_col, materialise, text_or_empty
from dimetl.llm.idcache import IdCache
from dimetl.session import scratch_path

#: A chunk's documents have about this many characters, and are aligned in blocks of about so many.
CHUNK_CHARS, ALIGN_CHARS = 2 << 20, 1 << 18
#: Products of one block of rows.
BLOCK_PRODUCTS = 1 << 22

# --------------------------------------------------------------- sparse products


@dataclass
class Csr:
    """Compressed sparse rows: row r holds ``values[ptr[r]:ptr[r + 1]]`` at columns ``cols[...]``, ascending."""

    ptr: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    n_cols: int

    @staticmethod
    def of_entries(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, n_cols: int) -> Csr:
        """From entries in any order; equal places add up."""
        order = np.argsort(rows * n_cols + cols, kind="stable")
        rows, cols, values = rows[order], cols[order], values[order]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])]) if len(rows) else np.zeros(0, np.int64)
        added = np.add.reduceat(values, first) if len(first) else values
        ptr = np.searchsorted(rows[first], np.arange(n_rows + 1))
        return Csr(ptr, cols[first], added, n_cols)

    @staticmethod
    def of_runs(sizes: np.ndarray) -> Csr:
        """Row r is 1 in the next ``sizes[r]`` columns: tokens by the bytes they cover."""
        total = int(sizes.sum())
        return Csr(np.append(0, np.cumsum(sizes)), np.arange(total), np.ones(total, np.int64), total)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        order = np.argsort(self.cols, kind="stable")
        ptr = np.append(0, np.cumsum(np.bincount(self.cols, minlength=self.n_cols)))
        return Csr(ptr, rows[order], self.values[order], len(self.ptr) - 1)


def row_products(a: Csr, b: Csr, block: int = BLOCK_PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries ``(row, column, value)`` of ``a b`` in row order, a block of rows at once.

    Gustavson: row i of the product is the sum of the rows of ``b`` that row i
    of ``a`` names, each times its entry.  A row of more than ``block`` products
    is a block of its own.
    """
    length = np.diff(b.ptr)
    work = np.append(0, np.cumsum(length[a.cols]))[a.ptr]
    n_rows, row = len(a.ptr) - 1, 0
    while row < n_rows:
        stop = max(row + 1, int(np.searchsorted(work, work[row] + block, side="right")) - 1)
        mine = slice(a.ptr[row], a.ptr[stop])
        named, size = a.cols[mine], length[a.cols[mine]]
        of_row = np.repeat(np.repeat(np.arange(row, stop), np.diff(a.ptr[row : stop + 1])), size)
        place = np.repeat(b.ptr[named] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        cols, values = b.cols[place], np.repeat(a.values[mine], size) * b.values[place]
        # Neighbours with one place are added up at once; what is left out of order is sorted.
        if len(cols):
            step = np.flatnonzero(np.r_[True, (of_row[1:] != of_row[:-1]) | (cols[1:] != cols[:-1])])
            of_row, cols, values = of_row[step], cols[step], np.add.reduceat(values, step)
            if ((of_row[1:] == of_row[:-1]) & (cols[1:] <= cols[:-1])).any():
                merged = Csr.of_entries(of_row - row, cols, values, stop - row, b.n_cols)
                of_row, cols, values = np.repeat(np.arange(row, stop), np.diff(merged.ptr)), merged.cols, merged.values
            yield of_row, cols, values
        row = stop


def overlap_links(a_sizes: np.ndarray, b_sizes: np.ndarray, block: int = BLOCK_PRODUCTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, j, shared bytes)`` of all overlapping tokens of two cuts of the same bytes, in order."""
    found = list(row_products(Csr.of_runs(a_sizes), Csr.of_runs(b_sizes).transposed(), block))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def groups(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every token of either side, from all overlap links in order."""
    if not len(i):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[False, (i[1:] != i[:-1]) & (j[1:] != j[:-1])]
    of_link = np.cumsum(new)
    return of_link[np.r_[True, i[1:] != i[:-1]]], of_link[np.r_[True, j[1:] != j[:-1]]]


# --------------------------------------------------------------- tokenizers


class PieceEncoder:
    """Ids of texts by a piece vocabulary that adds a space before a text, through a cache of the ids of words.

    Words begin at a space that follows another sign; no piece holds a space
    after another sign (checked), so no merge crosses them.  A word whose
    pieces do not spell it again gets no ids, which its text's bytes tell.
    """

    def __init__(self, path: str, max_words: int):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelt = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                spelt.append(bytes([int(piece[3:5], 16)]))
            else:
                spelt.append(piece.replace("▁", " ").encode())
                if " " in spelt[-1].decode().lstrip(" "):
                    raise ValueError(f"piece {i} crosses words")
        self.spelt = np.array(spelt, object)
        self.sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.cache = IdCache(self._learn, max_words)

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode([w[1:].decode("utf-8") for w in words], num_threads=1)
        # The model adds no space to an empty text: a single space at a text's end is a piece of its own.
        ids = [[self.model.piece_to_id("▁")] if w == b" " else x for x, w in zip(ids, words, strict=True)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum()))
        spelt = self.spelt.__getitem__
        ends = np.append(0, np.cumsum(self.sizes[flat]))[np.cumsum(counts)]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if np.array_equal(ends, np.cumsum(sizes)) and b"".join(map(spelt, flat.tolist())) == b"".join(words):
            return flat, counts
        good = np.fromiter((b"".join(map(spelt, x)) == w for x, w in zip(ids, words, strict=True)), bool, len(words))
        return flat[np.repeat(good, counts)], counts * good

    @staticmethod
    def _cuts(blob: bytes, starts: np.ndarray) -> np.ndarray:
        space = np.frombuffer(blob, np.uint8) == 32
        cut = space & ~np.r_[False, space[:-1]]
        cut[starts] = True
        return np.flatnonzero(cut)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given with the space in front, and the number of each text's."""
        return encode_parts(self.cache, texts, self._cuts)


@lru_cache(maxsize=1)
def _encoders(path_a: str, path_b: str) -> tuple[ByteEncoder, PieceEncoder]:
    """One pair per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteEncoder(path_a, special_as_text=True, max_words=400_000), PieceEncoder(path_b, max_words=400_000)


@dataclass
class Aligned:
    """Tokens and groups of some documents, all in a row; groups are numbered through."""

    n_a: np.ndarray
    n_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray]


def tokens(texts: list[str], a_encoder: ByteEncoder, b_encoder: PieceEncoder) -> tuple[np.ndarray, ...]:
    """``(a, n_a, b, n_b)``: ids of both sides and their numbers; empty texts and those that a side does not spell again have none."""
    spaced = [" " + t if t else "" for t in texts]
    raw = [t.encode("utf-8", "replace") for t in spaced]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    a, n_a = a_encoder.encode(spaced)
    b, n_b = b_encoder.encode(raw)

    def bytes_of(sizes: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(n))])

    good = (bytes_of(a_encoder.sizes[a], n_a) == size) & (bytes_of(b_encoder.sizes[b], n_b) == size)
    return a[np.repeat(good, n_a)], n_a * good, b[np.repeat(good, n_b)], n_b * good


def align(texts: list[str], a_encoder: ByteEncoder, b_encoder: PieceEncoder) -> Iterator[tuple[slice, Aligned]]:
    """Alignment of all texts, in blocks of neighbours of about ``ALIGN_CHARS`` characters."""
    a, n_a, b, n_b = tokens(texts, a_encoder, b_encoder)
    a_end, b_end = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
    for block in _runs(texts, ALIGN_CHARS):
        own_a = a[a_end[block.start] : a_end[block.stop]]
        own_b = b[b_end[block.start] : b_end[block.stop]]
        # Two texts meet at a byte where both sides end, so their groups part by themselves.
        links = overlap_links(a_encoder.sizes[own_a], b_encoder.sizes[own_b])
        yield block, Aligned(n_a[block], n_b[block], own_a, own_b, *groups(links[0], links[1]), links)


def _runs(texts: list[str], chars: int) -> Iterator[slice]:
    """Neighbouring texts of about so many characters together."""
    begin = size = 0
    for n, t in enumerate(texts):
        size += len(t)
        if size >= chars or n + 1 == len(texts):
            yield slice(begin, n + 1)
            begin, size = n + 1, 0


# --------------------------------------------------------------- digests and pairs


@lru_cache(maxsize=1)
def _words() -> list[str]:
    """Decimal ids with the sign after them: a comma, the bar after a group's first side, the semicolon after a group."""
    return [f"{i}{sign}" for sign in ",|;" for i in range(1 << 16)]


def group_digests(x: Aligned) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of each document; the empty string without tokens."""
    a_last = np.r_[x.a_group[1:] != x.a_group[:-1], True][: len(x.a)]
    b_last = np.r_[x.b_group[1:] != x.b_group[:-1], True][: len(x.b)]
    word = np.zeros(len(x.a) + len(x.b), np.int64)
    # In the text a token stands behind all tokens of earlier groups, and a second-side one behind its group's first side.
    word[np.arange(len(x.a)) + np.searchsorted(x.b_group, x.a_group)] = x.a.astype(np.int64) + (a_last.astype(np.int64) << 16)
    word[np.arange(len(x.b)) + np.searchsorted(x.a_group, x.b_group, side="right")] = x.b.astype(np.int64) + (b_last.astype(np.int64) << 17)
    ends = np.cumsum(x.n_a + x.n_b)
    text = list(map(_words().__getitem__, word.tolist()))
    starts = (ends - x.n_a - x.n_b).tolist()
    return [hashlib.sha256("".join(text[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(starts, ends.tolist(), strict=True)]


def _incidence(ids: np.ndarray, group: np.ndarray, n_groups: int) -> Csr:
    """Groups by ids: how often each id occurs in each group."""
    return Csr.of_entries(group, ids.astype(np.int64), np.ones(len(ids), np.int64), n_groups, 1 << 16)


def linked_pairs(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, pair, times)`` of every distinct linked id pair of every document; a pair is ``a << 16 | b``.

    Group-incidence products with equal ids of a group and side taken together:
    the entry of (id, id) is the number of their token links.
    """
    n_groups = int(x.a_group[-1]) + 1 if len(x.a_group) else 0
    by_group = _incidence(x.b, x.b_group, n_groups)
    first = _incidence(x.a, x.a_group, n_groups)
    # One row for each (group, id) of the first side, with its single group as column.
    row_group = np.repeat(np.arange(n_groups), np.diff(first.ptr))
    g = Csr(np.arange(len(row_group) + 1), row_group, first.values, n_groups)
    group_doc = np.repeat(np.arange(len(x.n_a)), x.n_a)[np.r_[True, x.a_group[1:] != x.a_group[:-1]][: len(x.a)]] if n_groups else row_group
    key = n = np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for row, b_id, times in row_products(g, by_group):
        held.append(_add_up(group_doc[row_group[row]] << 32 | first.cols[row] << 16 | b_id, times))
        if sum(len(k) for k, _ in held) > max(BLOCK_PRODUCTS, len(key)):
            key, n = _add_up(*(np.concatenate(x) for x in zip((key, n), *held, strict=True)))
            held = []
    if held:
        key, n = _add_up(*(np.concatenate(x) for x in zip((key, n), *held, strict=True)))
    return key >> 32, key & 0xFFFFFFFF, n


def _add_up(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


# --------------------------------------------------------------- Spark


_CHUNK = "docs binary, pairs array<long>, held array<int>"
_DOC = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("n_pairs", pa.int64()),
])


def _pack(docs: pa.RecordBatch, at: np.ndarray, times: np.ndarray) -> bytes:
    """A chunk's documents and, of each, where its pairs stand among the chunk's and how often they are linked."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_batch(docs)
    wide = times.max(initial=0) >= 2**32
    body = [sink.getvalue().to_pybytes(), at.astype("<u4").tobytes(), times.astype("<u8" if wide else "<u4").tobytes()]
    head = np.array([len(body[0]), len(at), 8 if wide else 4], "<u8").tobytes()
    return zlib.compress(head + b"".join(body), 1)


def _unpack(data: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    data = zlib.decompress(data)
    size, n, width = np.frombuffer(data, "<u8", 3).tolist()
    docs = pa.ipc.open_stream(data[24 : 24 + size]).read_next_batch()
    return docs, np.frombuffer(data, "<u4", n, 24 + size), np.frombuffer(data, f"<u{width}", n, 24 + size + 4 * n).astype(np.int64)


def _aligned_rows(texts: list[str], path_a: str, path_b: str) -> tuple[list, np.ndarray, np.ndarray]:
    """Columns of ``_DOC`` after the id, and the distinct pairs of each text with their times, text by text."""
    columns, pairs, times = [], [], []
    for block, x in align(texts, *_encoders(path_a, path_b)):
        part = texts[block]
        doc, pair, n = linked_pairs(x)
        first = np.r_[True, x.a_group[1:] != x.a_group[:-1]][: len(x.a)]
        of_doc = np.bincount(np.repeat(np.arange(len(part)), x.n_a)[first], minlength=len(part))
        ends = np.append(0, np.cumsum(n))[np.searchsorted(doc, np.arange(len(part) + 1))]
        columns.append((x.n_a, x.n_b, of_doc, np.diff(ends), np.array(group_digests(x), object), np.bincount(doc, minlength=len(part))))
        pairs.append(pair)
        times.append(n)
    return [np.concatenate(c) for c in zip(*columns, strict=True)], np.concatenate(pairs), np.concatenate(times)


def _chunk_batches(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for chunk in _runs(texts, CHUNK_CHARS):
                columns, pair, times = _aligned_rows(texts[chunk], path_a, path_b)
                keys, at = np.unique(pair, return_inverse=True)
                docs = pa.record_batch([every[chunk], *columns], schema=_DOC)
                yield pa.record_batch({
                    "docs": pa.array([_pack(docs, at, times)], pa.binary()),
                    "pairs": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, pa.int64())),
                    "held": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(np.bincount(at, minlength=len(keys)), pa.int32())),
                })

    return run


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            docs, at, times = _unpack(batch.column("docs")[n].as_py())
            found = batch.column("found")[n].values
            place = np.zeros(0, np.int64) if found is None else found.field("at").to_numpy(zero_copy_only=False)
            count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            if len(place):
                count[place] = found.field("held").to_numpy(zero_copy_only=False)
                best[place] = found.field("best").to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(docs.column("n_pairs").to_numpy()))

            def total(v: np.ndarray, ends: np.ndarray = ends) -> np.ndarray:
                return np.diff(np.append(0, np.cumsum(v))[ends])

            yield pa.record_batch(
                [*docs.columns[:5], total(times * best[at]), total(times * count[at]), docs.column("groups_sha256")], names=[f.split()[0] for f in _RESULT.split(", ")]
            )


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link joins two tokens, one of each side, of one group.  An id pair's
    count is the number of rows that hold it linked; ``count_sum`` adds the
    counts of all a row's links, ``n_best`` counts the links whose pair has its
    first id's highest count, ties included.  Null and empty texts, and texts
    that either side does not spell again, have zeros and an empty digest.  Null
    ids stay null; repeated rows count as documents of their own; an empty
    table gives no rows.  Both paths must name the same files on every executor.
    """
    spark = docs.sparkSession
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    path = scratch_path(spark, "align-chunks")
    cut = src.mapInArrow(_chunk_batches(path_a, path_b), _CHUNK).withColumn("chunk", F.monotonically_increasing_id())
    # Small row groups: the reader takes whole ones, and a row here is a chunk.
    cut.write.option("parquet.block.size", str(16 << 20)).parquet(path)
    chunks = spark.read.schema(cut.schema).parquet(path)
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x"))
    pairs = pairs.select("chunk", "at", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = materialise(pairs.groupBy("pair").agg(F.sum("held").alias("n")), "align-counts")
    # As many rows as the first vocabulary has ids, at most.
    highest = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("top"))
    rated = counts.join(highest, F.shiftright("pair", 16) == F.col("a"))
    rated = materialise(rated.select(F.col("pair").alias("rated"), "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "align-rated")
    found = pairs.select("chunk", "at", "pair").join(rated, F.col("pair") == F.col("rated"))
    # A chunk's list is bounded by the chunk's own text.
    lists = found.groupBy(F.col("chunk").alias("of_chunk")).agg(
        F.collect_list(F.struct(F.col("at").cast("long").alias("at"), F.col("n").alias("held"), "best")).alias("found")
    )
    back = chunks.select("chunk", "docs").join(lists, F.col("chunk") == F.col("of_chunk"), "left")
    return back.select("docs", "found").mapInArrow(_count_batches, _RESULT)


# --------------------------------------------------------------- links themselves

_LINK = "doc_id long, a_pos long, a_id long, b_pos long, b_id long, group long, shared_bytes long"


def _link_batches(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            runs = ((chunk, texts[chunk]) for chunk in _runs(texts, CHUNK_CHARS))
            for ids, x in ((every[chunk][block], x) for chunk, part in runs for block, x in align(part, *_encoders(path_a, path_b))):
                if not len(x.a):
                    continue
                n_groups = int(x.a_group[-1]) + 1
                ones = np.ones(len(x.a), np.int64)
                g = Csr(np.arange(len(x.a) + 1), x.a_group, ones, n_groups)
                h = Csr(np.searchsorted(x.b_group, np.arange(n_groups + 1)), np.arange(len(x.b)), np.ones(len(x.b), np.int64), len(x.b))
                doc = np.repeat(np.arange(len(ids)), x.n_a)
                a_first, b_first = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
                i0, j0, shared0 = x.links
                known = i0 * len(x.b) + j0
                numbers, missing = np.array([i if i is not None else 0 for i in ids], np.int64), np.array([i is None for i in ids])
                group_first = x.a_group[np.minimum(a_first, len(x.a) - 1)]
                for i, j, _ in row_products(g, h):
                    at = np.minimum(np.searchsorted(known, i * len(x.b) + j), len(known) - 1)
                    shared = np.where(known[at] == i * len(x.b) + j, shared0[at], 0)
                    d = doc[i]
                    yield pa.record_batch(
                        [pa.array(numbers[d], mask=missing[d]), i - a_first[d], x.a[i].astype(np.int64), j - b_first[d], x.b[j].astype(np.int64),
                         x.a_group[i] - group_first[d], shared],
                        names=[f.split()[0] for f in _LINK.split(", ")],
                    )

    return run


def token_links(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All shared-group links of every row, by token positions and ids; ``shared_bytes`` above 0: an overlap link."""
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    return src.mapInArrow(_link_batches(path_a, path_b), _LINK)
