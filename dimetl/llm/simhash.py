"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each
padded with zeros to a word of the perfect binary Golay code [23, 12, 7].  A
word is decoded to the indices (12 bits) of nearby codewords:

* the codeword within distance 3, which is unique, and
* if that distance is exactly 3, also the five codewords at distance 4.

Two words that differ in at most 2 bits always share an index.  (Within
distance 2 of the codeword of one, the other decodes to it too; if not, one of
them lies at distance 3 from its codeword, and the codeword of the pair that
the other one reaches at distance 4 is in its list.)  With at most 4 differing
bits over three segments, some pair of segments holds at most 2 of them, so
the two fingerprints share an index in both segments of that pair.  Keys are
therefore (pair, index, index): up to 3 x 36 keys of 24 bits for a
fingerprint, and no link is lost.  Shared keys only nominate; the bit distance
of the fingerprints decides.

Only distinct fingerprints are keyed.  Buckets of a key are read in streams
of bounded blocks; a bucket over ``block`` members is compared block against
block in separate tasks.  Each task reports a spanning forest of the links it
has found, never all pairs, and the forests are joined to components with
min-label star contractions over DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import OWN, id_col, materialise, text_or_empty
from dimetl.llm.graph import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 2048
#: Segment bounds in the fingerprint, lowest bit first.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


# --------------------------------------------------------------- fingerprints

def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of all word shingles, repeats included; 0 for a text without words.

    ASCII letters are lower-cased, words are split at ASCII white space, a
    text with fewer words than a shingle is one shingle.  A bit is set if it is
    set in over half of the shingles' XXH64 values.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)]
    counts = np.zeros(64, np.int64)
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(octets), 1 << 16):
        counts += np.unpackbits(octets[i : i + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(octets), bitorder="little").view("<u8")[0])


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": prints.view(np.int64)})

    return run


def _fingerprint_column(shingle: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    return run


# --------------------------------------------------------------- Golay code

#: Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_POLY = 0b110001110101


def _remainders(words: np.ndarray) -> np.ndarray:
    """Syndromes: the words, as polynomials, modulo the generator."""
    out = words.astype(np.int64)
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, _POLY << (bit - 11), 0)
    return out


@lru_cache(maxsize=1)
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error pattern, and the index changes to the codewords at distance 4 (for errors of weight 3)."""
    patterns = np.array([sum(1 << b for b in c) for k in range(4) for c in combinations(range(23), k)], np.int64)
    error = np.zeros(2048, np.int64)
    error[_remainders(patterns)] = patterns
    message = np.arange(4096, dtype=np.int64) << 11
    code = message ^ _remainders(message)
    sevens = code[np.bitwise_count(code.astype(np.uint64)) == 7]
    heavy = np.bitwise_count(error.astype(np.uint64)) == 3
    # Codewords of weight 7 that cover the three error positions lie at distance 4 from the word.
    change = np.zeros((2048, 5), np.int64)
    for s in np.flatnonzero(heavy):
        change[s] = sevens[(sevens & error[s]) == error[s]] >> 11
    return error, heavy, change


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(indices, used)``, both n x 6: indices of the codewords near each 23-bit word."""
    error, heavy, change = _decoder()
    syndrome = _remainders(words)
    first = (words ^ error[syndrome]) >> 11
    indices = np.concatenate([first[:, None], first[:, None] ^ change[syndrome]], axis=1)
    used = np.ones_like(indices, bool)
    used[:, 1:] = heavy[syndrome][:, None]
    return indices, used


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of every key of every fingerprint (uint64); a key is pair << 24 | index << 12 | index."""
    near = [near_indices((prints >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64)) for at, size in SEGMENTS]
    rows, keys = [], []
    for pair, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        (ia, ua), (ib, ub) = near[a], near[b]
        key = (pair << 24) | (ia[:, :, None] << 12) | ib[:, None, :]
        used = ua[:, :, None] & ub[:, None, :]
        rows.append(np.nonzero(used)[0])
        keys.append(key[used])
    return np.concatenate(rows), np.concatenate(keys)


def _key_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(np.int64)
        for i in range(0, len(prints), 4096):
            part = prints[i : i + 4096]
            rows, keys = keys_of(part.view(np.uint64))
            yield pd.DataFrame({"key": keys.astype(np.int32), "fp": part[rows]})


# --------------------------------------------------------------- links

class _Forest:
    """Union-find over the members of one comparison."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def spanning_links(a: np.ndarray, b: np.ndarray, max_bits: int, stride: int = 256) -> np.ndarray:
    """Links (n x 2 fingerprints) between ``a`` and ``b`` that span all their links; ``b is a``: within ``a``."""
    forest, found = _Forest(len(a) + (0 if b is a else len(b))), []
    shift = 0 if b is a else len(a)
    for i in range(0, len(a), stride):
        j0 = i if b is a else 0
        near = np.bitwise_count(a[i : i + stride, None] ^ b[None, j0:]) <= max_bits
        for x, y in zip(*(n.tolist() for n in np.nonzero(near)), strict=True):
            x, y = i + x, j0 + y
            if (b is not a or x < y) and forest.join(x, shift + y):
                found.append((a[x], b[y]))
    return np.array(found, np.uint64).reshape(-1, 2)


def bucket_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Links within the buckets of sorted keys: members are compared at growing offsets, all buckets at once."""
    out, live, step = [], np.arange(len(keys)), 1
    while True:
        live = live[live + step < len(keys)]
        live = live[keys[live] == keys[live + step]]
        if not len(live):
            return np.concatenate(out) if out else np.empty((0, 2), np.uint64)
        near = live[np.bitwise_count(prints[live] ^ prints[live + step]) <= max_bits]
        out.append(np.stack([prints[near], prints[near + step]], axis=1))
        step += 1


_LINK_SCHEMA = "a long, b long"
_WIDE = 64


def _frame(links: np.ndarray) -> pd.DataFrame:
    links = np.unique(links, axis=0).view(np.int64)
    return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def _bucket_batches(max_bits: int):
    """Rows come sorted by key; a bucket that spans batches is carried over (buckets are bounded by ``block``)."""

    def compare(keys: np.ndarray, prints: np.ndarray) -> pd.DataFrame:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        wide = sizes > _WIDE
        small = np.repeat(~wide, sizes)
        links = [bucket_links(keys[small], prints[small], max_bits)]
        for s, n in zip(starts[wide].tolist(), sizes[wide].tolist(), strict=True):
            part = prints[s : s + n]
            links.append(spanning_links(part, part, max_bits))
        return _frame(np.concatenate(links))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, prints = np.empty(0, np.int32), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy(np.int32)])
            prints = np.concatenate([prints, batch["fp"].to_numpy(np.int64).view(np.uint64)])
            if len(keys):
                done = int(np.searchsorted(keys, keys[-1], side="left"))
                if done:
                    yield compare(keys[:done], prints[:done])
                keys, prints = keys[done:], prints[done:]
        if len(keys):
            yield compare(keys, prints)

    return run


def _block_pair(max_bits: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a = left["fp"].to_numpy(np.int64).view(np.uint64)
        b = right["fp2"].to_numpy(np.int64).view(np.uint64)
        if not len(a) or not len(b):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        same = left["i"].iloc[0] == left["j"].iloc[0]
        return _frame(spanning_links(a, a if same else b, max_bits))

    return run


def links_of(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all within ``max_bits`` (4 at most).

    Not every link is returned, but the links returned have the same connected
    components as all links.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys are exact up to {MAX_BITS} bits, not {max_bits}")
    keyed = prints.select("fp").mapInPandas(_key_batches, "key int, fp long")
    big = materialise(keyed.groupBy("key").count().filter(F.col("count") > block), "simhash-big-buckets")
    if big.isEmpty():
        normal = keyed
    else:
        normal = keyed.join(big, "key", "left_anti")
    # On a mapInPandas output the sort within partitions streams; a bucket never crosses partitions.
    found = normal.repartition("key").sortWithinPartitions("key").mapInPandas(_bucket_batches(max_bits), _LINK_SCHEMA)
    if not big.isEmpty():
        # Hot buckets: blocks of at most about ``block`` members, every pair of blocks once.
        blocks = F.ceil(F.col("count") / block).cast("int")
        members = keyed.join(big.withColumn("blocks", blocks), "key").withColumn("at", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        left = members.withColumn("j", F.explode(F.sequence(F.col("at"), F.col("blocks") - 1))).select("key", F.col("at").alias("i"), "j", "fp")
        right = members.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("at")))).select("key", "i", "at", "fp")
        right = right.toDF("key2", "i2", "j2", "fp2")
        hot = left.groupBy("key", "i", "j").cogroup(right.groupBy("key2", "i2", "j2")).applyInPandas(_block_pair(max_bits), _LINK_SCHEMA)
        found = found.unionByName(hot)
    return found.distinct()


# --------------------------------------------------------------- operator

def near_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; ``fp`` is the fingerprint as a signed long.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; ``component_id`` is the smallest id reachable.  Null and empty
    texts have fingerprint 0 and link like any other.  Null ids keep their row
    and never name a component (which is null if all its ids are).  Repeated
    rows stay rows; an empty table gives an empty result.
    """
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    prints = materialise(src.mapInPandas(_fingerprint_batches(shingle), "doc_id long, fp long"), "simhash-prints")
    named = _components(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), max_bits, block)
    # Written before they meet the fingerprints, so that AQE can split a component of very many.
    smallest = materialise(named.groupBy("comp").agg(F.min("rep").alias("component_id")).withColumnRenamed("comp", "of"), "simhash-smallest")
    by_class = named.join(smallest, F.col("comp") == F.col("of")).select(F.col("fp").alias("class_fp"), "component_id")
    by_class = materialise(by_class, "simhash-by-class")
    return prints.join(by_class, prints["fp"] == by_class["class_fp"]).select("doc_id", "fp", "component_id")


def _components(classes: DataFrame, max_bits: int, block: int) -> DataFrame:
    """``classes`` (distinct ``fp`` and ``rep``) with ``comp``, the smallest fingerprint linked to each; written."""
    classes = materialise(classes, "simhash-classes")
    links = materialise(links_of(classes, max_bits, block), "simhash-links")
    linked = components(links)
    # Components are few links' worth of fingerprints; every other class is its own component.
    named = classes.join(linked, classes["fp"] == linked["node"], "left")
    return materialise(named.select("fp", "rep", F.coalesce("component", "fp").alias("comp")), "simhash-components")


def hex_digits(signed: str = "fp"):
    """A signed fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(signed)), 16, "0"))


def one_of_each(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest id.

    Rows are told apart by a number of their own, not by their id: an id that
    occurs with several texts stays once for each component it stands for, and
    of equal rows, or rows without any id, one stays.  A row without an id stays
    only where its component has no id at all.
    """
    own = f"{OWN}uid", f"{OWN}fp"
    number = F.pandas_udf(_fingerprint_column(shingle), "long")(text_or_empty(text_column))
    rows = materialise(docs.withColumns({own[1]: number, own[0]: F.monotonically_increasing_id()}), "simhash-rows")
    first = F.min(F.struct(id_col(id_column).isNull().alias("no_id"), id_col(id_column).alias("id"), F.col(own[0]).alias("uid")))
    # The first row of each fingerprint, then of each component.
    named = _components(rows.groupBy(F.col(own[1]).alias("fp")).agg(first.alias("rep")), max_bits, block)
    stay = materialise(named.groupBy("comp").agg(F.min("rep").alias("rep")).select(F.col("rep.uid").alias("stay")), "simhash-stay")
    return rows.join(stay, F.col(own[0]) == F.col("stay"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
