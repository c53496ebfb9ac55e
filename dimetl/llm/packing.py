"""Best-fit packing of tokenised documents into sequences, with swap-based local search.

Every document is tokenised whole and ends with an end token.  Only documents
longer than a sequence are cut.  Pieces are dealt by hash to groups of bounded
size; in a group, full pieces are sequences already, the others are placed by
best fit, longest first, and then a local search moves pieces between
underfull bins, one for none, one for one or two for one, always so that the sum
of squared fills grows, until bins are empty or no move is left.
The bins that stay underfull in any group are dealt to fewer groups and packed
once more, so the loss does not grow with the number of groups.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import id_col, materialise, text_or_empty
from dimetl.llm.idcache import IdCache

LENGTH = 4096
END_ID = 1
GROUP_PIECES = 4096
#: Bins with more free tokens than this after the first round are packed again.
SLACK = 16


# --------------------------------------------------------------- tokens

#: Class of each byte for splitting words as the tokenizer does: letters, single digits, runs of other signs.
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = _LETTER
_CLASS[list(range(ord("0"), ord("9") + 1))] = _DIGIT
_CLASS[ord(" ")] = 0


class WordEncoder:
    """Token ids of texts through a bounded cache of the ids of words.

    The tokenizer drops white space and never merges across it, so a text's
    ids are the ids of its white-space separated words, in order.  Words are
    split at ASCII white space only; other white space stays inside a word,
    where the tokenizer treats it itself.  ASCII letters are lower-cased
    before the lookup, as the tokenizer does, except in texts that may hold
    one of its special tokens, whose spelling is case-sensitive.
    """

    def __init__(self, path: str, max_words: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache = IdCache(self._learn, max_words)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes], at_once: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words and their counts.

        Plain words (ASCII signs and Latin-1 letters, no apostrophe or ``<``)
        are encoded many to a string; the number of parts the tokenizer splits
        each into tells where its ids end, as a part's last id alone ends a
        word.  Other words are encoded one by one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(b" ".join(words), np.uint8)
        before = np.concatenate([[np.uint8(32)], data[:-1]])
        kind = _CLASS[data]
        begins = (kind != 0) & ((kind != _CLASS[before]) | (kind == _DIGIT))
        latin = (data == 0xC3) | ((before == 0xC3) & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7))
        strange = ((data >= 0x7F) & ~latin) | (data < 0x20) | (data == ord("'")) | (data == ord("<"))
        plain = np.add.reduceat(strange.astype(np.int64), starts) == 0
        parts = np.add.reduceat(begins.astype(np.int64), starts)[plain]
        text = [w.decode("utf-8") for w, p in zip(words, plain.tolist(), strict=True) if p]
        joined = self._ids([" ".join(text[i : i + at_once]) for i in range(0, len(text), at_once)])
        flat = np.fromiter(chain.from_iterable(joined), np.uint32)
        ends = np.flatnonzero(self.is_last[flat]) + 1
        if len(ends) != parts.sum():
            raise ValueError("the tokenizer splits words in another way than this cache expects")
        odd = self._ids([w.decode("utf-8", "replace") for w, p in zip(words, plain.tolist(), strict=True) if not p])
        counts = np.zeros(len(words), np.int64)
        counts[plain] = np.diff(ends[np.cumsum(parts) - 1], prepend=0)
        counts[~plain] = list(map(len, odd))
        out = np.zeros(counts.sum(), np.uint32)
        own = np.repeat(plain, counts)
        out[own], out[~own] = flat, np.fromiter(chain.from_iterable(odd), np.uint32)
        return out, counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens added."""
        split = []
        for t in texts:
            data = t.encode("utf-8", "replace")
            split.append((data if b"<|" in data else data.lower()).split())
        return self.cache.encode(split)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per Python worker."""
    return WordEncoder(path)


def pieces_of(ids: np.ndarray, length: int = LENGTH, end_id: int = END_ID) -> list[tuple[int, int, int, int]]:
    """``(piece, start, length, crc32)`` of a document's ids with the end token added."""
    every = np.append(ids, np.uint32(end_id)).astype("<u4")
    return [(n, s, len(every[s : s + length]), zlib.crc32(every[s : s + length].tobytes())) for n, s in enumerate(range(0, len(every), length))]


def _piece_batches(path: str, length: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.iloc[i : i + 1024]
                rows = [
                    (doc_id, *piece)
                    for doc_id, ids in zip(part["doc_id"].astype("Int64"), encoder.encode(part["text"].tolist()), strict=True)
                    for piece in pieces_of(ids, length, end_id)
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return run


# --------------------------------------------------------------- bins

def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; items are placed in the given order, each in the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0  # bit f: some bin has f free tokens
    for item, size in enumerate(lengths):
        fitting = open_sizes >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_sizes ^= 1 << free
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        left = free - size
        if left:
            if not by_free[left]:
                open_sizes |= 1 << left
            by_free[left].append(b)
    return bins


def _gain(source: list[tuple[int, int]], target: list[tuple[int, int]], source_fill: int, target_fill: int, capacity: int):
    """Best exchange from ``source`` into ``target``: (tokens moved, items out of source, items out of target), or None.

    Items are (length, number), sorted.  The target must grow and stay within
    capacity, and the sum of squared fills must increase.
    """
    free = capacity - target_fill
    least = max(0, source_fill - target_fill)  # an exchange moves more than this
    if free <= least:
        return None
    best, found = least, None
    largest = target[-1][0] if target else 0
    for i, x in enumerate(source):
        size = x[0]
        if best < size <= free:
            best, found = size, ((x,), ())
        # The smallest target item that makes room for x gives the largest exchange.
        if size - free <= largest:
            y = target[bisect_left(target, (size - free, -1))]
            if best < size - y[0]:
                best, found = size - y[0], ((x,), (y,))
        for z in source[i + 1 :]:
            both = size + z[0]
            if both - free > largest:
                break
            y = target[bisect_left(target, (both - free, -1))]
            if best < both - y[0]:
                best, found = both - y[0], ((x, z), (y,))
        if best == free:
            break
    return found and (best, *found)


def fewest_bins(lengths: list[int], capacity: int) -> int:
    """A number of bins that no packing goes below.

    The largest of: all lengths over the capacity; and, for each m, one bin for
    every m items of which no bin holds more than m (longer than a part m + 1 of it).
    """
    size = np.sort(np.array(lengths, np.int64))[::-1]
    if not len(size):
        return 0
    best = -(-int(size.sum()) // capacity)
    for m in range(1, capacity // max(int(size[-1]), 1) + 1):
        count = int(np.searchsorted(-size, -(capacity // (m + 1)), side="left"))
        best = max(best, -(-count // m))
        if count == len(size):
            break
    return best


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty bins into the others by exchanges between underfull bins that increase the squared fill.

    Every pass offers the items of every underfull bin, emptiest first, to all
    others, fullest first; pairs of bins that are as they were when they were
    last tried are left out, and a bin of one item is offered only what fits
    beside it, since no swap with it can gain.  It ends when the bins are as few
    as ``fewest_bins``, or when no pair of bins has an exchange left.
    """
    done = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    rest = [sorted((lengths[i], i) for i in b) for b in bins]
    rest = [b for b in rest if sum(x[0] for x in b) < capacity]
    fills = [sum(x[0] for x in b) for b in rest]
    # Number of the exchange that changed a bin last, and of the last one before the bin was offered to all others.
    moves, changed, offered = 0, [0] * len(rest), [-1] * len(rest)
    spare = len(rest) - fewest_bins([x[0] for b in rest for x in b], capacity)
    moved = True
    while moved and spare:
        moved = False
        for s in sorted((n for n, f in enumerate(fills) if 0 < f < capacity), key=fills.__getitem__):
            if not 0 < fills[s] < capacity:
                continue
            since, offered[s] = offered[s], moves
            fresh = changed[s] > since
            smallest = rest[s][0][0]
            targets = [
                n for n, f in enumerate(fills)
                if 0 < f < capacity and n != s and (fresh or changed[n] > since) and (len(rest[n]) > 1 or smallest <= capacity - f)
            ]
            for t in sorted(targets, key=lambda n: -fills[n]):
                while rest[s] and (found := _gain(rest[s], rest[t], fills[s], fills[t], capacity)):
                    d, out, back = found
                    for x in out:
                        rest[s].remove(x)
                        insort(rest[t], x)
                    for x in back:
                        rest[t].remove(x)
                        insort(rest[s], x)
                    moves += 1
                    fills[s], fills[t], changed[s], changed[t], moved = fills[s] - d, fills[t] + d, moves, moves, True
                if not rest[s]:
                    spare -= 1
                    break
            if not spare:
                break
    return done + [[i for _, i in b] for b in rest if b]


def pack_group(lengths: list[int], capacity: int = LENGTH) -> list[list[int]]:
    """Bins of item numbers for one group of pieces."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    placed = best_fit([lengths[i] for i in order], capacity)
    return local_search([[order[i] for i in b] for b in placed], lengths, capacity)


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, sequence_id long, offset long, free long"


def _pack_frame(round_no: int, capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", kind="stable").reset_index(drop=True)
        lengths = group["length"].tolist()
        sequence, offset, free = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        high = (round_no << 60) | int(group["g"].iloc[0]) << 24
        for n, items in enumerate(pack_group(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = high | n, at
                at += lengths[i]
            free[items] = capacity - at
        out = group.drop(columns="g")
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out.assign(sequence_id=sequence, offset=offset, free=free)

    return run


def _round(pieces: DataFrame, round_no: int, capacity: int, group_pieces: int) -> DataFrame:
    groups = -(-pieces.count() // group_pieces) or 1
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(groups)).cast("int"))
    return dealt.groupBy("g").applyInPandas(_pack_frame(round_no, capacity), _PACKED)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
    slack: int = SLACK,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    ``ids_crc32`` is over the piece's ids as little-endian unsigned 32-bit
    numbers.  A null or empty text is the end token alone; null ids stay null;
    repeated rows are packed as documents of their own; an empty table gives
    no pieces.  ``tokenizer_path`` must name the same file on every executor.
    """
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    cut = src.mapInPandas(
        _piece_batches(tokenizer_path, length, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    # The written table fixes the pieces' numbers, so that a task that runs again deals them alike.
    pieces = materialise(cut.withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    first = materialise(_round(pieces, 0, length, group_pieces), "packing-first")
    again = materialise(first.filter(F.col("free") > slack).select(*pieces.columns), "packing-again")
    second = _round(again, 1, length, group_pieces)
    out = first.filter(F.col("free") <= slack).unionByName(second)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
