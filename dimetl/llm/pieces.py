"""SentencePiece encoding and decoding by suffix-array matching.

The vocabulary is that of a public SentencePiece BPE model with byte fallback.
The distinct words of a batch are concatenated and indexed by a suffix array
(to the depth of the longest piece).  Every piece is binary-searched for the
range of suffixes that start with it; the ranges give all edges (start, end,
piece), which are sorted by position and relaxed from left to right.

The relaxation keeps, for each position, the last piece of the encoding of the
text before it.  An edge continues that encoding exactly when its piece and
the last piece stay as they are when their joined text is encoded by merges;
then, and only then, no merge crosses the boundary in the whole text.  So one
edge survives per position and the result equals the merge algorithm's.
Characters outside the vocabulary become byte pieces.

Words longer than a window (texts without spaces) are encoded as overlapping
windows, all at once.  Two windows that share a piece at the same place are
joined there: every neighbour in the joined chain fits, so it is the one
encoding of the joined text.  Where windows share no piece, the later ones are
moved once to begin where a piece of the first ends; those that still share
none are encoded again as one, so the result is the same for any text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import id_col, text_or_empty
from dimetl.llm.idcache import IdCache

SPACE = "▁"
#: Characters of new words that are indexed at once.
INDEX_CHARS = 1 << 18
#: Words of more characters are encoded in windows of so many, of which two neighbours share OVERLAP. Their
#: distance, 1,680, is a multiple of most piece lengths, so that windows in a run of one sign fall into step.
WINDOW = 1808
OVERLAP = 128
#: Leads a word that follows the one before it without a space.
JOINED = "\x02"
#: Letters and signs between which texts are cut where the vocabulary never joins them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "\n.,!?;:*%&$#|()\"'-_/=+"
#: Rank of two parts that are no piece together.
NO_MERGE = float("-inf")
#: Slots of the table of pairs of pieces known to fit or not.
PAIR_SLOTS = 1 << 21


class Vocabulary:
    """Pieces of a model file: ids, merge ranks and byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.silent = {i for i in range(size) if model.is_control(i)}
        self.unknown = model.unk_id()
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(size) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        plain = [i for i in range(size) if not special[i] and i not in self.byte_of]
        self.rank = {self.pieces[i]: model.get_score(i) for i in plain}
        self.id_of = {self.pieces[i]: i for i in plain}
        if len(self.byte_id) != 256:
            raise ValueError(f"{path}: not a model with byte fallback")
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError(f"{path}: a piece has a character that is no piece")
        #: No merge crosses from a word to the next if a space only leads pieces.
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in self.id_of)
        self.depth = max(map(len, self.id_of))
        joined = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        letter = re.compile(f"[{_LETTERS}]")
        apart = [c for c in _SIGNS if not any(j[1] == c and letter.match(j[0]) for j in joined)]
        signs = f"[{re.escape(''.join(apart))}]" if apart else "(?!)"
        #: Places inside a text that no merge crosses, besides the spaces: before a sign behind a letter, behind a line end.
        self.sign_cut = re.compile(f"{signs}(?<=[{_LETTERS}]{signs})" if apart else signs)
        self.line_cut = re.compile("(?!)" if any("\n" in p for p in self.id_of) else r"\n(?=[^ ])")

    def merged(self, text: str) -> list[str]:
        """Encoding by merges: the best-ranked adjacent pair first, the leftmost of equals."""
        rank, parts = self.rank, list(text)
        ranks = [rank.get(a + b, NO_MERGE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := max(ranks)) != NO_MERGE:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] + parts[i + 1], NO_MERGE)
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] + parts[i], NO_MERGE)
        return parts


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the first ``depth`` codes from each, by doubling the sorted length."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    return np.argsort(rank, kind="stable")


def occurrence_ranges(codes: np.ndarray, suffixes: np.ndarray, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pattern (rows of codes, padded) the range of suffixes that start with it, by binary search per character."""
    padded = np.concatenate([codes, np.zeros(patterns.shape[1], codes.dtype)])
    low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(suffixes), np.int64)
    for d in range(patterns.shape[1]):
        live = np.flatnonzero((sizes > d) & (low < high))
        if not len(live):
            break
        want = patterns[live, d]
        bounds = []
        for beyond in (False, True):
            a, b = low[live].copy(), high[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                got = padded[suffixes[np.minimum(mid, len(suffixes) - 1)] + d]
                right = open_ & ((got <= want) if beyond else (got < want))
                a = np.where(right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            bounds.append(a)
        low[live], high[live] = bounds
    return low, high


class PieceEncoder:
    """Encodes and decodes texts with a vocabulary; one per Python worker."""

    def __init__(self, path: str, max_words: int = 400_000):
        self.vocabulary = v = Vocabulary(path)
        self.cache = IdCache(self._learn, max_words)
        # Direct-mapped table of checked pairs: a slot holds the last pair that fell into it.
        self.pair_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(PAIR_SLOTS, bool)
        ids = sorted(v.id_of.values())
        self.sizes = np.array([len(v.pieces[i]) for i in ids])
        self.ids = np.array(ids)
        self.patterns = np.zeros((len(ids), v.depth), np.uint32)
        for row, i in zip(self.patterns, ids, strict=True):
            row[: len(v.pieces[i])] = [ord(c) for c in v.pieces[i]]
        # Decoding table: text of each id; bytes are put together separately.
        self.texts = np.array(["" if i in v.silent else p.replace(SPACE, " ") for i, p in enumerate(v.pieces)], object)
        self.texts[v.unknown] = " ⁇ "
        self.byte_ids = np.array([v.byte_id[b] for b in range(256)])
        self.is_byte = np.zeros(v.size, bool)
        self.is_byte[list(v.byte_of)] = True

    # ----------------------------------------------------------- encoding

    def _words(self, text: str) -> list[str]:
        """Words whose joined text, with a space before each but the joined ones, is the text; no merge leaves a word."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if not self.vocabulary.words_apart:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in re.findall(" +[^ ]+| +", " " + text)]
        text = self.vocabulary.sign_cut.sub(rf" {JOINED}\g<0>", text)
        return self.vocabulary.line_cut.sub(rf"\g<0> {JOINED}", text).split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._words(t) if JOINED not in t else [] for t in texts]
        long = [n for n, words in enumerate(split) if max(map(len, words), default=0) > WINDOW]
        held = {n: split[n] for n in long}
        for n in long:
            split[n] = []
        out = self.cache.encode(split)
        for n, words in held.items():
            out[n] = self._encode_mixed(words)
        for n, t in enumerate(texts):
            if JOINED in t:  # the mark itself is in the text: one word, past the cache
                out[n] = self._encode_long(SPACE + t.replace(" ", SPACE))
        return out

    def _encode_mixed(self, words: list[str]) -> np.ndarray:
        """Ids of a text with long words, which go past the cache."""
        out, short = [], []
        for w in words:
            if len(w) > WINDOW:
                out += [*self.cache.encode([short]), self._encode_long(_spelled(w))]
                short = []
            else:
                short.append(w)
        return np.concatenate([*out, *self.cache.encode([short])])

    def _encode_long(self, text: str) -> np.ndarray:
        """Ids of one word of any length, from overlapping windows joined at pieces that they share."""
        step = WINDOW - OVERLAP
        spans = [(a, min(a + WINDOW, len(text))) for a in range(0, max(len(text) - OVERLAP, 1), step)]
        chains: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        moved = False
        while True:
            self._add_chains(text, [s for s in spans if s not in chains], chains)
            joints = [_shared(chains[a], chains[b]) for a, b in zip(spans, spans[1:], strict=False)]
            apart = [n for n, joint in enumerate(joints) if joint is None]
            if not apart:
                break
            spans = _united(spans, apart) if moved else _moved(spans, apart, chains)
            moved = True
        ids, codes, first = [], [], 0
        for span, joint in zip(spans, [*joints, None], strict=True):
            _, _, piece, code = chains[span]
            stop, after = joint or (len(piece), 0)
            ids.append(piece[first:stop])
            codes.append(code[first:stop])
            first = after
        return self._with_bytes(np.concatenate(ids), np.concatenate(codes))[0].astype(np.uint32)

    def _add_chains(self, text: str, spans: list[tuple[int, int]], chains: dict) -> None:
        """Pieces of each span of the text: where they begin and end, the pieces, their last characters."""
        while spans:
            take, chars = 0, 0
            while take < len(spans) and (not take or chars + spans[take][1] - spans[take][0] <= INDEX_CHARS):
                chars += spans[take][1] - spans[take][0]
                take += 1
            now, spans = spans[:take], spans[take:]
            begins, ends, piece, codes, stops = self._chain([text[a:b] for a, b in now])
            bounds = np.searchsorted(ends, stops, side="right").tolist()
            starts = [0, *(stops[:-1] + 1).tolist()]
            for (a, b), low, high, start in zip(now, [0, *bounds], bounds, starts, strict=False):
                shift = a - start
                chains[a, b] = begins[low:high] + shift, ends[low:high] + shift, piece[low:high], codes[low:high]

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes, part, chars = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [], 0
        for n, w in enumerate(words):
            part.append(_spelled(w))
            chars += len(part[-1]) + 1
            if chars >= INDEX_CHARS or n == len(words) - 1:
                found, counts = self._encode_words(part)
                ids.append(found)
                sizes.append(counts)
                part, chars = [], 0
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row and their counts."""
        _, ends, piece, codes, stops = self._chain(words)
        flat, width = self._with_bytes(piece, codes)
        word = np.searchsorted(stops, ends)
        return flat.astype(np.uint32), np.bincount(word, weights=width, minlength=len(stops)).astype(np.int64)

    def _chain(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Pieces of the words in a row: where they begin and end, the pieces, their last characters; and where words stop."""
        joined = "\0".join(words) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) - 1
        starts = stops - sizes
        # All edges: the ranges of suffixes that start with each piece.
        suffixes = suffix_array(codes, self.vocabulary.depth)
        low, high = occurrence_ranges(codes, suffixes, self.patterns, self.sizes)
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = suffixes[np.repeat(low[hit], counts) + within].astype(np.int32)
        piece = np.repeat(self.ids[hit], counts).astype(np.int32)
        size = np.repeat(self.sizes[hit], counts).astype(np.int32)
        # Characters that are no piece get an edge of their own.
        covered = np.zeros(len(codes), bool)
        covered[begin[size == 1]] = True
        covered[stops] = True
        lone = np.flatnonzero(~covered).astype(np.int32)
        begin = np.concatenate([begin, lone])
        end = np.concatenate([begin[: len(size)] + size, lone + 1])
        piece = np.concatenate([piece, np.full(len(lone), self.vocabulary.size, np.int32)])
        last, previous = self._relax(begin, end, piece, starts, sizes, len(codes))
        ends = _read_back(previous, starts, stops)
        return previous[ends], ends, last[ends], codes[ends - 1], stops

    def _relax(self, begin: np.ndarray, end: np.ndarray, piece: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Last piece before each position and where it begins; all words advance together, by end position."""
        origin = np.repeat(starts, sizes + 1)
        place = end - origin[begin]  # position in the word
        order = np.argsort(place.astype(np.uint16) if sizes.max(initial=0) < 1 << 16 else place, kind="stable")
        begin, end, piece = begin[order], end[order], piece[order]
        bounds = np.flatnonzero(np.diff(place[order], prepend=-1))
        last, previous = np.full(n + 1, -1, np.int64), np.zeros(n + 1, np.int64)
        last[starts] = self.vocabulary.size + 1
        for a, b in zip(bounds, [*bounds[1:], len(order)], strict=True):
            fit = a + np.flatnonzero(self._fits(last[begin[a:b]], piece[a:b]))
            last[end[fit]] = piece[fit]
            previous[end[fit]] = begin[fit]
        return last, previous

    def _fits(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece can follow the last one; unknown pairs are checked once and kept."""
        base = self.vocabulary.size + 2
        keys = last * base + piece
        slots = (keys * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        fits, known = self.pair_fits[slots], self.pair_key[slots] == keys
        if not known.all():
            miss = np.flatnonzero(~known)
            new, where = np.unique(keys[miss], return_inverse=True)
            found = np.array([self._fit(k // base, k % base) for k in new.tolist()], bool)
            fits[miss] = found[where]
            new_slots = (new * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
            self.pair_key[new_slots] = new
            # Of new pairs that share a slot the last one written holds it; its answer goes with it.
            held = self.pair_key[new_slots] == new
            self.pair_fits[new_slots[held]] = found[held]
        return fits

    def _fit(self, last: int, piece: int) -> bool:
        """Whether ``piece`` can follow ``last``: merges over the joined text leave both as they are."""
        v = self.vocabulary
        if piece == v.size or last == v.size:
            # Beside an outside character a piece only has to be its own encoding.
            other = last if piece == v.size else piece
            return other >= v.size or v.merged(v.pieces[other]) == [v.pieces[other]]
        if last == v.size + 1:
            return v.merged(v.pieces[piece]) == [v.pieces[piece]]
        return v.merged(v.pieces[last] + v.pieces[piece]) == [v.pieces[last], v.pieces[piece]]

    def _with_bytes(self, ids: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids with characters outside the vocabulary as byte pieces, and the ids made of each."""
        outside = ids == self.vocabulary.size
        code = np.where(outside, codes, 0).astype(np.int64)
        width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        flat = np.repeat(ids, width)
        first = np.cumsum(width) - width
        for k in range(4):
            some = np.flatnonzero(outside & (width > k))
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[width[some]] if k == 0 else 0x80
            bits = code[some] >> (6 * (width[some] - 1 - k)) & np.where(k == 0, 0xFF, 0x3F)
            flat[first[some] + k] = self.byte_ids[lead | bits]
        return flat, width

    # ----------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: pieces with spaces restored, byte runs as UTF-8, the leading space dropped."""
        if not self.is_byte[ids].any():
            text = "".join(self.texts[ids])
        else:
            out, run = [], bytearray()
            for i in ids.tolist():
                if i in self.vocabulary.byte_of:
                    run.append(self.vocabulary.byte_of[i])
                    continue
                if run:
                    out.append(_utf8(run))
                    run = bytearray()
                out.append(self.texts[i])
            text = "".join(out) + _utf8(run)
        return text[1:] if text.startswith(" ") else text


def _spelled(word: str) -> str:
    """A word of ``_words`` with its leading space, if it has one, as the vocabulary spells it."""
    return word[1:] if word[:1] == JOINED else SPACE + word.replace(" ", SPACE)


def _read_back(previous: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Ends of the words' pieces, in order."""
    at = []
    here = stops.copy()
    live = np.flatnonzero(here > starts)
    while len(live):
        at.append(here[live])
        here[live] = previous[here[live]]
        live = live[here[live] > starts[live]]
    return np.sort(np.concatenate(at)) if at else np.zeros(0, np.int64)


def _shared(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[int, int] | None:
    """``(pieces of a, pieces of b)`` up to the end of the first piece that both chains have at one place; None without one."""
    low = int(np.searchsorted(a[0], b[0][0]))
    high = int(np.searchsorted(b[1], a[1][-1], side="right"))
    in_b = {(begin, end): n for n, (begin, end) in enumerate(zip(b[0][:high].tolist(), b[1][:high].tolist(), strict=True))}
    for n, place in enumerate(zip(a[0][low:].tolist(), a[1][low:].tolist(), strict=True), low):
        if place in in_b:
            return n + 1, in_b[place] + 1
    return None


def _moved(spans: list[tuple[int, int]], apart: list[int], chains: dict) -> list[tuple[int, int]]:
    """Spans after a joint that failed begin later, by what the first of them lacks to the next piece of the chain before it."""
    failed, out, by = set(apart), [spans[0]], 0
    for n, (begin, end) in enumerate(spans[1:]):
        if n in failed:
            begins = chains[spans[n]][0]
            at = int(np.searchsorted(begins, begin))
            by = int(begins[at]) - begin if at < len(begins) else 0
        out.append((begin + by, end))
    return out


def _united(spans: list[tuple[int, int]], apart: list[int]) -> list[tuple[int, int]]:
    """A span with a failed joint takes in those after it, at least as much again as it is long, so that few rounds follow."""
    failed, out, n = set(apart), [], 0
    while n < len(spans):
        begin, end = spans[n]
        last = n
        while last in failed or n in failed and last + 1 < len(spans) and spans[last][1] - begin < 2 * (end - begin):
            last += 1
        out.append((begin, spans[last][1]))
        n = last + 1
    return out


def _utf8(data: bytes) -> str:
    """UTF-8 text; a byte that starts no valid character becomes one replacement character."""
    try:
        return bytes(data).decode("utf-8")
    except UnicodeDecodeError as bad:
        return bytes(data[: bad.start]).decode("utf-8") + "�" + _utf8(data[bad.start + 1 :])


@lru_cache(maxsize=1)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


# --------------------------------------------------------------- Spark

def _encode_batches(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.iloc[i : i + 512]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                    "ids": [x.astype(np.int32) for x in encoder.encode(part["text"].tolist())],
                })

    return run


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every whole text; null and empty texts have no ids, repeated rows are encoded as rows.

    ``model_path`` must name the same file on every executor.
    """
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    return src.mapInPandas(_encode_batches(model_path), "doc_id long, ids array<int>")


def _decode_batches(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        for batch in batches:
            ids = [np.asarray(x if x is not None else [], np.int64) for x in batch["ids"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                "n_ids": [len(x) for x in ids],
                "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                "text": [encoder.decode(x) for x in ids],
            })

    return run


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, text`` of frames ``doc_id, ids``; null ids decode to the empty text.

    The text equals the encoded one, except that U+2581, the model's mark of
    a space, comes back as a space.
    """
    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInPandas(
        _decode_batches(model_path), "doc_id long, n_ids long, ids_crc32 long, text string"
    )
