"""Ids of a byte-level BPE vocabulary through a bounded cache of the ids of words.

The vocabulary's pre-tokenizer splits a text into words before any merge, so
ids of a text are the ids of its parts wherever it is cut between two of those
words.  Cuts are found on bytes, a batch at once, and only where the two bytes
beside the cut prove one whatever stands around them:

* before white space that follows something else, and after a single tab or line
  break before something else (a single space belongs to the word after it);
* between ASCII letters, digits and other signs, but for the letter after an
  apostrophe (``'s`` is one word).

Beside bytes beyond ASCII only the cut before white space is used, and not where
they may end white space of their own.  Parts that no rule cuts are just
longer words.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from dimetl.llm.idcache import IdCache

_SPACE, _BREAK = 32, 10


def _tables() -> tuple[np.ndarray, ...]:
    """``[byte before, byte after]``: a word ends between them, they may end white space beyond ASCII; bytes that end none in ASCII, and that begin none."""
    byte = np.arange(256)
    letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
    digit = (byte >= 48) & (byte <= 57)
    sign = (byte > 32) & (byte < 127) & ~letter & ~digit
    plain = letter | digit | sign
    apostrophe = byte == ord("'")
    breaks = (byte >= 9) & (byte <= 13)
    # Last two, and first, bytes of white space beyond ASCII: U+0085, U+00A0, U+1680, U+180E, U+2000-200B, U+2028, U+2029, U+202F, U+205F, U+3000.
    white = ((byte >= 0x80) & (byte <= 0x8B)) | np.isin(byte, [0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
    white = np.outer(np.isin(byte, [0xC2, 0x9A, 0xA0, 0x80, 0x81]), white)
    begins_dark = plain | ((byte >= 0xC3) & ~np.isin(byte, [0xE1, 0xE2, 0xE3]))
    cut = np.outer(plain | (byte >= 0x80), breaks | (byte == _SPACE)) | np.outer(breaks, plain)
    cut |= np.outer(letter, digit | sign) | np.outer(digit, letter | sign) | np.outer(sign & ~apostrophe, letter) | np.outer(sign, digit)
    return cut.ravel(), white.ravel(), plain | (byte >= 0x80), begins_dark


_CUT, _WHITE, _ENDS_DARK, _BEGINS_DARK = _tables()
_IS_BREAK = np.isin(np.arange(256), [9, 10, 11, 12, 13])


class ByteEncoder:
    """Token ids of texts, equal to the tokenizers library's, without special tokens added.

    ``special_as_text``: the strings of special tokens inside texts are plain
    text; otherwise they become their ids, as by the library's default.
    """

    def __init__(self, path: str, special_as_text: bool, max_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = [] if special_as_text else [t.encode() for t in added.values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of every id (an ordinary entry has one sign for each byte).
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for entry, i in vocabulary.items():
            self.sizes[i] = len(added[i].encode()) if i in added else len(entry)
        self.cache = IdCache(self._learn, max_words)

    def _ids(self, texts: list[str], at_once: int = 64) -> list[list[int]]:
        # A few strings at a time: the library's results are far larger than their ids.
        parts = (texts[i : i + at_once] for i in range(0, len(texts), at_once))
        return [e.ids for part in parts for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def _learn(self, words: list[bytes], at_once: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words and their counts.

        Words that neither begin (but for one space) nor end with white space
        are encoded many to a string, a line break between them: a single break
        is a word of its own there.  The bytes of each id tell where a word ends.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        first = data[starts + ((data[starts] == _SPACE) & (sizes > 1))]
        last = data[starts + sizes - 1]
        before = data[starts + np.maximum(sizes, 2) - 2] * (sizes > 1)
        plain = _BEGINS_DARK[first] & _ENDS_DARK[last] & ~_WHITE[before.astype(np.uint16) << 8 | last]
        if self.special:
            plain &= ~np.fromiter((any(s in w for s in self.special) for w in words), bool, len(words))
        text = [w.decode("utf-8") for w, p in zip(words, plain.tolist(), strict=True) if p]
        joined = self._ids(["\n".join(text[i : i + at_once]) for i in range(0, len(text), at_once)])
        flat = np.fromiter(chain.from_iterable([*j, -1] for j in joined), np.int64)
        # A break, or the end of a string, is one byte after every word.
        ends, want = np.cumsum(np.where(flat < 0, 1, self.sizes[flat])), np.cumsum(sizes[plain] + 1)
        last = np.searchsorted(ends, want)
        if len(want) and (last[-1] >= len(ends) or not np.array_equal(ends[last], want)):
            raise ValueError("the tokenizer splits words in another way than this cache expects")
        odd = self._ids([w.decode("utf-8") for w, p in zip(words, plain.tolist(), strict=True) if not p])
        counts = np.zeros(len(words), np.int64)
        counts[plain] = np.diff(last, prepend=-1) - 1
        counts[~plain] = list(map(len, odd))
        out = np.zeros(counts.sum(), np.uint32)
        mine = np.repeat(plain, counts)
        out[mine] = np.delete(flat, last)
        out[~mine] = np.fromiter(chain.from_iterable(odd), np.uint32)
        return out, counts

    def _cuts(self, blob: bytes, starts: np.ndarray) -> np.ndarray:
        """Where a part begins in the texts one after the other; ``starts``: where the texts begin."""
        octets = np.frombuffer(blob, np.uint8)
        pairs = octets[:-1].astype(np.uint16) << 8 | octets[1:]
        cut = np.zeros(len(octets) + 1, bool)
        cut[1:-1] = _CUT[pairs]
        cut[2:-1] &= ~_WHITE[pairs[:-1]]
        cut[starts] = True
        # After a break only where the break itself follows a cut: of several white spaces the last is a word of its own.
        cut[1:-1] &= cut[:-2] | ~_IS_BREAK[octets[:-1]]
        cut[starts] = True
        if any(s in blob for s in self.special):
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(blob)], strict=True):
                cut[a + 1 : b] &= not any(s in blob[a:b] for s in self.special)
        cut[-1] = False
        return np.flatnonzero(cut)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        return encode_parts(self.cache, [t.encode("utf-8", "replace") for t in texts], self._cuts)


def encode_parts(
    cache: IdCache, texts: list[bytes], cuts: Callable[[bytes, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts through a cache of the ids of their parts: all ids in a row, and the number of each text's.

    ``cuts`` gives the places where parts begin, those of the texts included.
    Equal parts of the batch are told by Arrow's dictionary encoding, so only
    distinct ones become Python objects.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    blob = b"".join(texts)
    if not blob:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    begins = cuts(blob, starts[sizes > 0])
    offsets = np.append(begins, len(blob)).astype(np.int64)
    parts = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(blob)]).dictionary_encode()
    flat, counts = cache.ids_of(parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy())
    ends = np.append(0, np.cumsum(counts))
    text_ends = ends[np.searchsorted(begins, starts + sizes)]
    return flat, np.diff(text_ends, prepend=0)
