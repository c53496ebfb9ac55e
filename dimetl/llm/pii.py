"""Personal data: base patterns plus a character BiLSTM-CRF.

The base spans are the leftmost non-overlapping matches of four patterns with
an exact check each.  The tagger (``tagger.py``) adds spans that the patterns
miss: spaced, dotted, bracketed or spelt-out addresses and numbers.  It learns
from spans labelled by the base rules on a bounded sample, and from copies of
those snippets in which the labelled spans are written in such ways
(``rewritten``).  It reads every text in overlapping windows; pieces of a span
that runs over windows are joined, and the spans of all windows are reconciled
globally: the set of non-overlapping spans with the largest total margin wins,
base spans come first, and an added span must pass its kind's plausibility check,
which reads it back to a plain address or number.

An added span must hold a digit, ``@`` or a spelt-out sign (``_TRIGGER``).  This
is a check of the whole span, not of its windows: the network reads every window
of every text, since a long span may run through windows without such a sign.
It learns from the windows of its sample that hold one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimetl.llm.common import OWN, hash_sample, id_col, materialise, text_or_empty
from dimetl.llm.tagger import Tagger

#: Kinds, in the order that breaks ties of start.
KINDS = ("email", "ip", "card", "phone")
TRAIN_SNIPPETS, TRAIN_STEPS = 1200, 600
SNIPPET_BEFORE, SNIPPET_SIZE = 120, 320
WINDOW, STRIDE = 96, 48

# --------------------------------------------------------------- base rules

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A digit before the start would be part of the match, so the look-behind only saves retries inside a run.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from each ``@``: linear however long a run of address characters is."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            # The run before this @ was tried; a later match cannot start before it.
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))
    return out


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base rules, sorted."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(_octet(p) for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --------------------------------------------------------------- windows and tags

#: Characters with a class of their own; the rest fall into broad classes. Class 0 pads.
_SINGLE = "@.-_+%()/:,;'\"#*&=[]<>\n"
_SPACE, _LOWER, _UPPER, _DIGIT, _WIDE, _OTHER = range(1, 7)
CLASSES = 7 + len(_SINGLE)


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS_OF[np.minimum(codes, 128)]


def _class_table() -> np.ndarray:
    out = np.full(129, _OTHER, np.int8)
    out[128] = _WIDE
    for c in range(128):
        ch = chr(c)
        if ch.islower():
            out[c] = _LOWER
        elif ch.isupper():
            out[c] = _UPPER
        elif ch.isdigit():
            out[c] = _DIGIT
        elif ch.isspace():
            out[c] = _SPACE
    for i, ch in enumerate(_SINGLE):
        out[ord(ch)] = 7 + i
    return out


_CLASS_OF = _class_table()
_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s*@\s*)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*)"
_TRIGGER = re.compile(r"[0-9@]|(?i:\bdot\b)")
#: Every base span holds such a character.
_SIGN = re.compile(r"[0-9@]")


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tag per character: 0 outside, 1 + 2k at the begin of kind k, 2 + 2k inside; earlier spans win overlaps."""
    out = np.zeros(length, np.int8)
    for s, k, e in spans:
        if not out[s:e].any():
            out[s], out[s + 1 : e] = 1 + 2 * k, 2 + 2 * k
    return out


def new_tagger() -> Tagger:
    tags = 1 + 2 * len(KINDS)
    follows = np.ones((tags, tags), bool)
    for k in range(len(KINDS)):
        follows[:, 2 + 2 * k] = False
        follows[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    # A window may begin inside a span that the window before has begun.
    return Tagger(CLASSES, tags, follows, np.ones(tags, bool))


def windows_of(text: str) -> np.ndarray:
    """Character classes of every window (n x WINDOW, padded by 0), one each STRIDE: they tile the whole text with overlap."""
    classes = char_classes(text)
    count = -(-len(classes) // STRIDE)
    if not count:
        return np.zeros((0, WINDOW), np.int8)
    padded = np.zeros(count * STRIDE + WINDOW - STRIDE, np.int8)
    padded[: len(classes)] = classes
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _starts(text: str) -> list[int]:
    """Starts of the windows to learn from: those that hold a trigger."""
    if not _TRIGGER.search(text):
        return []
    found: set[int] = set()
    for m in _TRIGGER.finditer(text):
        last = m.start() // STRIDE
        found.update(s * STRIDE for s in range(max(0, last - (WINDOW - 1) // STRIDE), last + 1) if s * STRIDE + WINDOW > m.start())
    return sorted(found)


_ATS = ("@", " @ ", " at ", " [at] ", "[at]", " (at) ", "(at)", " AT ", "[@]")
_DOTS = (".", " . ", " dot ", " [dot] ", "[dot]", " (dot) ", "[.]", "(.)", " DOT ")
_CARD_SIGNS = (".", "/", "  ", " - ", "_")


def rewritten(text: str, spans: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A copy of the text with its spans written in ways that the base rules miss, and the spans there."""
    out, moved, at = [], [], 0
    for s, kind, e in spans:
        if s < at:
            continue
        out.append(text[at:s])
        word, digits = text[s:e], _NOT_DIGIT.sub("", text[s:e])
        if kind == 0:
            # Of the plain signs at most one stays plain.
            ats, dots = rng.integers(len(_ATS)), rng.integers(len(_DOTS))
            if not ats and not dots:
                dots = 1
            local, _, domain = word.rpartition("@")
            word = local + _ATS[ats] + domain.replace(".", _DOTS[dots])
        elif kind == 1:
            word = word.replace(".", _DOTS[rng.integers(1, len(_DOTS))])
        elif kind == 2:
            word = _CARD_SIGNS[rng.integers(len(_CARD_SIGNS))].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            ten = (digits * 2)[-10:]
            a, b, c = ten[:3], ten[3:6], ten[6:]
            word = (f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00 {digits[:2]} {a} {b} {c}")[rng.integers(6)]
        moved.append((sum(map(len, out)), kind, sum(map(len, out)) + len(word)))
        out.append(word)
        at = e
    return "".join([*out, text[at:]]), moved


def train(snippets: list[str], copies: int = 2) -> Tagger | None:
    """Tagger from labelled spans of the snippets, each read as it is and in ``copies`` rewritten copies; None if they hold none."""
    rng = np.random.default_rng(7)
    labelled = []
    for text in snippets:
        spans = base_spans(text)
        labelled.append((text, spans))
        if spans:
            labelled += [rewritten(text, spans, rng) for _ in range(copies)]
    x, y = [], []
    for text, spans in labelled:
        classes, tags = char_classes(text), tags_of(len(text), spans)
        for s in _starts(text):
            part = slice(s, s + WINDOW)
            x.append(np.pad(classes[part], (0, WINDOW - len(classes[part]))))
            y.append(np.pad(tags[part], (0, WINDOW - len(tags[part]))))
    if not x or not any(t.any() for t in y):
        return None
    tagger = new_tagger()
    tagger.fit(np.array(x, np.int64), np.array(y, np.int64), steps=TRAIN_STEPS)
    return tagger


_PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_LABEL = re.compile(r"(?i:tel|phone|call|mobile|cell|fax|whatsapp)[a-z]{0,8}\W{0,3}\Z")
_PHONE_SHAPE = re.compile(r"(?:\+?1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")


def plain_form(kind: int, text: str) -> str:
    """The span read back: signs spelt out or spaced become plain ones, numbers their digits."""
    if kind in (0, 1):
        text = re.sub(_DOT, ".", text, flags=re.IGNORECASE)
        return re.sub(_AT, "@", text, flags=re.IGNORECASE) if kind == 0 else text
    return _NOT_DIGIT.sub("", text)


def _plausible(kind: int, text: str, before: str = "") -> bool:
    """Checks that keep added spans to likely personal data; ``before`` is the text in front of the span."""
    plain = plain_form(kind, text)
    if kind == 0:
        # Words around "at" and "dot" are an address only if both are spelt out or one is a plain sign.
        return _PLAIN_EMAIL.fullmatch(plain) is not None and len(re.findall(r"[@\[({<]|\bdot\b", text, re.IGNORECASE)) > 0
    if kind == 1:
        parts = plain.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts)
    if kind == 2:
        return 13 <= len(plain) <= 19 and luhn(plain) and len(set(plain)) > 2 and re.fullmatch(r"[0-9]([ ._/-]{0,3}[0-9])+", text) is not None
    # A phone number without a + has the shape of one, an international prefix, or a word for it in front.
    if not 9 <= len(plain) <= 15 or text.isdigit() or not re.fullmatch(r"\+?[\x20().0-9/-]+", text):
        return False
    return bool(_PHONE_SHAPE.fullmatch(text.strip()) or text.startswith(("+", "00 ", "00-")) or _LABEL.search(before))


def _window_batches(texts: list[str], rows_at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text numbers, starts and classes of all windows of the texts, ``rows_at_once`` at a time."""
    numbers, starts, parts, held = [], [], [], 0
    for i, text in enumerate(texts):
        windows, at = windows_of(text), 0
        while at < len(windows):
            part = windows[at : at + rows_at_once - held]
            numbers.append(np.full(len(part), i))
            starts.append(np.arange(at, at + len(part)) * STRIDE)
            parts.append(part)
            at, held = at + len(part), held + len(part)
            if held == rows_at_once:
                yield np.concatenate(numbers), np.concatenate(starts), np.concatenate(parts)
                numbers, starts, parts, held = [], [], [], 0
    if held:
        yield np.concatenate(numbers), np.concatenate(starts), np.concatenate(parts)


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], tagger: Tagger, rows_at_once: int = 4224) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger adds to the base spans of each text."""
    pieces: list[list[tuple[int, int, int, float, bool, bool]]] = [[] for _ in texts]
    for numbers, starts, x in _window_batches(texts, rows_at_once):
        tags, margin = tagger.decode(x)
        for n in tags.any(1).nonzero()[0].tolist():
            i, s, row, gain = int(numbers[n]), int(starts[n]), tags[n], margin[n]
            # A run without a begin at a window's left edge goes on from the window before.
            heads = (row % 2 == 1).nonzero()[0].tolist()
            if s > 0 and row[0] and row[0] % 2 == 0:
                heads.insert(0, 0)
            for begin in heads:
                kind, end = (int(row[begin]) - 1) // 2, begin + 1
                while end < WINDOW and row[end] == 2 + 2 * kind:
                    end += 1
                stop = min(s + end, len(texts[i]))
                open_left, open_right = row[begin] % 2 == 0, end == WINDOW and stop < len(texts[i])
                pieces[i].append((s + begin, kind, stop, float(gain[begin:end].sum()), open_left, open_right))
    found = [joined(p) for p in pieces]
    return [reconcile(t, b, f) for t, b, f in zip(texts, base, found, strict=True)]


def joined(pieces: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Whole spans of pieces ``(start, kind, end, margin, open left, open right)`` in window order.

    A piece cut at a window's right edge goes on in the piece of its kind, cut
    at the left edge, that overlaps it; what stays open on a side is dropped
    (another window holds it whole, or its end was not found).
    """
    out, running = [], []
    for start, kind, end, gain, open_left, open_right in pieces:
        if open_left:
            ahead = next((r for r in running if r[1] == kind and r[0] < start <= r[2] <= end), None)
            if ahead is None:
                continue
            running.remove(ahead)
            start, gain = ahead[0], ahead[3] + gain
        if open_right:
            running.append((start, kind, end, gain))
        else:
            out.append((start, kind, end, gain))
    return out


def reconcile(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Plausible spans off the base spans, non-overlapping with the largest total margin over the whole text."""
    taken: list[list[int]] = []
    for bs, _, be in base:
        if taken and bs < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], be)
        else:
            taken.append([bs, be])
    begins = [t[0] for t in taken]
    keep = {}
    for s, k, e, gain in found:
        near = bisect_left(begins, e) - 1
        free = near < 0 or taken[near][1] <= s
        if free and gain > 0 and _TRIGGER.search(text, s, e) and _plausible(k, text[s:e], text[max(s - 16, 0) : s]):
            keep[s, k, e] = max(gain, keep.get((s, k, e), 0.0))
    # Weighted interval scheduling by span ends.
    spans = sorted(keep, key=lambda x: (x[2], x[0], x[1]))
    ends = [e for _, _, e in spans]
    best, took = [0.0], []
    for n, (s, k, e) in enumerate(spans):
        before = bisect_right(ends, s, 0, n)
        gain = best[before] + keep[s, k, e]
        took.append(before if gain > best[n] else -1)
        best.append(max(gain, best[n]))
    out, n = [], len(spans)
    while n:
        if took[n - 1] >= 0:
            out.append(spans[n - 1])
            n = took[n - 1]
        else:
            n -= 1
    return out[::-1]


# --------------------------------------------------------------- Spark

def _snippet_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each text, the snippet around its first base span of each kind, or around its first digit or @ (kind -1)."""
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
            first: dict[int, int] = {}
            for start, kind, _ in base_spans(text):
                first[kind] = min(start, first.get(kind, start))
            if not first and (m := _TRIGGER.search(text)):
                first[-1] = m.start()
            for kind, start in first.items():
                at = max(start - SNIPPET_BEFORE, 0)
                rows.append((doc_id, kind, text[at : at + SNIPPET_SIZE]))
        out = pd.DataFrame(rows, columns=["doc_id", "kind", "snippet"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def training_snippets(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", limit: int = TRAIN_SNIPPETS) -> list[str]:
    """A bounded sample: the texts around base spans, ``limit`` at most, and around digits and @ of documents without any, a quarter of it at most.

    All documents that hold such a character are read.  Of each kind of base
    span as many snippets are taken, those with the smallest hashes, as far as
    the kinds have them; the rest goes to the other kinds.
    """
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    found = src.mapInPandas(_snippet_batches, "doc_id long, kind int, snippet string")
    hits = materialise(found.select("kind", "snippet", F.xxhash64("snippet").alias("h")), "tagger-snippets")
    # Cut by hash before the order, kind by kind, so that a bounded number of snippets moves; equal ones count once.
    few = [hash_sample(hits.filter(F.col("kind") == k), F.col("h"), limit, 4).distinct() for k in range(-1, len(KINDS))]
    order = Window.partitionBy("kind").orderBy("h", "snippet")
    ranked = reduce(DataFrame.unionByName, few).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= limit)
    rows = ranked.select("kind", "n", "h", "snippet").orderBy("n", "h", "snippet").collect()
    labelled = [r for r in rows if r["kind"] >= 0][:limit]
    plain = [r for r in rows if r["kind"] < 0][: limit // len(KINDS)]
    return [r["snippet"] for r in sorted(labelled + plain, key=lambda r: (r["h"], r["snippet"]))]


def spans_of(texts: list[str], tagger: Tagger | None) -> tuple[list, list]:
    """Base spans and all spans of each text, each sorted by start, then kind."""
    base = [base_spans(t) if _SIGN.search(t) else [] for t in texts]
    if tagger is None:
        return base, base
    more = added_spans(texts, base, tagger)
    return base, [sorted(b + m) for b, m in zip(base, more, strict=True)]


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _find_batches(tagger: Tagger | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, every = spans_of(batch["text"].tolist(), tagger)
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")})
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"] = [sum(x[1] == k for x in spans) for spans in base]
            out["base_text"], out["spans"] = [_written(s) for s in base], [_written(s) for s in every]
            yield out

    return run


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_text, spans`` of every row.

    ``base_text`` and ``spans`` are ``kind:start:end`` joined by commas (code
    points, end exclusive), by start, then kind.  Without ``tagger`` one is
    trained on a bounded sample (``training_snippets``).  Null and empty texts
    have no spans, null ids stay null, repeated rows are read as rows, and a
    table without any base span adds none.
    """
    tagger = tagger or train(training_snippets(docs, text_column, id_column))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    src = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return src.mapInPandas(_find_batches(tagger), f"doc_id long, {counts}, base_text string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Text with every span, overlapping ones merged, replaced by ``[KIND]`` of its first kind."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with the spans of every text masked; other columns and null texts are unchanged."""
    tagger = tagger or train(training_snippets(docs, text_column, id_column))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            _, every = spans_of(["" if t is None else t for t in texts], tagger)
            yield pd.Series([t if t is None or not s else masked(t, s) for t, s in zip(texts, every, strict=True)], dtype=object)

    mask = F.pandas_udf(run, "string")
    own = f"{OWN}text"
    out = docs.withColumn(own, mask(F.col(f"`{text_column}`").cast("string")))
    return out.select(*[F.col(own).alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns])
