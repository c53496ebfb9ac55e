"""Secret scan by one combined deterministic automaton.

The rules' regular expressions are compiled together: a small parser builds a
position automaton (NFA), the subset construction makes it deterministic, and
partition refinement minimises it.  The result is one transition array per
state over the 256 byte values, so a text's UTF-8 bytes are read once whatever
the number of rules.  A state's accept set tells which rules have a match
ending there.  A text in which some rule accepts is read once more, backwards,
by the automaton of the reversed expressions, whose accepts are the places where
matches start; from these, left to right, the rule's own automata take the
longest match, over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    Patterns are in a subset of the syntax: literals, classes, groups,
    ``| ? * + {n}``.  A match is made of ``parts``, each the longest match of its
    pattern behind the part before; a part may have a least length.  ``scan`` is
    the expression of the combined automaton: every match that is long enough
    begins with one of ``scan``.  The search goes on behind a match, also one that
    is too short for its ``parts`` or ``min_len``; with ``retry``, too short a part
    is no match, and the next start is tried.  No byte of the class ``not_after``
    stands before a match.
    """

    kind: str
    scan: str
    parts: tuple[tuple[str, int], ...]
    min_len: int = 0
    base: bool = False
    retry: bool = False
    not_after: str = ""


_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_JWT = r"[A-Za-z0-9_-]"
#: The scans keep lengths out of the automaton where a literal is rare enough: counters of several rules
#: multiply its states (some 200 this way, 18,900 with them), and the parts check the lengths anyway.
#: Base rules, in the order that breaks ties of start, and rules that add spans.
RULES = (
    Rule("assign", _KEY + r"[A-Za-z0-9+/_.=-]", ((_KEY, 0), (r"[A-Za-z0-9+/_.=-]+", 12)), base=True),
    Rule("access", r"AKIA[A-Z0-9]", ((r"AKIA[A-Z0-9]+", 18),), base=True),
    Rule("hex", r"[0-9a-f]{16}", ((r"[0-9a-f]+", 16),), base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ((r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),)),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]", ((r"gh[opsu]_", 0), (r"[A-Za-z0-9]+", 36)), retry=True),
    Rule("chat", r"xox[abprs]-[0-9A-Za-z-]", ((r"xox[abprs]-", 0), (r"[0-9A-Za-z-]+", 10)), retry=True),
    Rule("jwt", r"eyJ" + _JWT, ((r"eyJ", 0), (_JWT + "+", 10), (r"\.eyJ", 0), (_JWT + "+", 10), (r"\.", 0), (_JWT + "+", 10)), 40, retry=True, not_after=_JWT),
)
#: Rules whose letters match in either case.
_EITHER_CASE = {"assign"}


# --------------------------------------------------------------- regular expression to NFA

class _Parser:
    """Parses a pattern to nested tuples: ('set', frozenset), ('cat', ..), ('alt', ..), ('star', x), ('opt', x)."""

    def __init__(self, pattern: str, either_case: bool):
        self.s, self.i, self.fold = pattern, 0, either_case

    def parse(self):
        node = self.alternatives()
        if self.i != len(self.s):
            raise ValueError(f"unexpected {self.s[self.i]!r} in {self.s!r}")
        return node

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", *options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated())
        return ("cat", *items)

    def repeated(self):
        node = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.i += 1
            if c == "?":
                node = ("opt", node)
            elif c == "*":
                node = ("star", node)
            elif c == "+":
                node = ("cat", node, ("star", node))
            else:
                end = self.s.index("}", self.i)
                node = ("cat", *[node] * int(self.s[self.i : end]))
                self.i = end + 1
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"group not closed in {self.s!r}")
            return node
        if c == "[":
            return ("set", self.char_class())
        return ("set", self.cased({ord(self.escaped() if c == "\\" else c)}))

    def char_class(self):
        members: set[int] = set()
        while (c := self.take()) != "]":
            first = self.escaped() if c == "\\" else c
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.i += 1
                last = self.take()
                members |= set(range(ord(first), ord(last) + 1))
            else:
                members.add(ord(first))
        return self.cased(members)

    def cased(self, members: set[int]) -> frozenset[int]:
        if self.fold:
            members = members | {ord(chr(m).swapcase()) for m in members if chr(m).isalpha()}
        return frozenset(members)

    def escaped(self) -> str:
        c = self.take()
        if c == "x":
            self.i += 2
            return chr(int(self.s[self.i - 2 : self.i], 16))
        return c

    def peek(self) -> str:
        return self.s[self.i : self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]


class _Nfa:
    """Thompson automaton: ``moves[state]`` are (byte set, target), ``free[state]`` are empty moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, node, start: int) -> int:
        """Build ``node`` from ``start``; returns its end state."""
        kind, *args = node
        if kind == "set":
            end = self.state()
            self.moves[start].append((args[0], end))
            return end
        if kind == "cat":
            for a in args:
                start = self.add(a, start)
            return start
        end = self.state()
        if kind == "alt":
            for a in args:
                head = self.state()
                self.free[start].append(head)
                self.free[self.add(a, head)].append(end)
            return end
        head = self.state()
        self.free[start] += [head, end]
        self.free[self.add(args[0], head)] += [head, end] if kind == "star" else [end]
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


# --------------------------------------------------------------- deterministic automaton

class Automaton:
    """Minimal automaton: ``rows[state][byte]`` is the next state; ``accepts[state]`` the rules' bits.

    Accepting states come last.  ``quiet`` is the same automaton with one
    accepting sink and rows that hold their successor rows themselves; it only
    tells whether any rule accepts, in the fewest steps per byte.
    """

    def __init__(self, rows: list[list[int]], accepts: list[int]):
        self.rows, self.accepts = rows, accepts
        self.plain = next((i for i, a in enumerate(accepts) if a), len(accepts))
        #: The state that nothing leads out of, if there is one.
        self.dead = next((i for i, row in enumerate(rows) if not accepts[i] and set(row) == {i}), -1)
        self.sink: list = []
        self.sink += [self.sink] * 256
        quiet: list[list] = [[] for _ in range(self.plain)]
        for own, row in zip(quiet, rows, strict=False):
            own += [quiet[t] if t < self.plain else self.sink for t in row]
        self.quiet = quiet[0]

    def first_ends(self, data: bytes) -> dict[int, int]:
        """Rule number -> offset behind its first accepted match, in one pass over the bytes."""
        row = self.quiet
        for byte in data:
            row = row[byte]
        if row is not self.sink:
            return {}
        found: dict[int, int] = {}
        for at, mask in self.accepted(data):
            for rule in _bits(mask):
                found.setdefault(rule, at)
        return found

    def accepted(self, data: Iterable[int]) -> Iterator[tuple[int, int]]:
        """``(number of bytes read, accept bits)`` wherever a rule accepts."""
        rows, accepts, plain, state = self.rows, self.accepts, self.plain, 0
        for at, byte in enumerate(data, 1):
            state = rows[state][byte]
            if state >= plain:
                yield at, accepts[state]

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that starts at ``at``, -1 for none; for an automaton that starts there only."""
        rows, plain, dead, state, end = self.rows, self.plain, self.dead, 0, -1
        for i in range(at, len(data)):
            state = rows[state][data[i]]
            if state >= plain:
                end = i + 1
            elif state == dead:
                break
        return end


def _bits(mask: int) -> Iterator[int]:
    n = 0
    while mask:
        if mask & 1:
            yield n
        mask >>= 1
        n += 1


def compile_rules(rules: Iterable[Rule] = RULES, backward: bool = False) -> Automaton:
    """One minimal automaton that finds every rule's ``scan`` anywhere in a text, or in a text read backwards."""
    nodes = [_Parser(r.scan, r.kind in _EITHER_CASE).parse() for r in rules]
    return _compiled([_reversed(n) for n in nodes] if backward else nodes)


def _reversed(node):
    kind, *args = node
    if kind == "set":
        return node
    args = [_reversed(a) for a in args]
    return (kind, *(args[::-1] if kind == "cat" else args))


def _compiled(nodes: list, anywhere: bool = True) -> Automaton:
    """Minimal automaton of the expressions; their numbers are the accept bits."""
    nfa = _Nfa()
    root = nfa.state()
    accept: dict[int, int] = {}
    for n, node in enumerate(nodes):
        head = nfa.state()
        nfa.free[root].append(head)
        accept[nfa.add(node, head)] = n
    classes, members = _byte_classes(nfa)

    # Subset construction; a match may start at any byte if the root is in every subset.
    again = {root} if anywhere else set()
    start = nfa.closure([root])
    if start & accept.keys():
        raise ValueError("a pattern matches the empty text")
    number, todo, table = {start: 0}, [start], []
    while todo:
        subset = todo.pop()
        row = []
        for byte in members:
            target = nfa.closure({t for s in subset for chars, t in nfa.moves[s] if byte in chars} | again)
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        table.append((number[subset], row))
    rows = [r for _, r in sorted(table)]
    masks = [0] * len(number)
    for subset, n in number.items():
        masks[n] = sum(1 << accept[s] for s in subset if s in accept)
    rows, masks = _minimised(rows, masks)
    return Automaton([[row[c] for c in classes] for row in rows], masks)


def _byte_classes(nfa: _Nfa) -> tuple[list[int], list[int]]:
    """Class of each byte (bytes that no set tells apart share one) and one byte of each class."""
    sets = list({chars for moves in nfa.moves for chars, _ in moves})
    seen: dict[tuple[bool, ...], int] = {}
    classes = [seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256)]
    return classes, [classes.index(c) for c in range(len(seen))]


def _minimised(rows: list[list[int]], masks: list[int]) -> tuple[list[list[int]], list[int]]:
    """Partition refinement; states renumbered with the start first and accepting ones last."""
    block = masks
    while True:
        keys: dict[tuple, int] = {}
        refined = [keys.setdefault((block[s], *(block[t] for t in row)), len(keys)) for s, row in enumerate(rows)]
        if len(keys) == len(set(block)):
            break
        block = refined
    one = {b: s for s, b in reversed(list(enumerate(refined)))}
    order = sorted(one, key=lambda b: (masks[one[b]] != 0, b != refined[0], b))
    new = {b: i for i, b in enumerate(order)}
    return [[new[refined[t]] for t in rows[one[b]]] for b in order], [masks[one[b]] for b in order]


# --------------------------------------------------------------- scan

class Scanner:
    """Finds the spans of all rules in a text."""

    def __init__(self, rules: Iterable[Rule] = RULES):
        self.rules = tuple(rules)
        self.automaton = compile_rules(self.rules)
        self.backward = compile_rules(self.rules, backward=True)
        self.parts = [
            [(_compiled([_Parser(p, r.kind in _EITHER_CASE).parse()], anywhere=False), least) for p, least in r.parts] for r in self.rules
        ]
        self.barred = [_Parser(r.not_after, False).parse()[1][1] if r.not_after else frozenset() for r in self.rules]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """``(kind, start, end)`` in code points, by start, then in the order of the rules."""
        data = text.encode("utf-8", "surrogatepass")
        hits = self.automaton.first_ends(data)
        if not hits:
            return []
        starts: dict[int, list[int]] = {n: [] for n in hits}
        for read, mask in self.backward.accepted(reversed(data)):
            for n in _bits(mask):
                starts[n].append(len(data) - read)
        out = sorted((s, n, e) for n, found in starts.items() for s, e in self._matches(n, data, reversed(found)))
        place = _code_points(data, sorted({x for s, _, e in out for x in (s, e)}))
        return [(self.rules[n].kind, place[s], place[e]) for s, n, e in out]

    def _matches(self, n: int, data: bytes, starts: Iterable[int]) -> Iterator[tuple[int, int]]:
        """Leftmost non-overlapping matches of a rule that are long enough, in bytes; ``starts`` ascend."""
        rule, done = self.rules[n], 0
        for start in starts:
            if start < done or (start and data[start - 1] in self.barred[n]):
                continue
            end, long_enough = start, True
            for part, least in self.parts[n]:
                begin, end = end, part.longest(data, end)
                # Parts with a least length are of ASCII characters, one byte each.
                long_enough = long_enough and end - begin >= least
                if end < 0 or (rule.retry and not long_enough):
                    break
            else:
                done = end
                if long_enough and end - start >= rule.min_len:
                    yield start, end


def _code_points(data: bytes, offsets: list[int]) -> dict[int, int]:
    """Code points before each byte offset; ``offsets`` ascend."""
    out, last, count = {}, 0, 0
    for at in offsets:
        count += len(data[last:at].decode("utf-8", "surrogatepass"))
        out[at], last = count, at
    return out


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_text string, spans string"


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    """Compiled once per Python worker."""
    return Scanner()


def _scan_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    scanner = _scanner()
    base = [r.kind for r in scanner.rules if r.base]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            spans = scanner.spans(text)
            kinds = [k for k, _, _ in spans]
            rows.append((
                doc_id,
                *(kinds.count(k) for k in base),
                ",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in base),
                ",".join(f"{k}:{s}:{e}" for k, s, e in spans),
            ))
        out = pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in base), "base_text", "spans"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_text, spans`` of every row, in one narrow pass.

    ``base_text`` and ``spans`` are ``kind:start:end`` joined by commas (code
    points, end exclusive), base rules and all rules.  Null and empty texts
    have no spans; repeated rows are scanned as rows; a null id stays null; an
    empty table gives an empty result.
    """
    src = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    return src.mapInPandas(_scan_batches, _SCHEMA)
