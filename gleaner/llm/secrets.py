"""Secrets in texts: fixed patterns, and values in credential contexts by their guess cost.

A value that stands where a credential is named is cut, by dynamic programming, into the cheapest
sequence of dictionary words, dates, repeats, keyboard walks and brute-force spans; the sum of their
decimal log guesses is its cost, and a value that is dear to guess is taken for a secret. The cheapest ways to all
prefixes are settled in order of their cost, so a value costs a bounded number of steps, however long it is, once
its next cheapest prefix costs more than a secret must. A value of one kind of characters must be dear as well when all
words of a public byte-level vocabulary count, ranked by its order after the usual words of passwords. Prose, names of
variables, paths and addresses are no secrets, whatever they cost: a value all of whose parts read like words, by the
transitions between the letters of that vocabulary, isn't taken. So a secret that is nothing but words isn't found.

Edge cases: a null text is an empty one (no spans); an empty table gives no rows; rows that repeat are
scanned each; very long texts and values are scanned whole, in time that grows with their length; other columns of
the input are not carried by ``scan``. Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_function, frugal, text_bytes

#: The base patterns, the group that holds the secret, and the least length of that group.
BASE = (
    ("assign", re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 12),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(rb"[0-9a-f]{16,}"), 0, 16),
)
KINDS = ("assign", "access", "hex", "guess")
#: Names of credentials and what may stand between them and a value of 8 bytes or more; the value.
CONTEXT = re.compile(rb"""(?:passwords?|passwd|passphrase|passcode|secrets?|credentials?|(?:(?<![a-z])|(?<=api)|(?<=auth)|(?<=access)|(?<=private)|(?<=secret)|(?<=account)|(?<=user)|(?<=db))(?:pwd|tokens?|bearer|key))["']?(?:\x20*(?::=|=>|->|[:=])\x20*|\x20+is:?\x20+|\x20+)["'`]?(?=[^\x00-\x20"'`<>,;(){}\[\]]{8})""", re.I)
#: A value that is the name of the next credential. Only tried where a value begins, and of bounded length.
NAMED = re.compile(rb"[a-z_-]{0,32}?" + CONTEXT.pattern, re.I)
VALUE = re.compile(rb"""[^\x00-\x20"'`<>,;(){}\[\]]+""")
HINTS = (b"passw", b"passp", b"passc", b"pwd", b"secret", b"token", b"bearer", b"credential", b"key")
#: Values from this decimal log of guesses on are secrets.
DEAR = 10.0
#: Frequent words of passwords, most frequent first.
WORDS = """password qwerty dragon monkey letmein master login welcome admin sunshine princess football baseball
shadow superman michael jordan hunter killer batman trustno soccer hockey ranger buster thomas tigger robert
access love secret test user root guest default changeme summer winter spring autumn flower freedom whatever
computer internet server database backup system public private example sample demo token key pass word hello
world money house happy cookie banana orange apple silver golden purple yellow green black white red blue
matrix mustang cheese pepper ginger charlie jessica ashley andrew daniel joshua george harley maggie
your here insert replace none null true false value string dummy placeholder the and for with this that""".split()
#: Mean decimal log of a letter's transition in a word from which on it doesn't read like one. Of the vocabulary's words of 8
#: letters or more 0.1 % lie above 1.5; of random ones of 10 letters 7 % lie below 1.6.
UNLIKE = 1.6
#: What parts a name, a path or an address; and where its parts change from small to large letters.
PARTS = re.compile(r"[-_./:@?&=#%+~|\\]+|(?<=[a-z])(?=[A-Z])")
ENDINGS = re.compile(r"^[a-z]+://|^[\W_]+|[\W_]+$")
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LEET = str.maketrans("@430157$!", "aaeoistsi")
#: Rows of keys, whose neighbours make walks.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
STEPS = {pair for row in ROWS for line in (row, row[::-1]) for pair in zip(line, line[1:])} | {
    pair for upper, lower in zip(ROWS[:3], ROWS[1:4]) for a, b in zip(upper[1:] if upper is ROWS[0] else upper, lower) for pair in ((a, b), (b, a))
}
#: Keys of a walk all of whose parts are costed; a longer one counts from each place to its end only.
WALK = 256
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")


def alphabet(text: str) -> int:
    """Size of the smallest usual alphabet that has a text's characters."""
    size = 26 * any(c.islower() for c in text) + 26 * any(c.isupper() for c in text) + 10 * any(c.isdigit() for c in text)
    return size + 33 * any(not c.isalnum() for c in text) or 33


@lru_cache(maxsize=1)
def ranks() -> dict[str, int]:
    """Ranks of WORDS and, after them, of the whole words of the byte-level vocabulary in its order."""
    found = dict(RANK)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    for word in sorted(vocabulary, key=vocabulary.get):
        low = word[1:].lower()
        if word[0] == "\u0120" and len(low) >= 3 and low.isascii() and low.isalpha():
            found.setdefault(low, len(found) + 1)
    return found


class Value:
    """A value and the segments that may begin at each of its places."""

    UNITS = range(1, 17)

    def __init__(self, value: str, words: dict[str, int] | None = None):
        self.value, self.low, self.words = value, value.lower(), RANK if words is None else words
        if len(self.low) != len(value):  # characters whose lower case is longer
            self.low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        self.plain, self.brute = self.low.translate(LEET), log10(alphabet(value))
        self.longest = max(map(len, self.words), default=0)
        self._same: dict[int, np.ndarray] = {}
        self._walk: np.ndarray | None = None
        self._unit: dict[str, float] = {}

    @staticmethod
    def ends(holds: np.ndarray) -> np.ndarray:
        """For each place the first one from it on at which ``holds`` is false."""
        at = np.where(holds, len(holds), np.arange(len(holds)))
        return np.minimum.accumulate(at[::-1])[::-1]

    def same(self, unit: int) -> np.ndarray:
        """Where the period of ``unit`` characters that begins at each place breaks."""
        if unit not in self._same:
            points = np.frombuffer(self.value.encode("utf-32-le", "surrogatepass"), "<u4")
            self._same[unit] = self.ends(points[:-unit] == points[unit:])
        return self._same[unit]

    def walk(self, start: int) -> int:
        """Where the keyboard walk that begins at a place ends."""
        if self._walk is None:
            self._walk = self.ends(np.fromiter((pair in STEPS for pair in zip(self.low, self.low[1:])), bool, len(self.low) - 1))
        return int(self._walk[start]) + 1 if start < len(self._walk) else start + 1

    def unit(self, part: str) -> float:
        """Cost of what a repeat repeats."""
        if part not in self._unit:
            self._unit[part] = min(self.brute * len(part), guess_cost(part, words=self.words)[0])
        return self._unit[part]

    def segments(self, i: int) -> Iterator[tuple[int, str, float]]:
        """(end, kind, decimal log of guesses) of the segments that begin at place ``i``."""
        value, low, plain, n = self.value, self.low, self.plain, len(self.value)
        yield i + 1, "brute", self.brute
        for end in range(i + 3, min(n, i + self.longest) + 1):
            rank = self.words.get(plain[i:end])
            if rank:
                leet, upper = plain[i:end] != low[i:end], value[i:end] != low[i:end]
                yield end, "word", log10(rank) + 0.5 + 0.5 * leet + (0.3 if upper and value[i].isupper() and value[i + 1 : end].islower() else 1.0 * upper)
        if value[i].isdigit() and (m := DATE.match(value, i)):
            for end in {m.end(), i + 4} if m.end() - i > 4 else {m.end()}:
                yield end, "date", log10(120) if end - i == 4 else log10(120 * 366)
        far = self.walk(i)
        for end in range(i + 3, far + 1) if far - i <= WALK else (far,):
            yield end, "walk", log10(47 * (end - i) * 4)
        for unit in self.UNITS:
            if i + 2 * unit > n:
                break
            times = 1 + (int(self.same(unit)[i]) - i) // unit
            if times > 1 and unit * times >= 3:
                yield i + unit * times, "repeat", self.unit(value[i : i + unit]) + log10(times)


def guess_cost(value: str, enough: float = float("inf"), words: dict[str, int] | None = None) -> tuple[float, list[tuple[str, int, int]]]:
    """The least decimal log of guesses of a value, and the segments (kind, start, end) that give it.

    Prefixes are settled cheapest first, each once with its least cost. When the next one costs ``enough``, that
    lower bound of the whole value's cost is returned, without segments.
    """
    own, n = Value(value, words), len(value)
    best, how, settled, queue = {0: 0.0}, {}, set(), [(0.0, 0)]
    while queue:
        cost, at = heappop(queue)
        if at == n or cost >= enough:
            break
        if at in settled:
            continue
        settled.add(at)
        for end, kind, more in own.segments(at):
            if cost + more < best.get(end, float("inf")):
                best[end], how[end] = cost + more, (kind, at)
                heappush(queue, (cost + more, end))
    if at != n:
        return cost, []
    parts = []
    while at:
        kind, start = how[at]
        parts.append((kind, start, at))
        at = start
    return cost, parts[::-1]


@lru_cache(maxsize=1)
def transitions() -> dict[tuple[str, str], float]:
    """Decimal logs of how seldom a letter follows another in the words of ``ranks``; ``^`` stands before a word."""
    pairs, firsts = Counter(), Counter()
    for word in ranks():
        for a, b in zip("^" + word, word):
            pairs[a, b] += 1
            firsts[a] += 1
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {(a, b): -log10((pairs[a, b] + 0.5) / (firsts[a] + 13)) for a in "^" + letters for b in letters}


def worded(value: str) -> bool:
    """Whether a value reads like a word, or like a name, a path or an address made of words.

    Its parts are words, or up to 4 letters, or up to 4 digits; more than half of its letters are in words. Signs at its
    ends don't count.
    """
    parts = [p for p in PARTS.split(ENDINGS.sub("", value)) if p]
    seldom, words, short = transitions(), 0, 0
    for part in parts:
        low = part.lower()
        one_case = part == low or part == low.upper() or part[1:] == low[1:]
        if part.isdigit() and len(part) <= 4:
            continue
        if not part.isalpha() or not one_case:
            return False
        if len(part) <= 4:
            short += len(part)
        elif not part.isascii() or sum(seldom.get((a, b), 3.0) for a, b in zip("^" + low, low)) < UNLIKE * len(low):
            words += len(part)
        else:
            return False
    return words > short


def dear(value: str) -> bool:
    """Whether a value in a credential context is a secret: dear to guess, and no prose."""
    if guess_cost(value, DEAR)[0] < DEAR or worded(value):
        return False
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value) or any(c.islower() for c in value) and any(c.isupper() for c in value[1:])
    return mixed or guess_cost(value, DEAR, ranks())[0] >= DEAR


def find(raw: bytes) -> list[tuple[str, int, int, int]]:
    """Spans (kind, start, end, start of the secret) of a UTF-8 text, in code points, by start and then kind."""
    low = raw.lower()
    named = any(h in low for h in HINTS)
    spans = []
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not named or kind == "access" and b"AKIA" not in raw:
            continue
        spans += [(m.start(), kind, m.end(), m.start(group)) for m in pattern.finditer(raw) if m.end(group) - m.start(group) >= least]
    if named:
        taken = [(s, e) for s, _, e, _ in spans]
        place = 0
        while m := CONTEXT.search(raw, place):
            start = place = m.end()
            if NAMED.match(raw, start):  # the value is the name of the next credential
                continue
            value = VALUE.match(raw, start)[0]
            place = start + len(value)
            value = value.rstrip(b".:!?|")
            end = start + len(value)
            if len(value) >= 8 and all(e <= start or s >= end for s, e in taken) and dear(value.decode("utf-8", "replace")):
                spans.append((start, "guess", end, start))
    if not raw.isascii() and spans:
        at = {}
        place = count = 0
        for p in sorted({x for s in spans for x in (s[0], s[2], s[3])}):
            count += len(raw[place:p].decode("utf-8", "replace"))
            at[p], place = count, p
        spans = [(at[s], k, at[e], at[v]) for s, k, e, v in spans]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return [(k, s, e, v) for s, k, e, v in spans]


def redact(text: str, spans) -> str:
    """A text with the secret of every span replaced by the span's kind in brackets."""
    out, at = [], 0
    for kind, _, end, start in sorted(spans, key=lambda s: (s[3], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret_start", pa.int32())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spans of every whole text. One narrow pass, no shuffle."""
    source = docs.select(id_col, text_bytes(text_col))
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "secret_start"), s)) for s in find(raw.as_py())] for raw in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(SPAN))], names=[id_col, "spans"])

    return source.mapInArrow(frugal(run), f"{id_col} {kind}, spans array<struct<kind:string,start:int,end:int,secret_start:int>>")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in its texts replaced; other columns and null texts stay as they are. No shuffle."""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if t is None else (redact(t, s) if (s := find(t.encode())) else t) for t in batch.to_pylist()], pa.string())

    return docs.withColumn(text_col, column_function(each, "string", steady=False)(F.col(text_col)))


def joined(spans: Column, *kinds: str) -> Column:
    """Spans of the given kinds as ``kind:start:end``, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
