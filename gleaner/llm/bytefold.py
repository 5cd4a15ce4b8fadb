"""Byte-level BPE by folding ranked merges over the bytes of distinct words, with Spark's higher-order functions.

A vocabulary of ranks (a line for each token: its bytes in base64, its rank) has no list of merges: of two neighbours whose
joined bytes are a token, the pair of the lowest rank is joined first, the leftmost of equals. Texts are cut into words by
the vocabulary's pattern, each encoded apart. One narrow pass does all of it, without a shuffle:

1. a worker cuts texts into words and numbers each word when its task meets it first; texts become lists of numbers, and
   only new words go on: their bytes as tokens, and the tokens that occur in them in order of rank;
2. Spark folds each new word's ranked merges over its tokens, a character for each token: a merge replaces the two halves
   of its token wherever they stand side by side;
3. a worker decodes the new words' ids, and puts the texts' ids and bytes together by the words' numbers.

A token is made from the same two halves in all words, and only after all tokens of lower rank, if each token's own bytes,
encoded by lower ranks alone, end as two tokens (`halves_of`): while two neighbours that join to a token stand, no merge has
crossed their borders, so their bytes have been merged as if they stood alone, and both halves have lower ranks. Trained
vocabularies are like that. Another vocabulary is folded step by step (`StepFold`), each step looking for the lowest rank among all neighbours.

So a word is folded once in a task. Both workers begin a new numbering after ``WORDS`` words, which bounds their memory.

Edge cases: a null text is an empty one (no ids); an empty table gives no rows; rows that repeat are encoded each; other
columns of the input are not carried. Texts of any length are encoded whole; a single word of n bytes takes n times the
number of different tokens in it, and in the other vocabularies n squared.
"""

from __future__ import annotations

import base64
import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, small_batches, text_bytes

#: Most distinct words that a task numbers before it begins anew, or half of the segments. Measured at 330,000: 206 MB for the whole
#: worker that numbers, 99 MB for the one that puts together.
WORDS = 400_000
#: Into so many maps the pairs and the tokens are dealt, each of a few entries, since Spark searches a map one by one.
PAIR_MAPS, TOKEN_MAPS = 32_768, 16_384
LONGEST_REMEMBERED = 100
#: Most new words, and most texts, of a row between the workers and Spark, which holds some rows whole.
ROW_WORDS, ROW_TEXTS = 4096, 64
#: Words of a text that are put together at once, and bytes of new words that are searched for tokens at once.
AT_ONCE = 100_000
#: The character of a token is its id and this much, so that each takes four bytes of UTF-8.
FIRST = 0x10000
KINDS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.binary(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
SQL_KINDS = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


@lru_cache(4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(4)
def pair_ranks(path: str) -> dict[tuple[int, int], int]:
    """Ids of two tokens whose joined bytes are a token, and that token's rank."""
    ranks = ranks_of(path)
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[left, right] = rank
    return found


@lru_cache(4)
def halves_of(path: str) -> dict[int, tuple[int, int]] | None:
    """The ids of the two tokens that each longer one is made from; None if lower ranks don't lead to two for one of them."""
    ranks, found = ranks_of(path), {}
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            lowest, at = min((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
            if lowest >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            found[rank] = ranks[parts[0]], ranks[parts[1]]
    return found


def literal(value, kind: str) -> Column:
    """A nested value as one literal: the optimizer folds what stands here into it."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def characters(path: str) -> list[str]:
    """Each id's character."""
    return [chr(FIRST + i) for i in range(max(ranks_of(path).values()) + 1)]


class RankedFold:
    """A column that encodes one word by the vocabulary at ``path``, each of whose tokens has its two halves."""

    kind = "struct<tokens: string, merges: array<int>>"

    def __init__(self, path: str):
        self.token = characters(path)
        self.pair = [""] * len(self.token)
        for whole, (left, right) in halves_of(path).items():
            self.pair[whole] = self.token[left] + self.token[right]
        self.token, self.pair = literal(self.token, "array<string>"), literal(self.pair, "array<string>")

    def encoded(self, word: Column) -> Column:
        """A character for each id of a word, given as characters of its bytes and its tokens by rank."""
        return F.aggregate(word["merges"], word["tokens"], lambda made, m: F.replace(made, F.get(self.pair, m), F.get(self.token, m)))

    @staticmethod
    def given(path: str, octets: np.ndarray, sizes: np.ndarray) -> pa.StructArray:
        """Words as ``encoded`` takes them, from their joined bytes."""
        tree = tree_of(path)
        counts, merges = tree.merges(octets, sizes)
        raw = pa.py_buffer(tree.single[octets].tobytes())
        tokens = pa.StringArray.from_buffers(len(sizes), ends(4 * sizes).buffers()[1], raw)
        return pa.StructArray.from_arrays([tokens, pa.ListArray.from_arrays(ends(counts), pa.array(merges))], names=["tokens", "merges"])


class Tree:
    """The prefixes of all tokens, numbered: from each to the next by a byte."""

    def __init__(self, ranks: dict[bytes, int]):
        prefixes = sorted({token[:n] for token in ranks for n in range(1, len(token) + 1)}, key=len)
        number = {p: i for i, p in enumerate(prefixes)}
        self.first = np.array([number[bytes([b])] for b in range(256)], np.int64)
        self.rank = np.array([ranks.get(p, -1) if len(p) > 1 else -1 for p in prefixes], np.int64)
        self.bits = len(prefixes).bit_length() + 2  # at most a quarter is full
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        longer = np.array([number[p[:-1]] << 8 | p[-1] for p in prefixes if len(p) > 1], np.int64)
        held: dict[int, int] = {}
        for i, at in enumerate(self.place(longer).tolist()):
            while at in held:
                at = (at + 1) % len(self.keys)
            held[at] = i
        at, i = np.array(list(held), np.int64), np.array(list(held.values()), np.int64)
        self.keys[at], self.to[at] = longer[i], i + len(prefixes) - len(longer)
        self.single = np.frombuffer("".join(chr(FIRST + ranks[bytes([b])]) for b in range(256)).encode(), "V4")

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - self.bits

    def next(self, nodes: np.ndarray, octets: np.ndarray) -> np.ndarray:
        """The prefixes that are one byte longer; -1 where there is none."""
        keys = nodes << 8 | octets
        at = self.place(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.to[at], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):  # another key stands there
            at[left] = (at[left] + 1) % len(self.keys)
            held = self.keys[at[left]]
            hit = held == keys[left]
            found[left[hit]] = self.to[at[left[hit]]]
            left = left[~hit & (held >= 0)]
        return found

    def merges(self, octets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of two bytes or more occur in each word, and these tokens, each word's in order of rank."""
        until = np.append(0, np.cumsum(sizes, dtype=np.int64))
        counts, found, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0
        while at < len(sizes):
            to = max(at + 1, int(np.searchsorted(until, until[at] + AT_ONCE, "right")) - 1)
            some = self.occurring(octets[until[at] : until[to]], sizes[at:to])
            counts.append(some[0])
            found.append(some[1])
            at = to
        return np.concatenate(counts), np.concatenate(found)

    def occurring(self, octets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merges`` of a few words."""
        word = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        until = np.repeat(np.cumsum(sizes, dtype=np.int64), sizes)
        place, node, met = np.arange(len(octets)), self.first[octets], [np.zeros(0, np.int64)]
        while len(place):
            place += 1
            inside = np.flatnonzero(place < until)
            place, node, word, until = place[inside], node[inside], word[inside], until[inside]
            node = self.next(node, octets[place])
            known = np.flatnonzero(node >= 0)
            place, node, word, until = place[known], node[known], word[known], until[known]
            rank = self.rank[node]
            whole = rank >= 0
            met.append(word[whole] << 32 | rank[whole])
        found = np.sort(np.concatenate(met))
        found = found[np.diff(found, prepend=-1) != 0]
        return np.bincount(found >> 32, minlength=len(sizes)), (found & 0xFFFFFFFF).astype(np.int32)


@lru_cache(4)
def tree_of(path: str) -> Tree:
    return Tree(ranks_of(path))


class StepFold:
    """A column that encodes one word by any vocabulary at ``path``."""

    kind = "struct<word: binary, octets: array<smallint>>"

    def __init__(self, path: str):
        ranks = ranks_of(path)
        pairs: list[dict] = [{} for _ in range(PAIR_MAPS)]
        for (left, right), rank in pair_ranks(path).items():
            pairs[(left * 31 + right) % PAIR_MAPS][str((left << 20) + right)] = rank
        tokens: list[dict] = [{} for _ in range(TOKEN_MAPS)]
        for token, rank in ranks.items():
            if len(token) > 1:
                tokens[hash_of(token) % TOKEN_MAPS][token.hex().upper()] = rank
        self.pairs = literal(pairs, "array<map<string,int>>").cast("array<map<bigint,int>>")
        self.tokens = literal(tokens, "array<map<string,int>>")
        self.bytes = literal([ranks[bytes([b])] for b in range(256)], "array<int>")
        self.character = literal(characters(path), "array<string>")

    def encoded(self, word: Column) -> Column:
        """A character for each id of a word."""
        return F.array_join(F.transform(self.ids(word["word"], word["octets"]), lambda i: F.get(self.character, i)), "")

    @staticmethod
    def given(path: str, octets: np.ndarray, sizes: np.ndarray) -> pa.StructArray:
        """Words as ``encoded`` takes them, from their joined bytes."""
        words = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, ends(sizes).buffers()[1], pa.py_buffer(octets.tobytes())])
        return pa.StructArray.from_arrays([words, pa.ListArray.from_arrays(ends(sizes), pa.array(octets.astype(np.int16)))], names=["word", "octets"])

    def rank(self, left: Column, right: Column) -> Column:
        """The rank of two joined neighbours; null if that is no token."""
        return F.get(self.pairs, (left * 31 + right) % PAIR_MAPS)[left.cast("bigint") * (1 << 20) + right]

    def joined(self, parts: Column) -> Column:
        """Parts with the pair of the lowest rank joined; as they are if no pair is a token."""

        def at(rank: Column, place: Column) -> Column:
            return F.filter(F.transform(parts, lambda x, i: F.when(i == place - 1, rank).otherwise(x)), lambda x, i: i != place)

        def lowest(found: Column) -> Column:
            return let(F.array_min(found), lambda rank: F.when(rank.isNull(), parts).otherwise(let(F.array_position(found, rank).cast("int"), lambda place: at(rank, place))))

        return F.when(F.size(parts) < 2, parts).otherwise(let(F.transform(parts, lambda x, i: self.rank(x, F.get(parts, i + 1))), lowest))

    def ids(self, word: Column, octets: Column) -> Column:
        """Ids of a word, given as binary and as an array of its bytes."""
        whole = F.get(self.tokens, (F.crc32(word) % TOKEN_MAPS).cast("int"))[F.hex(word)]
        single = F.transform(octets, lambda b: F.get(self.bytes, b))
        folded = F.aggregate(F.slice(octets, 2, F.greatest(F.size(octets), F.lit(1))), single, lambda parts, _: self.joined(parts))
        return let(whole, lambda w: F.when(w.isNotNull(), F.array(w)).otherwise(folded))


def hash_of(token: bytes) -> int:
    import zlib

    return zlib.crc32(token)


class Segments(dict):
    """The number of every segment met, a blank before it; new ones are added."""

    def __init__(self, add, before: str):
        self.add, self.before = add, before

    def __missing__(self, key: str) -> int:
        segment = self.add(self.before + key)
        if len(key) <= LONGEST_REMEMBERED:
            self[key] = segment
        return segment


class Numbering:
    """Numbers of the words of texts, in the order in which they are met. Texts are cut into segments first, each a list of words."""

    def __init__(self, pattern: str):
        self.words_of = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.new: list[str] = []
        self.bare, self.after_blank = Segments(self.add, ""), Segments(self.add, " ")
        self.words, self.ends = array("i"), array("i", [0])  # of segments

    def full(self, most: int) -> bool:
        return len(self.number) >= most or max(len(self.ends), len(self.words) // 2) >= 2 * most

    def add(self, held: str) -> int:
        """A new segment's number."""
        number, new = self.number, self.new
        for word in [held] if held.removeprefix(" ").isalpha() else self.words_of(held):  # letters are one word
            n = number.get(word)
            if n is None:
                n = number[word] = len(number)
                new.append(word)
            self.words.append(n)
        self.ends.append(len(self.words))
        return len(self.ends) - 2

    def text(self, text: str, found: list[int]) -> None:
        """Add the numbers of a text's segments. A blank between two visible characters always begins a word, and a line feed between
        two is one, so texts are cut there; those beside other white space stay inside."""
        lines = [line.split(" ") for line in text.split("\n")]
        if list(chain.from_iterable(lines)) == text.split():  # the usual case: no other white space
            for i, parts in enumerate(lines):
                if i:
                    found.append(self.bare["\n"])
                found.append(self.bare[parts[0]])
                found += map(self.after_blank.__getitem__, parts[1:])
            return
        parts = iter(text.split(" "))
        held = next(parts)
        for part in parts:
            if part and held and not part[0].isspace() and not held[-1].isspace():
                found.append(self.bare[held])
                held = " " + part
            else:
                held = f"{held} {part}"
        found.append(self.bare[held])

    def numbers(self, segments: list[int], texts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of segments, and how many words each text has, whose segments end at ``texts``."""
        segment, until = np.array(segments, np.int64), np.array(self.ends, np.int64)
        spread = spread_of(until, segment)
        before = np.append(0, np.cumsum(until[segment + 1] - until[segment]))
        return np.array(self.words, np.int32)[spread], np.diff(before[np.array(texts)]).astype(np.int32)


def spread_of(until: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the entries of lists, one list after the other; list i is from ``until[i]`` to ``until[i + 1]``."""
    begin = until[chosen]
    sizes = until[chosen + 1] - begin
    after = np.cumsum(sizes)
    return np.repeat(begin - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)


class Coded:
    """Ids of the words met, and the bytes that they decode to, by the words' numbers."""

    def __init__(self, path: str):
        ranks = ranks_of(path)
        surface = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            surface[rank] = token
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_until = np.append(0, np.cumsum(np.fromiter(map(len, surface), np.int64, len(surface))))
        self.forget()

    def forget(self) -> None:
        self.ids, self.octets = np.zeros(0, "<u4"), np.zeros(0, np.uint8)
        self.ids_until = self.octets_until = np.zeros(1, np.int64)
        self.new: list[tuple] = []

    def add(self, encoded: pa.Array) -> None:
        """Words as characters of their ids; known once settled."""
        if not len(encoded):
            return
        until = np.frombuffer(encoded.buffers()[1], np.int32)[encoded.offset : encoded.offset + len(encoded) + 1].astype(np.int64)
        raw = np.frombuffer(encoded.buffers()[2] or b"", np.uint8)[until[0] : until[-1]].reshape(-1, 4).astype(np.uint32) & 63
        ids = ((raw[:, 0] & 7) << 18 | raw[:, 1] << 12 | raw[:, 2] << 6 | raw[:, 3]) - FIRST
        until = (until - until[0]) // 4
        octets = self.surface[spread_of(self.surface_until, ids.astype(np.int64))]
        octets_until = np.append(0, np.cumsum(np.diff(self.surface_until)[ids]))[until]
        self.new.append((ids.astype("<u4"), np.diff(until), octets, np.diff(octets_until)))

    def settle(self) -> None:
        """Put what was added since to the rest."""
        if self.new:
            ids, id_counts, octets, octet_counts = map(np.concatenate, zip(*self.new))
            self.ids_until = np.append(self.ids_until, self.ids_until[-1] + np.cumsum(id_counts))
            self.octets_until = np.append(self.octets_until, self.octets_until[-1] + np.cumsum(octet_counts))
            self.ids, self.octets = np.append(self.ids, ids), np.append(self.octets, octets)
            self.new = []

    def text(self, numbers: np.ndarray, ids: bool) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, or the bytes, of a text's words."""
        of, until = (self.ids, self.ids_until) if ids else (self.octets, self.octets_until)
        return b"".join([of[spread_of(until, numbers[at : at + AT_ONCE])].tobytes() for at in range(0, len(numbers), AT_ONCE)])


def encode_decode(docs: DataFrame, path: str, pattern: str, outputs=("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text by the ranks at ``path`` (a place on every executor) and ``pattern``, and decode it again.

    ``outputs``: any of n_tokens, ids, decoded (the bytes), ids_sha256 (of ids as little-endian unsigned 32-bit integers),
    decoded_sha256. One narrow pass, no shuffle.
    """
    small_batches(docs.sparkSession)
    source = docs.select(id_col, text_bytes(text_col))
    kind = dict(source.dtypes)[id_col]
    fold = StepFold if halves_of(path) is None else RankedFold
    given, decodes = fold.given, any(o.startswith("decoded") for o in outputs)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbering(pattern)
        for batch in batches:
            if anew := known.full(WORDS):
                known.forget()
            known.new = []
            segments: list[int] = []
            texts = [0]
            for raw in batch.column(1):
                known.text(raw.as_py().decode("utf-8", "replace"), segments)
                texts.append(len(segments))
            numbers, counts = known.numbers(segments, texts)
            words = [w.encode() for w in known.new]
            sizes = np.fromiter(map(len, words), np.int32, len(words))
            new = given(path, np.frombuffer(b"".join(words), np.uint8), sizes)
            word_rows, text_rows = -(-len(words) // ROW_WORDS), -(-len(counts) // ROW_TEXTS)  # words come before the texts that have them
            rows_of = lambda sizes, values: pa.ListArray.from_arrays(ends(sizes), values)
            in_row = lambda total, most: np.minimum(most, total - np.arange(0, total, most))
            no_words, no_texts = np.zeros(text_rows, np.int32), np.zeros(word_rows, np.int32)
            texts_in = np.append(no_texts, in_row(len(counts), ROW_TEXTS))
            numbers_in = np.append(no_texts, np.add.reduceat(counts, np.arange(0, len(counts), ROW_TEXTS)) if text_rows else no_words)
            begins = np.arange(word_rows + text_rows) == 0
            columns = [pa.array(begins & anew), rows_of(texts_in, batch.column(0)), rows_of(texts_in, pa.array(counts)), rows_of(numbers_in, pa.array(numbers)), rows_of(np.append(in_row(len(words), ROW_WORDS), no_words), new)]
            yield pa.RecordBatch.from_arrays(columns, names=["anew", "keys", "counts", "numbers", "words"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Coded(path)
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column(0)[row].as_py():
                    known.forget()
                known.add(batch.column(4)[row].values)
                keys, at = batch.column(1)[row].values, 0
                if not len(keys):
                    continue
                known.settle()
                numbers = batch.column(3)[row].values.to_numpy()
                made: dict[str, list] = {o: [] for o in outputs}
                for count in batch.column(2)[row].values.to_pylist():
                    own = numbers[at : at + count]
                    at += count
                    coded = known.text(own, True)
                    back = known.text(own, False) if decodes else b""
                    for o, into in made.items():
                        if o == "n_tokens":
                            into.append(len(coded) // 4)
                        elif o == "ids":
                            into.append(np.frombuffer(coded, "<u4").astype(np.int32))
                        elif o == "ids_sha256":
                            into.append(hashlib.sha256(coded).hexdigest())
                        else:
                            into.append(back if o == "decoded" else hashlib.sha256(back).hexdigest())
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(v, KINDS[o]) for o, v in made.items())], names=[id_col, *outputs])

    words = source.mapInArrow(frugal(numbered), f"anew boolean, keys array<{kind}>, counts array<int>, numbers array<int>, words array<{fold.kind}>")
    encoded = words.withColumn("words", F.transform("words", fold(path).encoded))
    return encoded.mapInArrow(frugal(put_together), f"{id_col} {kind}, " + ", ".join(f"{o} {SQL_KINDS[o]}" for o in outputs))


def ends(sizes: np.ndarray) -> pa.Array:
    """Offsets of a list array from the sizes of its lists."""
    out = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=out[1:])
    return pa.array(out)
