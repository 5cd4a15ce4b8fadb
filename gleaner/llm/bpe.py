"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece exactly one token can end it in the piece's BPE encoding. An automaton
over the vocabulary gives the tokens that are suffixes of the prefix; the one that is compatible
with the last token of what stands before it is stored. Following the stored tokens back from the
end gives the ids. A piece costs time linear in its length, however long it is.

Edge cases: a null text is an empty one (no ids); an empty table gives no rows; rows that repeat are
encoded each; other columns of the input are not carried.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import frugal, text_bytes

#: The pattern by which byte-level BPE vocabularies of this kind cut texts.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Most distinct words and pairs of tokens that a worker remembers since it last forgot. About 250 bytes for each word
#: and 150 for each pair: at most some 150 MB with the pieces and what was remembered before.
MEMO_WORDS, MEMO_PAIRS, LONGEST_KEPT = 160_000, 100_000, 200
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself if visible, else the next free code point from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memo(dict):
    """A dict that makes missing values. When it holds ``limit``, what wasn't asked for since the last time is forgotten."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = self.copy()
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class ByteBpe:
    """A vocabulary with its merges. ``encode`` gives ids, ``decode`` the text of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, of = spec["model"]["vocab"], byte_alphabet()
        self.surface = {i: bytes(of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.surface |= {i: t.encode() for t, i in self.special.items()}
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.born, self.halves, self.merge = dict.fromkeys(vocab.values(), -1), {}, {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            whole = vocab[left + right]
            self.merge[vocab[left], vocab[right]] = rank
            if whole not in self.halves:
                self.born[whole], self.halves[whole] = rank, (vocab[left], vocab[right])
        self.machine = ahocorasick.Automaton()
        for t, i in vocab.items():
            if i not in self.halves or not self.meet(*self.halves[i], before=self.born[i]):
                self.machine.add_word(self.surface[i].decode("latin-1"), (len(t), i))
        self.machine.make_automaton()
        self.alone = {t.decode("latin-1"): i for i, t in self.surface.items() if t.decode("latin-1") in self.machine}
        self.number = {i: str(i).encode() for i in self.surface}
        self.pairs = Memo(lambda pair: not self.meet(*pair), MEMO_PAIRS)
        self.pieces = Memo(lambda p: self.written(self.piece(p)), MEMO_WORDS // 2)
        self.words = Memo(lambda w: self.made(" " + w), MEMO_WORDS)

    def forget(self) -> None:
        """Give up what is remembered of words, pieces and pairs."""
        for memo in (self.words, self.pieces, self.pairs):
            memo.clear()
            memo.old = {}

    def meet(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether a merge across the border of two neighbours comes before rank ``before``.

        Each token stands from the rank of its own merge until that of the merge that takes it up.
        Going back in time, the later-born side is undone; a merge across the border wins if both
        of its sides still stand at its rank. Equal ranks go to the leftmost pair.
        """
        born, halves, merge = self.born, self.halves, self.merge
        left_until = right_until = NEVER
        while True:
            rank = merge.get((left, right))
            if rank is not None and rank < left_until and rank <= right_until and rank < before:
                return True
            if born[left] >= born[right]:
                if left not in halves:
                    return False
                left_until, left = born[left], halves[left][1]
            else:
                right_until, right = born[right], halves[right][0]

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece."""
        raw = piece if piece.isascii() else piece.encode().decode("latin-1")  # a character for each byte
        if raw in self.alone:  # a token that ends the whole piece and begins it
            return [self.alone[raw]]
        last: list = [None] * len(raw)
        pairs = self.pairs
        for end, (length, token) in self.machine.iter(raw):
            if last[end] is None and (length > end or pairs[last[end - length], token]):
                last[end] = token
        ids, at, surface = [], len(raw) - 1, self.surface
        while at >= 0:
            ids.append(token := last[at])
            at -= len(surface[token])
        return ids[::-1]

    def written(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Comma-joined ids and the bytes that they decode to."""
        return b",".join([self.number[i] for i in ids]), b"".join([self.surface[i] for i in ids])

    def ordinary(self, text: str) -> list[int]:
        return [i for p in PIECES.findall(text) for i in self.piece(p)]

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens become those tokens."""
        if self.cut is None or not self.cut.search(text):
            return self.ordinary(text)
        ids, at = [], 0
        for m in self.cut.finditer(text):
            ids += [*self.ordinary(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return ids + self.ordinary(text[at:])

    def decode(self, ids) -> str:
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")

    def made(self, text: str) -> tuple[bytes, bytes]:
        """What ``written`` gives for a text without special tokens."""
        found = [self.pieces[p] if len(p) <= LONGEST_KEPT else self.written(self.piece(p)) for p in PIECES.findall(text)]
        return found[0] if len(found) == 1 else (b",".join([x[0] for x in found]), b"".join([x[1] for x in found]))

    def digest(self, text: str) -> tuple[bytes, bytes]:
        """Comma-joined ids of a text and the bytes that they decode to.

        A blank between two other visible characters always begins a piece, so what stands between
        such blanks is encoded once and remembered. Blanks beside other white space stay inside.
        """
        if self.cut is not None and self.cut.search(text):
            return self.written(self.encode(text))
        words = iter(text.split(" "))
        held = next(words)
        first, said, found = True, self.words, []
        for w in words:
            if w in said and not first and (got := said.get(held)) is not None:  # both begin and end visibly: the usual case
                found.append(got)
                held = w
            elif w and held and not w[0].isspace() and not held[-1].isspace():
                self.put(held, first, found)
                first, held = False, w
            else:
                held = f"{held} {w}"
        self.put(held, first, found)
        return b",".join([x[0] for x in found]), b"".join([x[1] for x in found])

    def put(self, words: str, first: bool, found: list) -> None:
        """Add the ids and bytes of words; the first of a text have no blank before them."""
        if first:
            if words:
                found.append(self.made(words))
        elif len(words) > LONGEST_KEPT or words[0].isspace() or words[-1].isspace():
            found.append(self.made(" " + words))
        else:
            found.append(self.words[words])


@lru_cache(4)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


KINDS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
SQL_KINDS = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(docs: DataFrame, path: str, outputs=("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text", remember: bool = True) -> DataFrame:
    """Encode every whole text by the vocabulary file at ``path`` (a place on every executor), and decode it again.

    ``outputs``: any of n_tokens, ids, decoded, ids_sha256, decoded_sha256. ``remember``: whether workers keep what they
    have learned of words for their next task, or leave the memory to other stages. One narrow pass, no shuffle.
    """
    source = docs.select(id_col, text_bytes(text_col))
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            made: dict[str, list] = {o: [] for o in outputs}
            for raw in batch.column(1):
                csv, back = bpe.digest(raw.as_py().decode("utf-8", "replace"))
                for o, into in made.items():
                    if o == "n_tokens":
                        into.append(csv.count(b",") + 1 if csv else 0)
                    elif o == "ids":
                        into.append([int(x) for x in csv.split(b",")] if csv else [])
                    elif o == "decoded":
                        into.append(back.decode("utf-8", "replace"))
                    elif o == "ids_sha256":
                        into.append(hashlib.sha256(csv).hexdigest())
                    else:
                        into.append(hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, KINDS[o]) for o, v in made.items())], names=[id_col, *outputs])
        if not remember:
            bpe.forget()

    return source.mapInArrow(frugal(run), f"{id_col} {kind}, " + ", ".join(f"{o} {SQL_KINDS[o]}" for o in outputs))
