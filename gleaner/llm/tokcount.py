"""Exact token counts of a score-ordered BPE piece model, by a compiled finite-state transducer.

The tokenizer is compiled, as its states are met, into a deterministic transducer over characters:
a state holds the suffix of the text that some piece may still continue, with the last token of every
prefix inside it, and a transition carries the change in the number of tokens. A chunk of text so becomes a map from
its entry state to its exit state and a count, and the maps of neighbouring chunks compose associatively, level by level
as in a parallel prefix scan. Where a chunk ends at a blank, all that its entry state can differ in is the number of
blanks that wait before it, so these maps hold that number alone. Inside a word without blanks, however long, chunks hold
maps over states: each is computed for the state that the characters just before it lead to, and for any other state
that the composition then asks for.

Edge cases: a null text is an empty one (0 bytes, 0 tokens); an empty table gives no rows; rows that
repeat are counted each; very long texts and words are counted whole, with a bounded number of compiled states; other
columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .bpe import NEVER, Memo
from .common import frugal, text_bytes

BLANK = "▁"
#: Most words, pairs of tokens and states that a worker remembers since it last forgot; characters of a word that is.
MEMO_WORDS, MEMO_PAIRS, MEMO_STATES, LONGEST_KEPT = 300_000, 500_000, 200_000, 200
#: Characters of a chunk inside a word, and of those before it that tell its likely entry state.
CHUNK, BEFORE = 4096, 64
#: Text characters whose chunk maps one fold composes before it is folded further.
BLOCK = 1 << 16


#: The state in which nothing is read and nothing is to be continued.
FIRST = ("", ((None, 0, None),))


class Map:
    """The map of a chunk, from entry state to exit state and tokens: of characters, or composed of neighbours' maps."""

    def __init__(self, machine: "Transducer", text: str = "", before: str = "", parts: list["Map"] | None = None):
        self.machine, self.text, self.parts, self.known = machine, text, parts, {}
        if parts is None:
            self(machine.span(FIRST, before)[0])  # the likely entry
        else:
            for entry in list(parts[0].known):
                self(entry)

    def __call__(self, entry: tuple) -> tuple[tuple, int]:
        if entry not in self.known:
            if self.parts is None:
                self.known[entry] = self.machine.span(entry, self.text)
            else:
                state, total = entry, 0
                for part in self.parts:
                    state, n = part(state)
                    total += n
                self.known[entry] = state, total
        return self.known[entry]


class Transducer:
    """The transducer of one piece model file, for models that put blanks only in front of words."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        order = sorted(usable, key=lambda i: (-model.get_score(i), i))
        pieces = [model.id_to_piece(i) for i in order]
        if any(BLANK in p[1:] and p.strip(BLANK) for p in pieces):
            raise ValueError("pieces that hold a blank after other characters aren't supported")
        score = {p: model.get_score(i) for p, i in zip(pieces, order)}
        self.runs = {p: s for p, s in score.items() if not p.strip(BLANK)}
        if len(set(self.runs.values())) > 1 or self.runs and min(score.values()) < min(self.runs.values()):
            raise ValueError("runs of blanks must merge after everything else, at one score")
        self.born = {p: (r if len(p) > 1 else -1) for r, p in enumerate(pieces) if p not in self.runs or p == BLANK}
        self.halves: dict[str, tuple[str, str]] = {}
        for p in [p for p in self.born if len(p) > 1]:
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if self.stands(a) and self.stands(b) and self.born[a] < self.born[p] > self.born[b] and not self.meet(a, b, self.born[p]):
                    self.halves[p] = (a, b)
                    break
        self.starts = {p[:k] for p in self.born if self.stands(p) for k in range(1, len(p) + 1)}
        self.pairs = Memo(lambda x: not self.meet(*x), MEMO_PAIRS)
        self.clear()
        self.words, self.blanks = Memo(self.word, MEMO_WORDS), Memo(self.run, 4096)

    def stands(self, piece: str) -> bool:
        return piece in self.born and (len(piece) == 1 or piece in self.halves)

    def meet(self, left: str, right: str, before: int = NEVER) -> bool:
        """Whether a merge across the border of two neighbours comes before rank ``before`` (see bpe)."""
        born, halves = self.born, self.halves
        left_until = right_until = NEVER
        while True:
            rank = born.get(left + right)
            if rank is not None and rank < left_until and rank <= right_until and rank < before:
                return True
            if born[left] >= born[right]:
                if left not in halves:
                    return False
                left_until, left = born[left], halves[left][1]
            else:
                right_until, right = born[right], halves[right][0]

    def clear(self) -> None:
        """Forget the compiled states but the first: nothing read, nothing to be continued."""
        self.numbers, self.content, self.table = {FIRST: 0}, [FIRST], [{}]

    def number(self, content: tuple) -> int:
        """The number of a state by what it holds."""
        number = self.numbers.get(content)
        if number is None:
            number = self.numbers[content] = len(self.content)
            self.content.append(content)
            self.table.append({})
        return number

    def step(self, state: int, char: str) -> tuple[int, int]:
        """Compile one transition: the next state and by how many tokens the text has grown.

        A state has the suffix that a piece may continue and, for every border from its beginning to its
        end: the last token before it (None: nothing merges across it), the tokens up to there less those
        up to the end, and whether the first token is a blank alone (None: nothing is read).
        """
        suffix, borders = self.content[state]
        if char not in self.born:
            grown = len(char.encode())
            after = ("", ((None, 0, borders[-1][2]),))
        else:
            for k, (before, less, alone) in enumerate(borders):
                token = suffix[k:] + char
                if self.stands(token) and (before is None or self.pairs[before, token]):
                    break
            grown = less + 1
            suffix += char
            borders = (*((t, n - grown, a) for t, n, a in borders), (token, 0, token == BLANK if alone is None else alone))
            cut = next((k for k in range(len(suffix)) if suffix[k:] in self.starts), len(suffix))
            after = (suffix[cut:], borders[cut:])
        number = self.number(after)
        self.table[state][char] = number, grown
        return number, grown

    def span(self, entry: tuple, text: str) -> tuple[tuple, int]:
        """Exit state and tokens of characters that are read in an entry state; states by what they hold."""
        state, total, table = self.number(entry), 0, self.table
        for c in text:
            got = table[state].get(c)
            if got is None:
                if len(self.content) > MEMO_STATES:  # forget the compiled states, but not where we are
                    now = self.content[state]
                    self.clear()
                    state, table = self.number(now), self.table
                got = self.step(state, c)
            state, grown = got
            total += grown
        return self.content[state], total

    def word(self, word: str) -> tuple[int, bool]:
        """Tokens of a word with one blank before it, and whether that blank is part of a longer token."""
        text = BLANK + word
        if len(text) <= CHUNK:  # the usual case, without a call for the word's only chunk
            if len(self.content) > MEMO_STATES:
                self.clear()
            state, total, table = 0, 0, self.table
            for c in text:
                got = table[state].get(c)
                state, grown = self.step(state, c) if got is None else got
                total += grown
            exit_state = self.content[state]
        else:
            maps = [Map(self, text[at : at + CHUNK], text[max(0, at - BEFORE) : at]) for at in range(0, len(text), CHUNK)]
            while len(maps) > 1:
                maps = [Map(self, parts=maps[i : i + 2]) for i in range(0, len(maps), 2)]
            exit_state, total = maps[0](FIRST)
        return total, not exit_state[1][-1][2]

    def run(self, n: int) -> int:
        """Tokens of n blanks that no word takes up: the leftmost pair that makes a piece merges first."""
        longest = max((len(p) for p in self.runs), default=1)
        whole = max(0, n // longest - 8)  # beyond this each longest piece adds one token
        parts: list[int] = []
        for _ in range(n - whole * longest):
            parts.append(1)
            while len(parts) > 1 and BLANK * (parts[-2] + parts[-1]) in self.runs:
                parts[-2:] = [parts[-2] + parts[-1]]
        return whole + len(parts)

    def waiting(self, blanks: int, takes: bool) -> int:
        """Tokens that blanks before a word add to those of the word with one blank."""
        return self.blanks[blanks - 1] if takes else self.blanks[blanks] - 1

    def chunk(self, text: str) -> tuple:
        """The map of a chunk that begins with a blank: blanks before its first word (0: no word), whether that word
        takes up a blank, tokens of its words, blanks at its end."""
        words, known = text[1:].split(" "), self.words
        if "" not in words and max(map(len, words)) <= LONGEST_KEPT:
            return 1, known[words[0]][1], sum([known[w][0] for w in words]), 0
        lead, takes, total, tail = 0, False, 0, 0
        for w in words:
            tail += 1
            if w:
                n, t = known[w] if len(w) <= LONGEST_KEPT else self.word(w)
                if lead:
                    total += self.waiting(tail, t)
                else:
                    lead, takes = tail, t
                total, tail = total + n, 0
        return lead, takes, total, tail

    def compose(self, left: tuple, right: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if not right[0]:
            return (*left[:3], left[3] + right[3])
        blanks = left[3] + right[0]
        if not left[0]:
            return blanks, right[1], right[2], right[3]
        return left[0], left[1], left[2] + self.waiting(blanks, right[1]) + right[2], right[3]

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        text = " " + text.replace(BLANK, " ")
        maps, at = [], 0
        while at < len(text):
            end = text.find(" ", at + BLOCK)
            end = len(text) if end < 0 else end
            maps.append(self.chunk(text[at:end]))
            at = end
        while len(maps) > 1:  # neighbours compose level by level, as in a scan over processors
            maps = [reduce(self.compose, maps[i : i + 2]) for i in range(0, len(maps), 2)]
        lead, takes, total, tail = maps[0]
        return total + (self.waiting(lead, takes) if lead else 0) + self.blanks[tail]


@lru_cache(4)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text by the piece model at ``path`` (a place on every executor), and whether
    the tokens exceed ``limit``. One narrow pass, no shuffle."""
    source = docs.select(id_col, text_bytes(text_col))
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            sizes, counts = [], []
            for raw in batch.column(1):
                raw = raw.as_py()
                sizes.append(len(raw))
                counts.append(machine.count(raw.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(frugal(run), f"{id_col} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
