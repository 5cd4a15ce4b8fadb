"""Language identification of mixed-language texts.

Learned from labelled documents: counts of hashed byte trigrams by language, and how the letters of each
language fall into script ranges. A word's script narrows its candidate languages; its score under each of
them is the sum of its trigrams' log-probabilities; Viterbi over the words, with a penalty for each switch,
labels spans. A document's language is the one with most letters in its spans, its score their share.

Everything that is gathered is of fixed size per language: BUCKETS counts and one count per script.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was
learned; documents with a null language or id teach nothing (a null id is no held-out one); an empty table
gives no rows; rows that repeat are judged each; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, text_bytes

BUCKETS = 1 << 16
#: Log-probability lost by a switch of language between two words, and by a language that a word's script excludes.
SWITCH, EXCLUDED = 8.0, 60.0
#: Least share of a language's letters in a script that makes it a candidate there.
CANDIDATE = 0.001
#: Bytes of text whose words are scored at once, and words that Viterbi runs over at once.
SCORED, LAID = 1 << 22, 2_000_000
#: Script ranges by their first code points; None: not told apart.
SCRIPTS = ((0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Indic"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"))
NAMES = tuple(dict.fromkeys(n for _, n in SCRIPTS))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script number (from 1) of a character by its first two bytes, 0 for none; and the bytes that end words."""
    script = np.zeros(1 << 16, np.int8)

    def of(cp: int) -> int:
        return 1 + NAMES.index([n for first, n in SCRIPTS if first <= cp][-1])

    for b in range(256):
        c = chr(b)
        if b < 128 and c.isalpha():
            script[b << 8 : (b + 1) << 8] = of(b)
    for lead in range(0xC2, 0xE0):
        for tail in range(0x80, 0xC0):
            cp = (lead & 0x1F) << 6 | tail & 0x3F
            script[lead << 8 | tail] = of(cp) if chr(cp).isalpha() else 0
    for lead in range(0xE0, 0xF0):
        for tail in range(0x80, 0xC0):
            first = (lead & 0x0F) << 12 | (tail & 0x3F) << 6
            if first >= 0x800 and any(chr(cp).isalpha() for cp in range(first, first + 64)):
                script[lead << 8 | tail] = of(first)
    for lead in range(0xF0, 0xF5):  # 4,096 characters each: emoji and other signs have no letters among them
        for tail in range(0x80, 0xC0):
            first = (lead & 0x07) << 18 | (tail & 0x3F) << 12
            if 0x10000 <= first < 0x110000 and any(chr(cp).isalpha() for cp in range(first, first + 4096)):
                script[lead << 8 | tail] = 1 + NAMES.index("Other")
    white = np.zeros(256, bool)
    white[list(b" \t\n\x0b\x0c\r")] = True
    return script, white


SCRIPT, WHITE = _tables()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def trigrams(raw: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each byte; white space counts as one blank. ``raw`` begins and ends with white space."""
    low = np.where(WHITE[raw], 32, LOWER[raw]).astype(np.uint32)
    mixed = (low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]) * np.uint32(2654435761)
    return np.concatenate([[0], mixed >> np.uint32(16), [0]]).astype(np.int32)


def scripts(raw: np.ndarray) -> np.ndarray:
    """Script number of the character that begins at each byte, 0 for none or inside a character."""
    pair = raw.astype(np.uint16) << 8
    pair[:-1] |= raw[1:]
    return SCRIPT[pair]


def letters(raw: np.ndarray) -> np.ndarray:
    return np.bincount(scripts(raw), minlength=len(NAMES) + 1)[1:]


def gathered(training: DataFrame) -> DataFrame:
    """(lang, bucket, n) over training documents; negative buckets count letters by script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.setdefault(lang, []).append(raw.as_py())
            for lang, own in texts.items():
                counts = total.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                for chunk in joined(own):
                    counts[:BUCKETS] += np.bincount(trigrams(chunk)[~WHITE[chunk]], minlength=BUCKETS)
                    counts[BUCKETS:] += letters(chunk)
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            bucket = np.where(at < BUCKETS, at, BUCKETS - 1 - at)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(bucket, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])

    return training.select("lang", "text").mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def joined(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Texts, blanks around each, in arrays of about SCORED bytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size > SCORED:
            yield np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
            held, size = [], 0
    if held:
        yield np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)


class Model:
    """Log-probabilities of trigrams and candidate languages of scripts."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        place = {x: i for i, x in enumerate(self.langs)}
        counts, seen = np.zeros((BUCKETS, len(self.langs))), np.zeros((len(NAMES) + 1, len(self.langs)))
        for lang, bucket, n in rows:
            if bucket >= 0:
                counts[bucket, place[lang]] = n
            else:
                seen[-bucket, place[lang]] = n
        used = max(1, int((counts.sum(axis=1) > 0).sum()))
        self.logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * used)).astype(np.float32)
        share = seen / np.maximum(1, seen.sum(axis=0))
        out = share < CANDIDATE
        out[0] = False
        out[out.all(axis=1)] = False  # no language has this script: none is excluded
        self.penalty = np.where(out, np.float32(EXCLUDED), np.float32(0))

    def words(self, raw: np.ndarray):
        """First bytes, ends, letters and scores by language of the words of an array that begins and ends with white space."""
        white = WHITE[raw]
        first, end = np.flatnonzero(white[:-1] & ~white[1:]) + 1, np.flatnonzero(~white[:-1] & white[1:]) + 1
        if not len(first):
            return first, end, np.zeros(0, np.int64), np.zeros((0, len(self.langs)), np.float32)
        of = scripts(raw)
        letter = np.concatenate([[0], np.cumsum(of > 0)])
        n = letter[end] - letter[first]
        scores = np.add.reduceat(self.logs[trigrams(raw)[~white]], np.cumsum(np.concatenate([[0], end - first]))[:-1], axis=0)
        where = np.flatnonzero(of)
        own = np.where(n > 0, of[where[np.minimum(np.searchsorted(where, first), len(where) - 1)]] if len(where) else 0, 0)
        scores = scores - self.penalty[own]
        scores[n == 0] = 0
        return first, end, n, scores

    def viterbi(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Language of every word: the best sequence for each document, whose words follow one another. All documents step together."""
        order = np.argsort(-sizes, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
        sizes = sizes[order]
        came = np.empty(scores.shape, np.uint8 if len(self.langs) < 256 else np.uint16)
        label = np.empty(len(scores), np.int32)
        longest = int(sizes[0]) if len(sizes) else 0
        best = np.zeros((len(sizes), len(self.langs)), np.float32)
        active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
        own = np.arange(len(self.langs))
        ends = np.zeros(len(sizes), np.int32)
        for t in range(longest):
            n = active[t]
            at = starts[:n] + t
            if t == 0:
                came[at], best[:n] = own, scores[at]
                continue
            held = best[:n]
            top = held.argmax(axis=1)
            switch = held[np.arange(n), top][:, None] - np.float32(SWITCH)
            change = switch > held
            came[at] = np.where(change, top[:, None], own)
            best[:n] = np.where(change, switch, held) + scores[at]
        ends[:] = best.argmax(axis=1) if len(sizes) else 0
        for t in range(longest - 1, -1, -1):
            n = active[t]
            at = starts[:n] + t
            label[at] = ends[:n]
            ends[:n] = came[at, ends[:n]]
        return label

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """For each text its spans: first byte, end, language number, letters."""
        firsts, ends, counts, scores, sizes = [], [], [], [], []
        group, held, base = [], 0, 0

        def put() -> None:
            nonlocal group, held
            raw = np.frombuffer(b" " + b" ".join(group) + b" ", np.uint8)
            borders = np.cumsum([0, *(len(t) + 1 for t in group)])
            f, e, n, s = self.words(raw)
            f, e = f - 1, e - 1
            cut = np.searchsorted(f, borders)
            size = np.diff(cut)
            offset = np.repeat(borders[:-1], size)
            firsts.append(f - offset)
            ends.append(e - offset)
            counts.append(n)
            scores.append(s)
            sizes.extend(size.tolist())
            group, held = [], 0

        for t in texts:
            group.append(t)
            held += len(t)
            if held > SCORED:
                put()
        if group:
            put()
        first, end, n, size = np.concatenate(firsts), np.concatenate(ends), np.concatenate(counts), np.array(sizes, np.int64)
        label = self.viterbi(np.concatenate(scores), size)
        result, at = [], np.cumsum([0, *sizes])
        total = np.concatenate([[0], np.cumsum(n)])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if a == b:
                result.append([])
                continue
            own = label[a:b]
            turn = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [b - a]]) + a
            result.append([(int(first[p]), int(end[q - 1]), int(label[p]), int(total[q] - total[p])) for p, q in zip(turn[:-1], turn[1:])])
        return result


def learn(training: DataFrame) -> Model:
    """A model of the rows (lang, text) with a language. What reaches the driver is a fixed number of counts per language."""
    return Model([tuple(r) for r in gathered(training.where("lang is not null").select("lang", text_bytes("text"))).toLocalIterator()])


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """Per row: id, lang_pred, score and, with ``with_spans``, spans in code points. One narrow pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(id_col, text_bytes(text_col))
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, to = [], 0, at
                while to < batch.num_rows and size < 6 * LAID:
                    texts.append(batch.column(1)[to].as_py())
                    size += len(texts[-1])
                    to += 1
                yield judged(own, batch.column(0).slice(at, to - at), texts)
                at = to

    def judged(own: Model, ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        langs, scores, lists = [], [], []
        for raw, spans in zip(texts, own.spans(texts) if own.langs else [[] for _ in texts]):
            sums: dict[int, int] = {}
            for _, _, lang, n in spans:
                sums[lang] = sums.get(lang, 0) + n
            best = min(sums, key=lambda k: (-sums[k], k), default=None)
            lettered = best is not None and sums[best] > 0 and (raw.translate(None, ASCII_REST) != b"" and has_letter(raw))
            langs.append(own.langs[best] if lettered else "und")
            scores.append(sums[best] / sum(sums.values()) if lettered else 0.0)
            if with_spans:
                lists.append([{"start": place(raw, a), "end": place(raw, b), "lang": own.langs[k]} for a, b, k, n in spans if n] if lettered else [])
        columns = [ids, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *([pa.array(lists, pa.list_(SPAN))] if with_spans else [])]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score", *(["spans"] if with_spans else [])])

    return source.mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double" + (", spans array<struct<start:int,end:int,lang:string>>" if with_spans else ""))


ASCII_REST = bytes(b for b in range(128) if not chr(b).isalpha())
ASCII_LETTERS = bytes(b for b in range(128) if chr(b).isalpha())


def has_letter(raw: bytes) -> bool:
    """Whether a text has a letter of any script."""
    return len(raw.translate(None, ASCII_LETTERS)) < len(raw) or any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def place(raw: bytes, at: int) -> int:
    """Code points before a byte."""
    return at if raw.isascii() else len(raw[:at].decode("utf-8", "replace"))


def identify(spark: SparkSession, docs: DataFrame, folds: int = 5, id_col: str = "doc_id", with_spans: bool = False) -> DataFrame:
    """Learn from the documents of all folds but 0 and label every document. Adds held_out (the document is of fold 0)."""
    held_out = F.coalesce(fold_of(id_col, folds) == 0, F.lit(False))
    model = learn(docs.where(~held_out & F.col(id_col).isNotNull()))
    return label(docs, model, id_col, with_spans=with_spans).withColumn("held_out", held_out)
