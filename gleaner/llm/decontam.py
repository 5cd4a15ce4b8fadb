"""Benchmark decontamination by the q-gram lemma.

A text that holds an item of m characters with k edits shares at least m - Q + 1 - k * Q of the item's Q-grams with
it, and their diagonals (place in the text less place in the item) lie in k + 1 neighbours. Shared Q-grams are
counted in overlapping bands of 2 * (k + 1) diagonals; bands that reach the bound are verified by an alignment
inside the band. Texts and items are compared with A-Z lower-cased and runs of white space as one blank.

The edit budget of an item is a tenth of its length, but never so much that the bound falls below one. Items
shorter than Q characters contaminate only texts that equal them. Items that mostly repeat themselves (runs, short
periods) would count every diagonal; for them the filter counts the text's places that hold any of the item's
Q-grams in sliding windows, and a bit-parallel alignment searches the windows that reach the bound.

Items that are equal are searched for once. They are taken in blocks of bounded size, each of which all texts pass once.
The driver holds the characters of one block at a time, and the workers build their own tables of it.

Edge cases: null and empty texts and items match nothing; an empty table on either side gives no rows; rows that
repeat give one result each; an item that occurs more than once in a text is reported once, at its best place;
very long texts are searched whole, the postings of their Q-grams in slices of bounded size; ids may have any type;
other columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_function, frugal, keep, lower_ascii

Q, BUDGET = 8, 0.1
#: Characters of items in a block, characters of text that are searched at once, slots of the tables that sift grams and
#: cells, postings that are expanded at once.
BLOCK, SEARCHED, SLOTS, CELLS, SLICE = 1 << 20, 1 << 20, 1 << 20, 1 << 20, 1 << 20
#: Digests of texts that are broadcast to drop rows; more of them are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Mean number of places of an item that hold the same Q-gram, from which on it counts as repeating itself.
PERIODIC = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z lower-cased and single blanks, none at either end, and the place of each in ``text``."""
    try:
        low = _LOWER[np.frombuffer(text.encode("latin-1"), np.uint8)]  # one byte each, where that is enough
    except UnicodeEncodeError:
        low = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").copy()
        plain = low < 256
        low[plain] = _LOWER[low[plain]]
    blank = low == 32
    keep = ~blank
    if len(low):
        keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    if len(at) and blank[at[-1]]:
        at = at[:-1]
    return low[at], at


def coded(low: np.ndarray) -> np.ndarray:
    """One byte for each character, so that rare ones may share it."""
    return low if low.dtype == np.uint8 else (low ^ (low >> 8) * 31).astype(np.uint8)


def grams(short: np.ndarray) -> np.ndarray:
    """The Q-gram of coded characters at each place, as a number."""
    if len(short) < Q:
        return np.empty(0, np.uint64)
    short = np.ascontiguousarray(short)
    return np.ndarray((len(short) - Q + 1,), "<u8", short.data, strides=(1,)).copy()


def budget(m: int) -> int:
    return max(0, min(int(BUDGET * m), (m - Q) // Q))


class Items:
    """One block of items, known by their place in it: their Q-grams, sorted, with the items and places that hold each.

    ``periodic``: those that repeat themselves, with their distinct Q-grams; they stand outside the postings.
    """

    def __init__(self, texts: list[str]):
        self.ids, self.texts, self.periodic = [], [], []
        whole: dict[bytes, list[int]] = {}
        for item, text in enumerate(texts):
            low = normal(text)[0].astype(np.uint32)
            if len(low) >= Q:
                own, n = np.unique(grams(coded(low)), return_counts=True)
                if (n * n).sum() > PERIODIC * n.sum():
                    self.periodic.append((item, low, own))
                else:
                    self.ids.append(item)
                    self.texts.append(low)
            elif len(low):
                whole.setdefault(low.tobytes(), []).append(item)
        self.whole = whole
        self.size = np.array([len(x) for x in self.texts], np.int64)
        self.k = np.array([budget(m) for m in self.size], np.int64)
        self.bound = self.size - Q + 1 - self.k * Q
        every = [grams(coded(x)) for x in self.texts]
        gram = np.concatenate([np.empty(0, np.uint64), *every])
        item = np.repeat(np.arange(len(every)), [len(g) for g in every])
        at = np.concatenate([np.empty(0, np.int64), *(np.arange(len(g)) for g in every)])
        order = np.argsort(gram, kind="stable")
        self.item, self.at = item[order], at[order]
        self.grams, self.first = np.unique(gram[order], return_index=True)
        self.number = np.diff(np.append(self.first, len(gram)))
        self.sift = np.zeros(SLOTS, bool)
        self.sift[self.slot(self.grams)] = True

    @staticmethod
    def slot(gram: np.ndarray) -> np.ndarray:
        return ((gram * _MIX) >> np.uint64(44)).astype(np.int64)

    def expanded(self, place: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Cells and items of the postings of the grams ``at``, which stand at ``place``, slice by slice."""
        n = self.number[at]
        longest, ends = int(self.size.max()), np.cumsum(n)
        for lot in range(int(ends[-1] - 1) // SLICE + 1 if len(ends) else 0):
            own = slice(np.searchsorted(ends, lot * SLICE, side="right"), np.searchsorted(ends, (lot + 1) * SLICE, side="right"))
            m = n[own]
            offset = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            posting = np.repeat(self.first[at[own]], m) + offset
            item = self.item[posting]
            yield ((np.repeat(place[own], m) - self.at[posting] + longest) // (self.k[item] + 1)) * len(self.size) + item, item

    def candidates(self, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first diagonal of a band) for the bands that reach their item's bound. ``short`` may hold many coded texts."""
        nothing = np.empty(0, np.int64)
        g = grams(short)
        place = np.flatnonzero(self.sift[self.slot(g)]) if len(self.grams) else nothing
        at = np.minimum(np.searchsorted(self.grams, g[place]), len(self.grams) - 1)
        there = self.grams[at] == g[place] if len(place) else np.empty(0, bool)
        place, at = place[there], at[there]
        if not len(place):
            return nothing, nothing
        # cells whose hashed neighbourhood can't reach the bound go first
        spread = lambda x: ((x.astype(np.uint64) * _MIX) >> np.uint64(44)).astype(np.int64)
        near = np.zeros(CELLS, np.int64)
        for key, _ in self.expanded(place, at):
            near += np.bincount(spread(key), minlength=CELLS)
        keys, counts = nothing, nothing
        for key, item in self.expanded(place, at):
            reach = near[spread(key)] + np.maximum(near[spread(key + len(self.size))], near[spread(key - len(self.size))])
            key, count = np.unique(key[reach >= self.bound[item]], return_counts=True)
            if len(keys):
                key, back = np.unique(np.concatenate([keys, key]), return_inverse=True)
                count = np.bincount(back, np.concatenate([counts, count]), len(key)).astype(np.int64)
            keys, counts = key, count
        if not len(keys):
            return nothing, nothing
        # a band is a cell and the one after it; a band may begin in an empty cell
        band = np.unique(np.concatenate([keys, keys - len(self.size)]))

        def of(x: np.ndarray) -> np.ndarray:
            i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
            return np.where(keys[i] == x, counts[i], 0)

        item = band % len(self.size)
        good = of(band) + of(band + len(self.size)) >= self.bound[item]
        band, item = band[good], item[good]
        return item, band // len(self.size) * (self.k[item] + 1) - int(self.size.max())

    def verify(self, low: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the item's best place in a text near a band of diagonals, if within its budget."""
        own, k = self.texts[item], int(self.k[item])
        start = max(0, diagonal - k)
        window = low[start : max(0, diagonal + 2 * (k + 1) + k + len(own))].astype(np.uint32)
        raw, sought, exact = window.tobytes(), own.tobytes(), 0
        while (exact := raw.find(sought, exact)) >= 0:
            if exact % 4 == 0:
                return 0, start + exact // 4, start + exact // 4 + len(own)
            exact += 1
        # places of a band may repeat one gram: the item's own places that the window holds must reach the bound too
        if np.isin(grams(coded(own)), grams(coded(window))).sum() < int(self.bound[item]):
            return None
        edits, end = align(own, window, k)
        if edits > k:
            return None
        back = align(own[::-1], window[:end][::-1][: len(own) + k], k)[1]
        return edits, start + end - back, start + end

    def scan(self, low: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the best place of each periodic item that a text holds within its budget."""
        g = grams(coded(low)) if self.periodic else None
        for item, own, held in self.periodic:
            m, k = len(own), budget(len(own))
            width, bound = m + k - Q + 1, m - Q + 1 - k * Q
            if len(g) < max(1, m - k - Q + 1):
                continue
            total = np.concatenate([[0], np.cumsum(np.isin(g, held))])
            start = np.flatnonzero(total[np.minimum(np.arange(len(g)) + width, len(g))] - total[: len(g)] >= bound)
            best = None
            for part in np.split(start, np.flatnonzero(np.diff(start) > m + k) + 1) if len(start) else ():
                first = int(part[0])
                window = low[first : int(part[-1]) + m + k].astype(np.uint32)
                got = edits, end = nearest(own, window, k)
                if edits <= k and (best is None or edits < best[0]):
                    back = align(own[::-1], window[:end][::-1][: m + k], k)[1]
                    best = got[0], first + end - back, first + end
                if edits == 0:
                    break
            if best:
                yield item, *best


def nearest(item: np.ndarray, window: np.ndarray, k: int) -> tuple[int, int]:
    """The fewest edits between an item and a part of a window, and the first end of such a part; k + 1 beyond k edits.

    Bit-parallel: one column of differences as two integers, a step for each character of the window.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        where[c] = where.get(c, 0) | 1 << i
    up, down, cost, best = full, 0, m, (k + 1, 0)
    for j, c in enumerate(window.tolist()):
        same = where.get(c, 0)
        level = ((((same & up) + up) ^ up) | same | down) & full
        right, left = down | ~(level | up) & full, level & up
        cost += bool(right & top) - bool(left & top)
        if cost < best[0]:
            best = cost, j + 1
            if not cost:
                break
        right = right << 1 & full
        up, down = left << 1 & full | ~(level | right) & full, level & right
    return best


def align(item: np.ndarray, window: np.ndarray, k: int) -> tuple[int, int]:
    """The fewest edits between an item and a part of a window, and the (first) end of that part; stops beyond k edits.

    Row i holds the costs on the diagonals of the band, from -k to the window's length less the item's plus k.
    """
    m, n = len(item), len(window)
    width = max(0, n - m) + 2 * k + 1
    step, far = np.arange(width), np.int64(k + 1)
    padded = np.full(m + width + k + 1, 1 << 32, np.int64)
    padded[k : k + n][: len(padded) - k] = window[: len(padded) - k]
    place = step - k
    cost = np.where((place >= 0) & (place <= n), 0, far).astype(np.int64)
    for i in range(m):
        row = cost + (padded[i : i + width] != item[i])
        np.minimum(row[:-1], cost[1:] + 1, out=row[:-1])
        cost = np.minimum.accumulate(row - step) + step
        end = i + 1 + place
        cost[(end < 0) | (end > n)] = far
        if cost.min() > k:
            return k + 1, 0
    best = int(cost.argmin())
    return int(cost[best]), m + int(place[best])


def search(items: Items, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """For each text the items that it holds: (place of the item in its block, start, end, edits), in its own code points."""
    found: list[list[tuple[int, int, int, int]]] = []
    lows = [normal(t) for t in texts]
    gap = np.zeros(1, np.uint8)
    borders = np.cumsum([0, *(len(x) + 1 for x, _ in lows)])
    item, diagonal = items.candidates(np.concatenate([part for x, _ in lows for part in (coded(x), gap)])) if lows else (np.empty(0, np.int64),) * 2
    # a band belongs to the text in which its middle places of the item lie
    middle = diagonal + items.k[item] + items.size[item] // 2 if len(item) else diagonal
    owner = np.clip(np.searchsorted(borders, middle, side="right") - 1, 0, max(0, len(lows) - 1))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for d, i, diag in sorted(zip(owner.tolist(), item.tolist(), diagonal.tolist())):
        if best.get((d, i), (1,))[0] == 0:
            continue
        got = items.verify(lows[d][0], i, diag - int(borders[d]))
        if got and got < best.get((d, i), (1 << 30,)):
            best[d, i] = got
    for d, (low, at) in enumerate(lows):
        own = [(x, 0, len(texts[d]), 0) for x in items.whole.get(low.astype(np.uint32).tobytes(), [])] if items.whole and len(low) < Q else []
        own += [(x, int(at[start]), int(at[end - 1]) + 1, edits) for x, edits, start, end in items.scan(low)]
        found.append(own)
    for (d, i), (edits, start, end) in best.items():
        at = lows[d][1]
        found[d].append((items.ids[i], int(at[start]), int(at[end - 1]) + 1, edits))
    return [sorted(x, key=lambda r: (r[1], r[0])) for x in found]


def keyed(benchmark: DataFrame, text_col: str) -> DataFrame:
    """Items with ``_text``, as it is searched for (letters A-Z small, white space as one blank), and its digest ``_key``."""
    blank = F.regexp_replace(lower_ascii(F.col(text_col)), r"[\x20\x09-\x0D]+", " ")
    text = F.regexp_replace(blank, "^ | $", "")
    return benchmark.where(F.length(text) > 0).withColumn("_text", text).withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256))


def distinct_items(benchmark: DataFrame, text_col: str) -> DataFrame:
    """Each text of the benchmark once: key, text."""
    return keyed(benchmark.select(text_col), text_col).select(F.col("_key").alias("key"), F.col("_text").alias("text")).distinct()


def blocks(items: DataFrame, most: int) -> Iterator[pa.Table]:
    """The distinct items (key, text) in blocks of about ``most`` characters; the driver holds one at a time."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // most)
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b) if n > 1 else items
        yield own.toArrow().combine_chunks()


_built: dict[str, Items] = {}


def items_of(name: str, texts: pa.ChunkedArray) -> Items:
    """The tables of a block, built once in each worker; those of the block before are given up."""
    if name not in _built:
        _built.clear()
        _built[name] = Items(texts.to_pylist())
    return _built[name]


def lots(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in lots of about SEARCHED characters, with the place of the first; nulls count as empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= SEARCHED:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document and item that it holds: ids, start and end in code points, and edits.

    ``block``: characters of items searched for at once, some 50 bytes of a worker's memory for each. Every block is a pass
    over the texts. Items that are equal are searched for once.
    """
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, _key string, start int, end int, edits int"
    distinct = distinct_items(benchmark, item_text_col)
    results, last = [], None
    for own in blocks(distinct, block):
        if last:  # another block: what the one before found is written, and its items leave the driver
            results.append(keep(spark, last[0], "contaminated"))
            last[1].destroy()
        held, name = spark.sparkContext.broadcast(own), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], held=held, name=name) -> Iterator[pa.RecordBatch]:
            items, keys = items_of(name, held.value.column(1)), held.value.column(0).combine_chunks()
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                for first, texts in lots(batch.column(1)):
                    for i, own in enumerate(search(items, texts)):
                        for found in own:
                            for column, value in zip(out, (first + i, *found)):
                                column.append(value)
                columns = [batch.column(0).take(pa.array(out[0], pa.int32())), keys.take(pa.array(out[1], pa.int32())), *(pa.array(c, pa.int32()) for c in out[2:])]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "_key", "start", "end", "edits"])

        last = source.mapInArrow(frugal(run), schema), held
    if not last:
        return spark.createDataFrame([], f"{id_col} {kind}, {item_col} {benchmark.schema[item_col].dataType.simpleString()}, start int, end int, edits int")
    found = reduce(DataFrame.unionByName, [*results, last[0]])
    named = keyed(benchmark, item_text_col).select(item_col, "_key")
    return found.join(named, "_key").select(id_col, item_col, "start", "end", "edits")


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item. Only texts go to Python workers.

    With one block there is no shuffle. With more, each block is a pass that keeps the digests of the texts it finds, and rows
    with such a text go in one join at last; no copy of the texts is written.
    """

    def holds(own: pa.Table):
        held, name = spark.sparkContext.broadcast(own), uuid.uuid4().hex

        def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            items = items_of(name, held.value.column(1))
            for batch in batches:
                yield pa.array([bool(own) for _, texts in lots(batch) for own in search(items, texts)], pa.bool_())

        return column_function(each, "boolean")(F.col(text_col)), held

    digest, found, last = F.sha2(F.col(text_col).cast("binary"), 256), [], None
    for own in blocks(distinct_items(benchmark, "text"), block):
        if last:
            found.append(keep(spark, docs.where(last[0]).select(digest.alias("_digest")).distinct(), "held"))
            last[1].destroy()
        last = holds(own)
    if not last:
        return docs
    if not found:
        return docs.where(~last[0])
    held = keep(spark, reduce(DataFrame.unionByName, [*found, docs.where(last[0]).select(digest.alias("_digest"))]).distinct(), "held")
    held = F.broadcast(held) if held.count() <= BROADCAST_ROWS else held
    return docs.join(held, digest == held["_digest"], "left_anti")
