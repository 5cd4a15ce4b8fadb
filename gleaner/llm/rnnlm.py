"""A gated recurrent language model, trained on the corpus, and complete-document log-likelihoods.

The tokens of all training documents are counted. The most frequent ones have ids of their own in the network; all others,
seen or not, are dealt over shared ids by their hashes, so that the network reads and predicts every token of every text.
There are as many ids as the square root of the training tokens, so the network grows with the corpus.
Ids are cut into classes. A gated recurrent network in numpy predicts the class
and then the token inside it. Its state is carried from window to window of a document, and back-propagation
stops at the window. Every partition of the training documents trains from the same start, which is the
unigram model, and the networks are averaged, weighted by their tokens. A token with a shared id has that id's
probability times its own smoothed share of it, so the model sums to one over all tokens.

Counts of tokens outside a table of frequent ones are never broadcast but joined.

Edge cases: a null text is an empty one, whose only token is the end; ids that are null count as training
documents; without training documents every count is 0; an empty table gives no rows; rows that repeat are
scored each; other columns are not carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import log2, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, keep, text_bytes

#: Least ids of the network, ids of a class then, width of the state.
VOCABULARY, CLASS, WIDTH = 1024, 32, 8
#: Ids that all tokens without an id of their own share then: a quarter, and a power of two.
SHARED = 256
OWN = VOCABULARY - SHARED
#: Steps of a window, most steps of one of few documents, documents that run side by side, tokens that are laid out at once.
WINDOW, LONGEST, LANES, LAID = 16, 256, 1024, 4_000_000
#: Most frequent tokens whose counts every worker holds, or twice the ids if that is more.
HEAD = 1 << 17
#: Step of Adam, for windows of FULL tokens or more; windows with fewer, where few long documents are left, step less.
RATE, FULL = 0.01, 4096
END = 0x5EED
LN10 = np.log(10.0)


def ids_for(tokens: int) -> int:
    """Ids of the network: the square root of the training tokens, to the nearest power of two, VOCABULARY at least."""
    return max(VOCABULARY, 1 << round(log2(max(tokens, 1)) / 2))


def class_of(ids: int) -> int:
    """Ids of a class: the square root of all ids, up to a power of two."""
    return 1 << (ids.bit_length()) // 2


def hashed(raw: bytes) -> np.ndarray:
    """64-bit hashes of a UTF-8 text's words, A-Z lower-cased, and of the end."""
    words = raw.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def count_tokens(training: DataFrame) -> DataFrame:
    """(h, c): hash and count of every token of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for raw in batch.column(0):
                held.append(hashed(raw.as_py()))
                size += len(held[-1])
                if size > LAID:
                    yield counts(held)
                    held, size = [], 0
            if held:
                yield counts(held)

    def counts(held: list) -> pa.RecordBatch:
        names, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "c"])

    return training.select("text").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


class Lanes:
    """Documents laid out side by side: each lane is a row of documents, lanes by length, the longest first."""

    def __init__(self, lengths: np.ndarray, most: int = LANES):
        order = np.argsort(-lengths, kind="stable")
        loads = [(0, k) for k in range(max(1, min(most, len(lengths))))]
        lanes: list[list[int]] = [[] for _ in loads]
        for d in order:
            load, k = loads[0]
            lanes[k].append(int(d))
            heapq.heapreplace(loads, (load + int(lengths[d]), k))
        sizes = np.array([sum(int(lengths[d]) for d in lane) for lane in lanes], np.int64)
        by = np.argsort(-sizes, kind="stable")
        self.order = [d for k in by for d in lanes[k]]
        self.sizes = sizes[by]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def windows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of lanes, places in the laid-out tokens (step, lane) and whether they exist, window by window.

        Where few lanes are left, a window has more steps, as long as it has FULL places at the most."""
        t, last = 0, int(self.sizes[0]) if len(self.sizes) else 0
        while t < last:
            n, wide = int(np.searchsorted(-self.sizes, -t, side="left")), WINDOW
            while wide < LONGEST and 2 * wide * n <= FULL:
                wide *= 2
            steps = t + np.arange(min(wide, last - t))[:, None]
            t += wide
            there = steps < self.sizes[None, :n]
            yield n, np.where(there, self.starts[None, :n] + steps, 0), there


class Network:
    """The parameters and what is done with them. All arrays are float32."""

    def __init__(self, shares: np.ndarray | None = None, flat: np.ndarray | None = None, ids: int = VOCABULARY):
        self.ids = ids if shares is None else len(shares)
        self.wide = class_of(self.ids)
        n = self.ids // self.wide
        self.shapes = (("inputs", (self.ids, 3 * WIDTH)), ("recurrent", (WIDTH, 3 * WIDTH)), ("classes", (WIDTH, n)), ("class_bias", (n,)), ("words", (n, WIDTH, self.wide)), ("word_bias", (n, self.wide)))
        if flat is None:
            rng = np.random.default_rng(7)
            own = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in self.shapes}
            by = shares.reshape(-1, self.wide)
            own["class_bias"] = np.log(by.sum(axis=1)).astype(np.float32)
            own["word_bias"] = np.log(by / by.sum(axis=1, keepdims=True)).astype(np.float32)
            own["classes"] *= 0.1
            own["words"] *= 0.1
            flat = np.concatenate([own[k].ravel() for k, _ in self.shapes])
        self.flat, at = np.array(flat, np.float32), 0
        for k, s in self.shapes:
            size = int(np.prod(s))
            setattr(self, k, self.flat[at : at + size].reshape(s))
            at += size

    def forward(self, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States after every step (step, lane, width). ids: tokens read; fresh: where a document begins."""
        w, steps = WIDTH, len(ids)
        out = np.empty((steps, len(state), w), np.float32)
        read = self.inputs[ids]
        for t in range(steps):
            if fresh[t].any():
                state = state * ~fresh[t][:, None]
            x, u = read[t], state @ self.recurrent
            gates = np.tanh((x[:, : 2 * w] + u[:, : 2 * w]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = gates[:, :w], gates[:, w:]
            new = np.tanh(x[:, 2 * w :] + r * u[:, 2 * w :])
            out[t] = new + z * (state - new)
            if kept is not None:
                kept.append((state, gates, new, u[:, 2 * w :]))
            state = out[t]
        return out

    def output(self, states: np.ndarray, targets: np.ndarray, learn: bool = False):
        """Log-probabilities of targets after states; with ``learn`` also the gradients of their sum, by name and to states."""
        cls, word = np.divmod(targets, self.wide)
        order = np.argsort(cls.astype(np.int16), kind="stable")  # numbers of 16 bits are sorted by their digits
        cls, word, each = cls[order], word[order], np.arange(len(targets))
        edges = np.searchsorted(cls, np.arange(len(self.class_bias) + 1))
        # tokens lie side by side from here on, so that numpy works on long rows
        states = np.ascontiguousarray(states[order].T)
        own, p, total = self.softmax(self.classes, self.class_bias, states, cls, each)
        logp = own - np.log(total)
        if learn:
            p /= -total
            p[cls, each] += 1
            grads = {"classes": states @ p.T, "class_bias": p.sum(axis=1), "words": np.zeros_like(self.words), "word_bias": np.zeros_like(self.word_bias)}
            back = self.classes @ p
        for c in np.flatnonzero(np.diff(edges)):
            at = slice(edges[c], edges[c + 1])
            s, w, e = states[:, at], word[at], each[: edges[c + 1] - edges[c]]
            own, q, total = self.softmax(self.words[c], self.word_bias[c], s, w, e)
            logp[at] += own - np.log(total)
            if learn:
                q /= -total
                q[w, e] += 1
                grads["words"][c], grads["word_bias"][c] = s @ q.T, q.sum(axis=1)
                back[:, at] += self.words[c] @ q
        placed = np.empty_like(logp)
        placed[order] = logp
        if not learn:
            return placed
        inner = np.empty((len(targets), WIDTH), np.float32)
        inner[order] = back.T
        return placed, grads, inner

    @staticmethod
    def softmax(weights: np.ndarray, bias: np.ndarray, states: np.ndarray, chosen: np.ndarray, each: np.ndarray):
        """What the chosen ones have before the exponent, all exponents (choice, token) and their sums."""
        x = weights.T @ states
        x += bias[:, None]
        x -= x.max(axis=0)
        own = x[chosen, each]
        np.exp(x, out=x)
        return own, x, x.sum(axis=0)

    def backward(self, ids, fresh, there, kept, back) -> dict:
        """Gradients through one window, of the sum whose gradient to its states is ``back`` (step, lane, width)."""
        w, u = WIDTH, self.recurrent
        carried, read = np.zeros_like(back[0]), np.empty((*ids.shape, 3 * w), np.float32)
        recurrent = np.zeros_like(u)
        for t in range(len(ids) - 1, -1, -1):
            state, gates, new, un = kept[t]
            z, r = gates[:, :w], gates[:, w:]
            d = back[t] + carried
            x = read[t]
            x[:, 2 * w :] = d * (1 - z) * (1 - new * new)
            x[:, :w] = d * (state - new) * z * (1 - z)
            x[:, w : 2 * w] = x[:, 2 * w :] * un * r * (1 - r)
            through = x.copy()
            through[:, 2 * w :] *= r
            recurrent += state.T @ through
            carried = (d * z + through @ u.T) * ~fresh[t][:, None]
        flat, places = read.reshape(-1, 3 * w), ids.ravel()
        flat = flat * there.ravel()[:, None]
        inputs = np.stack([np.bincount(places, flat[:, k], self.ids) for k in range(3 * w)], axis=1)
        return {"inputs": inputs, "recurrent": recurrent}


def lay(ids: list[np.ndarray]) -> tuple[Lanes, np.ndarray, np.ndarray, np.ndarray]:
    """Documents' tokens in lanes: the lanes, the laid-out targets, what is read before each, and where documents begin."""
    lanes = Lanes(np.array([len(x) for x in ids], np.int64))
    targets = np.concatenate([ids[d] for d in lanes.order])
    begin = np.cumsum([0, *(len(ids[d]) for d in lanes.order)])[:-1]
    read = np.empty_like(targets)
    read[1:] = targets[:-1]
    fresh = np.zeros(len(targets), bool)
    fresh[begin] = True
    read[fresh] = 0
    return lanes, targets, read, fresh


def train(net: Network, documents: Iterator[list[np.ndarray]]) -> tuple[Network, int]:
    """Adam over windows of lanes, one pass; the trained network and its number of tokens."""
    net, seen, step = Network(flat=net.flat, ids=net.ids), 0, 0
    mean, square = np.zeros_like(net.flat), np.zeros_like(net.flat)
    for ids in documents:
        lanes, targets, read, fresh = lay(ids)
        seen += len(targets)
        state = np.zeros((len(lanes.sizes), WIDTH), np.float32)
        for n, places, there in lanes.windows():
            kept: list = []
            x, f = read[places], fresh[places]
            out = net.forward(x, f, state[:n], kept)
            state[:n] = out[-1]
            flat = there.ravel()
            _, grads, inner = net.output(out.reshape(-1, WIDTH)[flat], targets[places].ravel()[flat], True)
            back = np.zeros((out.shape[0] * n, WIDTH), np.float32)
            back[flat] = inner
            grads |= net.backward(x, f, there, kept, back.reshape(out.shape))
            g = np.concatenate([np.asarray(grads[k], np.float32).ravel() for k, _ in net.shapes]) / np.float32(max(1, flat.sum()))
            step += 1
            mean += (g - mean) * np.float32(0.1)
            square += (g * g - square) * np.float32(0.01)
            net.flat += np.float32(RATE * min(1.0, flat.sum() / FULL)) * (mean / np.float32(1 - 0.9**step)) / (np.sqrt(square / np.float32(1 - 0.99**step)) + np.float32(1e-6))
    return net, seen


def log_probabilities(net: Network, ids: list[np.ndarray]) -> list[np.ndarray]:
    """Natural log-probability of every token of every document."""
    lanes, targets, read, fresh = lay(ids)
    logp, state = np.empty(len(targets), np.float32), np.zeros((len(lanes.sizes), WIDTH), np.float32)
    for n, places, there in lanes.windows():
        out = net.forward(read[places], fresh[places], state[:n])
        state[:n] = out[-1]
        flat = there.ravel()
        at = places.ravel()[flat]
        logp[at] = net.output(out.reshape(-1, WIDTH)[flat], targets[at])
    parts = np.split(logp, np.cumsum([len(ids[d]) for d in lanes.order])[:-1])
    result: list = [None] * len(ids)
    for d, p in zip(lanes.order, parts):
        result[d] = p
    return result


def shared_place(names: np.ndarray, shared: int = SHARED) -> np.ndarray:
    """Which of the shared ids a token has that has none of its own, by its hash."""
    return (names >> np.uint64(8)).astype(np.int64) & shared - 1


def shared_totals(counts: DataFrame, shared: int = SHARED) -> list:
    """(place, n, v): occurrences and distinct tokens by the place that ``shared_place`` gives."""
    place = F.shiftrightunsigned("h", 8).bitwiseAND(F.lit(shared - 1).cast("bigint"))
    return counts.groupBy(place.alias("place")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()


class Vocabulary:
    """Hashes and counts of the most frequent tokens; the first of them have ids of their own, all other tokens shared ones.

    ``totals``: (place, n, v) of all tokens, those with own ids among them. A quarter of the ids is shared."""

    def __init__(self, rows: list[tuple[int, int]], totals: list[tuple[int, int, int]], ids: int = VOCABULARY):
        self.shared = ids // 4
        self.own = ids - self.shared
        counts = {np.uint64(h & (1 << 64) - 1): c for h, c in rows}
        counts.setdefault(np.uint64(END), 0)
        ranked = sorted(counts, key=lambda h: (h != END, -counts[h], h))
        chosen = ranked[: self.own]  # the end is 0
        self.hashes = np.array(sorted(counts), np.uint64)
        self.counts = np.array([counts[h] for h in self.hashes.tolist()], np.int64)
        first = {h: i for i, h in enumerate(chosen)}
        self.ids = np.array([first.get(np.uint64(h), -1) for h in self.hashes.tolist()], np.int64)
        self.ids = np.where(self.ids < 0, self.own + shared_place(self.hashes, self.shared), self.ids)
        own = np.array([counts[h] for h in chosen], np.int64)
        self.rest_n, self.rest_v = np.zeros(self.shared, np.int64), np.zeros(self.shared, np.int64)
        for place, n, v in totals:
            self.rest_n[place], self.rest_v[place] = n, v
        places = shared_place(np.array(chosen, np.uint64), self.shared)
        np.subtract.at(self.rest_n, places, own)
        np.subtract.at(self.rest_v, places, (own > 0).astype(np.int64))
        # a hash's first bits say where to begin among the sorted ones; the last entry is no token's
        self.hashes, self.counts = np.append(self.hashes, ~np.uint64(0)), np.append(self.counts, -1)
        self.ids = np.append(self.ids, self.own + shared_place(self.hashes[-1:], self.shared))
        bits = len(self.hashes).bit_length() + 1
        self.cut = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.cut).astype(np.int32)
        self.deep = int(np.diff(self.first, append=len(self.hashes)).max())
        #: What a shared id's tokens are divided by: their occurrences and kinds, and one for all that were never seen.
        self.rest = np.log10(self.rest_n + self.rest_v + 1.0)
        shares = np.zeros(ids)
        shares[: len(chosen)], shares[self.own :] = own, self.rest_n
        self.shares = shares + 0.5

    def look(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of tokens by their hashes; count -1 for tokens whose counts aren't held."""
        at = self.first[names >> self.cut]
        for _ in range(self.deep):
            at += self.hashes[at] < names
        there = self.hashes[at] == names
        return np.where(there, self.ids[at], self.own + shared_place(names, self.shared)), np.where(there, self.counts[at], -1)


def laid_out(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """Rows of about LAID tokens, however the batches are cut, with the hashes of their documents."""
    rows, held, size = [], [], 0
    for batch in batches:
        first = 0
        for i, raw in enumerate(batch.column(column)):
            held.append(hashed(raw.as_py()))
            size += len(held[-1])
            if size > LAID:
                rows.append(batch.slice(first, i + 1 - first))
                yield pa.Table.from_batches(rows), held
                rows, held, size, first = [], [], 0, i + 1
        if first < batch.num_rows:
            rows.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(rows), held


def averaged(spark: SparkSession, training: DataFrame, vocabulary) -> Network:
    """Train on every partition and average the networks by their tokens, level by level."""
    ids = len(vocabulary.value.shares)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = vocabulary.value
        net, seen = train(Network(shares=found.shares), ([found.look(h)[0] for h in held] for _, held in laid_out(batches, 0)))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(net.flat.astype(np.float64) * seen).tobytes()], pa.binary())], names=["seen", "net"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, 0
        for batch in batches:
            for s, net in zip(batch.column(0).to_pylist(), batch.column(1)):
                total += np.frombuffer(net.as_py(), np.float64)
                seen += s
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["seen", "net"])

    nets = keep(spark, training.select("text").mapInArrow(learn, "seen bigint, net binary"), "nets")
    each = max(4, min(16, 128 * VOCABULARY // ids))  # networks that one task adds up
    while (n := nets.count()) > max(4, 64 * VOCABULARY // ids):  # the driver adds up few networks at any size
        nets = keep(spark, nets.repartition(max(1, n // each)).mapInArrow(add, "seen bigint, net binary"), "nets")
    rows = nets.collect()
    if not rows:
        return Network(shares=vocabulary.value.shares)
    return Network(flat=sum(np.frombuffer(r["net"], np.float64) for r in rows) / sum(r["seen"] for r in rows), ids=ids)


def frequent(counts: DataFrame, most: int) -> list:
    """The tokens from a count on, at most ``most``, and the end, however seldom. A histogram of log counts, of fixed size, gives
    that count first, so that the driver doesn't merge the most frequent tokens of every partition."""
    step = F.floor(F.log2("c") * 64)
    least, n = None, 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["step"]):
        n += r["n"]
        if n > most:
            break
        least = r["step"]
    return counts.where((F.lit(False) if least is None else step >= least) | (F.col("h") == END)).collect()


def score(spark: SparkSession, docs: DataFrame, folds: int = 7, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigram) and score (the network), decimal logs."""
    held_out = F.coalesce(fold_of(id_col, folds) == fold, F.lit(False))
    source = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), text_bytes(text_col).alias("text"))
    training = source.where("not held_out")
    counts = keep(spark, count_tokens(training), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ids = ids_for(n)
    head = frequent(counts, max(HEAD, 2 * ids))
    totals = [(r["place"], r["n"], r["v"]) for r in shared_totals(counts, ids // 4)]
    vocabulary = spark.sparkContext.broadcast(Vocabulary([(r["h"], r["c"]) for r in head], totals, ids))
    net = spark.sparkContext.broadcast(averaged(spark, training, vocabulary).flat)
    divisor = log10(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, model = vocabulary.value, Network(flat=net.value, ids=ids)
        for batch, held in laid_out(batches, 2):
            looked = [found.look(h) for h in held]
            scores = log_probabilities(model, [read for read, _ in looked])
            known, base, own, tails = [], [], [], []
            for names, (read, c), logp in zip(held, looked, scores):
                inside = c >= 0
                logs = np.log10(np.maximum(c, 0) + 1.0)
                known.append(int((c > 0).sum()))
                base.append(float(logs.sum()))
                other = read >= found.own
                own.append(float(logp.astype(np.float64).sum() / LN10 + logs[other].sum() - found.rest[read[other] - found.own].sum()))
                tails.append(names[~inside].view(np.int64))
            sizes = np.cumsum([0, *map(len, tails)])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(tails) if tails else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).combine_chunks(), batch.column(1).combine_chunks(), pa.array([len(h) for h in held], pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(own), lists], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "own", "tail"])

    kind = dict(source.dtypes)["doc_id"]
    scored = source.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, own double, tail array<bigint>")
    scored = keep(spark, scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # tokens whose counts aren't held: none of them is frequent, so none makes a hot key
    tail = scored.select("row", F.explode("tail").alias("h")).join(counts, "h").groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("logs"))
    out = scored.drop("tail").join(tail, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(divisor)).alias("base_score"), (F.col("own") + logs).alias("score"),
    )
