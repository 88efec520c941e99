"""Scoring by a gated recurrent language model in numpy.

Counts of all training words give the base score and the vocabulary: the ``vocabulary`` most frequent words, an end mark, and one symbol for all other words,
whose probability is shared out by smoothed counts. The model predicts a symbol's class from the state, then the symbol
within its class (classes of about equal mass), so a step costs about the square root of the vocabulary.

Training is data parallel: in each of ``rounds`` rounds every task starts from the shared weights and runs truncated
backpropagation over windows of ``window`` symbols of its training documents, with the state carried from window to window and cleared
where a document starts; the new weights are the mean over tasks, weighted by symbols and summed by Spark. Every round takes its own share of the
training documents by hash, and each training document is in exactly one (``train_share`` under 1 leaves some out, for trials only).
Scoring runs documents side by side in lanes, each through all its windows with the state carried, so every document is scored whole.

Words meet their counts by bundle: documents are dealt to bundles and written as places in the list of their bundle's distinct words; these words join the
counts, and a task reads one bundle and the counts of its words by place. No table of all words is broadcast, and a frequent word is one row per bundle.

Defined results: a null or empty text is the end mark alone. Rows without doc_id train and are not held out. Repeated rows are documents of their own.
An empty table gives no rows. Without training words all known-word terms are those of unseen words.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm.common import longs, packed, parts_for, raw, unpacked
from trolley.session import stage

END, OTHER = 0, 1
LN10 = math.log(10)


@dataclass(frozen=True)
class Settings:
    vocabulary: int = 2048
    classes: int = 40
    hidden: int = 16
    window: int = 24
    lanes: int = 256
    rounds: int = 4
    train_share: float = 1.0
    rate: float = 0.01
    clip: float = 1.0
    seed: int = 11
    bundle_bytes: int = 16 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string")) % 7 == 2, F.lit(False))


class Symbols:
    """Symbol numbers of words, and the class of each symbol with its place there."""

    def __init__(self, words: list[bytes], counts: list[int], end: int, other: int, classes: int):
        self.number = {w: k + 2 for k, w in enumerate(words)}
        self.counts = np.array([end, other, *counts], float) + 1
        share = np.cumsum(self.counts[2:]) / max(self.counts[2:].sum(), 1)
        bins = np.minimum((share * (classes - 2)).astype(int), classes - 3)
        self.class_of = np.concatenate([[0, 1], 2 + np.unique(bins, return_inverse=True)[1]]).astype(np.int64)
        self.members = [np.flatnonzero(self.class_of == c) for c in range(int(self.class_of.max()) + 1)]
        self.place = np.zeros(len(self.counts), np.int64)
        for m in self.members:
            self.place[m] = np.arange(len(m))

    def __len__(self) -> int:
        return len(self.counts)


class Model:
    """Gated recurrent unit over symbols with a class-factored softmax; weights are views of one flat vector."""

    #: Most rows of one softmax while scoring.
    rows = 8192

    def __init__(self, symbols: Symbols, s: Settings, flat: np.ndarray | None = None):
        self.symbols, self.s = symbols, s
        n, h, c = len(symbols), s.hidden, len(symbols.members)
        self.shapes = {"inp": (n, 3 * h), "rec": (h, 3 * h), "cls": (h, c), "cls_b": (c,), "word": (n, h), "word_b": (n,)}
        size = sum(math.prod(x) for x in self.shapes.values())
        if flat is None:
            flat = self._start(size)
        self.flat = flat
        self.w = self.views(flat)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, shape in self.shapes.items():
            out[k] = flat[at: at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
        return out

    def _start(self, size: int) -> np.ndarray:
        """Small random weights; the biases alone give the training frequencies."""
        rng = np.random.default_rng(self.s.seed)
        flat = (rng.standard_normal(size) * 0.1).astype(np.float32)
        w, count = self.views(flat), self.symbols.counts
        mass = np.array([count[m].sum() for m in self.symbols.members])
        w["cls_b"][:] = np.log(mass / mass.sum())
        w["word_b"][:] = np.log(count / mass[self.symbols.class_of])
        w["cls"][:] *= 0.1
        w["word"][:] *= 0.1
        return flat

    def halved(self) -> tuple[np.ndarray, np.ndarray]:
        """Input and recurrent weights with those of the update and reset gates halved, as their sigmoid is taken by the tangent of half its argument."""
        k = 2 * self.s.hidden
        out = self.w["inp"].copy(), self.w["rec"].copy()
        for x in out:
            x[:, :k] *= np.float32(0.5)
        return out

    def step(self, gates: np.ndarray, h: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, ...]:
        """New state, update and reset gates together, candidate, recurrent part of the candidate; for ``gates`` and ``rec`` from ``halved`` weights."""
        k = self.s.hidden
        own = h @ rec
        zr = gates[:, : 2 * k] + own[:, : 2 * k]
        np.tanh(zr, out=zr)
        zr += 1
        zr *= np.float32(0.5)
        cand = zr[:, k:] * own[:, 2 * k:]
        cand += gates[:, 2 * k:]
        np.tanh(cand, out=cand)
        new = h - cand
        new *= zr[:, :k]
        new += cand
        return new, zr, cand, own[:, 2 * k:]

    def output(self, states: np.ndarray, targets: np.ndarray, grad: dict[str, np.ndarray] | None = None):
        """Natural log probability of each target; with ``grad``, also the gradient by state, of the mean loss."""
        w, sym = self.w, self.symbols
        if grad is None and len(targets) > self.rows:
            # blocks that stay in the processor's cache
            return np.concatenate([self.output(states[k: k + self.rows], targets[k: k + self.rows])[0] for k in range(0, len(targets), self.rows)]), None
        goal = sym.class_of[targets]
        scale = np.float32(1 / max(len(targets), 1))
        rows = np.arange(len(targets))
        safe = self.bounded()
        at_goal, total, p = self._softmax(states @ w["cls"], w["cls_b"], (rows, goal), safe)
        logp = at_goal - np.log(total)
        back = None
        if grad is not None:
            p /= total[:, None]
            p[rows, goal] -= 1
            p *= scale
            grad["cls"] += states.T @ p
            grad["cls_b"] += p.sum(axis=0)
            back = p @ w["cls"].T
        order = np.argsort(goal.astype(np.int16), kind="stable")
        cuts = np.searchsorted(goal[order], np.arange(len(sym.members) + 1))
        for c, m in enumerate(sym.members):
            if len(m) < 2 or cuts[c] == cuts[c + 1]:
                continue
            own = order[cuts[c]: cuts[c + 1]]
            a, b = int(m[0]), int(m[-1]) + 1
            h = states[own]
            at = (rows[: len(own)], sym.place[targets[own]])
            at_goal, total, p = self._softmax(h @ w["word"][a:b].T, w["word_b"][a:b], at, safe)
            logp[own] += at_goal - np.log(total)
            if grad is not None:
                p /= total[:, None]
                p[at] -= 1
                p *= scale
                grad["word"][a:b] += p.T @ h
                grad["word_b"][a:b] += p.sum(axis=0)
                back[own] += p @ w["word"][a:b]
        return logp, back

    def bounded(self) -> bool:
        """Whether no logit can pass 60 either way, as states lie between -1 and 1: then exponentials need no largest logit taken off."""
        w = self.w
        return bool((np.abs(w["cls"]).sum(axis=0) + np.abs(w["cls_b"])).max() < 60 and (np.abs(w["word"]).sum(axis=1) + np.abs(w["word_b"])).max() < 60)

    @staticmethod
    def _softmax(logits: np.ndarray, bias: np.ndarray, at: tuple[np.ndarray, np.ndarray], safe: bool) -> tuple[np.ndarray, ...]:
        """Logit of the place ``at`` of each row, sum of the row's exponentials, and these in place of the logits."""
        logits += bias
        if not safe:
            logits -= logits.max(axis=1, keepdims=True)
        found = logits[at]
        p = np.exp(logits, out=logits)
        return found, p @ np.ones(p.shape[1], p.dtype), p

    def train_window(self, before: np.ndarray, targets: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Gradient over one window (steps x lanes) of previous symbols and targets; ``fresh`` marks starts of documents."""
        w, k = self.w, self.s.hidden
        steps, lanes = before.shape
        flat = np.zeros_like(self.flat)
        grad = self.views(flat)
        gates = w["inp"][before]
        gates[:, :, : 2 * k] *= np.float32(0.5)
        half = w["rec"].copy()
        half[:, : 2 * k] *= np.float32(0.5)
        begins = fresh.any(axis=1)
        states, prev = np.empty((steps, lanes, k), np.float32), np.empty((steps, lanes, k), np.float32)
        zr, cand, own = (np.empty((steps, lanes, n * k), np.float32) for n in (2, 1, 1))
        for t in range(steps):
            prev[t] = h
            if begins[t]:
                prev[t, fresh[t]] = 0
            states[t], zr[t], cand[t], own[t] = self.step(gates[t], prev[t], half)
            h = states[t]
        logp, back = self.output(states.reshape(-1, k), targets.ravel(), grad)
        back = back.reshape(steps, lanes, k)
        z, r = zr[:, :, :k], zr[:, :, k:]
        # what each gate's gradient is of the state's, for all steps at once
        by_cand = (1 - z) * (1 - cand * cand)
        by_z = (prev - cand) * z * (1 - z)
        by_r = by_cand * own * r * (1 - r)
        by_rec = by_cand * r
        ahead = np.zeros((lanes, k), np.float32)
        by_gate, rec = np.empty((steps, lanes, 3 * k), np.float32), np.empty((steps, lanes, 3 * k), np.float32)
        turned = np.ascontiguousarray(w["rec"].T)
        for t in reversed(range(steps)):
            d = back[t]
            d += ahead
            g = rec[t]
            np.multiply(d, by_z[t], out=g[:, :k])
            np.multiply(d, by_r[t], out=g[:, k: 2 * k])
            np.multiply(d, by_rec[t], out=g[:, 2 * k:])
            ahead = g @ turned
            ahead += d * z[t]
            if begins[t]:
                ahead[fresh[t]] = 0
        by_gate[:, :, : 2 * k] = rec[:, :, : 2 * k]
        np.multiply(back, by_cand, out=by_gate[:, :, 2 * k:])
        grad["rec"] += prev.reshape(-1, k).T @ rec.reshape(-1, 3 * k)
        flat_before, by_gate = before.ravel(), by_gate.reshape(-1, 3 * k)
        order = np.argsort(flat_before.astype(np.int16) if len(self.symbols) < 2**15 else flat_before, kind="stable")
        ordered = flat_before[order]
        starts = np.flatnonzero(np.diff(ordered, prepend=-1))
        names = ordered[starts]
        grad["inp"][names] = np.add.reduceat(by_gate[order], starts, axis=0)
        return flat, h, float(-logp.mean())


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size, np.float32), np.zeros(size, np.float32), 0, rate

    def update(self, flat: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        rate = self.rate * math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        flat -= np.float32(rate) * self.m / (np.sqrt(self.v) + np.float32(1e-8))


def in_lanes(docs: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents one after the other in lanes of near equal length, longest lane first: symbols (steps x lanes, -1 behind the
    end), marks of first symbols, and the document of each place."""
    lanes = max(min(lanes, len(docs)), 1)
    load = [(0, k) for k in range(lanes)]
    import heapq

    own: list[list[int]] = [[] for _ in range(lanes)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        n, k = heapq.heappop(load)
        own[k].append(d)
        heapq.heappush(load, (n + len(docs[d]), k))
    length = {k: n for n, k in load}
    order = sorted(range(lanes), key=lambda k: -length[k])
    steps = length[order[0]] if docs else 0
    symbols = np.full((steps, lanes), -1, np.int32)
    fresh, which = np.zeros((steps, lanes), bool), np.full((steps, lanes), -1, np.int32)
    for column, k in enumerate(order):
        at = 0
        for d in own[k]:
            n = len(docs[d])
            symbols[at: at + n, column] = docs[d]
            fresh[at, column] = True
            which[at: at + n, column] = d
            at += n
    return symbols, fresh, which


def before_of(symbols: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The symbol before each one; a document starts behind an end mark."""
    before = np.empty_like(symbols)
    before[:1] = END
    before[1:] = symbols[:-1]
    return np.where(fresh | (before < 0), END, before)


def train(model: Model, docs: list[np.ndarray], adam: Adam) -> None:
    """One pass of truncated backpropagation over the documents, laid end to end and cut into lanes of equal length.

    The state of a lane is carried from window to window; only the few documents that a cut parts lose theirs once.
    """
    s = model.s
    stream = np.concatenate(docs)
    starts = np.zeros(len(stream), bool)
    starts[np.cumsum([0, *map(len, docs)])[:-1]] = True
    lanes = max(min(s.lanes, len(stream) // s.window), 1)
    steps = -(-len(stream) // lanes)
    rest = steps * lanes - len(stream)
    # what is missing in the last lane is filled from the start of the stream
    symbols, fresh = (np.concatenate([x, x[:rest]]).reshape(lanes, steps).T for x in (stream, starts))
    fresh = fresh.copy()
    fresh[0] = True
    before = before_of(symbols, fresh)
    h = np.zeros((lanes, s.hidden), np.float32)
    for t in range(0, steps, s.window):
        end = min(t + s.window, steps)
        grad, h, _ = model.train_window(before[t:end], symbols[t:end], fresh[t:end], h)
        norm = float(np.sqrt((grad * grad).sum()))
        if norm > s.clip:
            grad *= np.float32(s.clip / norm)
        adam.update(model.flat, grad)


def log_likelihoods(model: Model, docs: list[np.ndarray], lanes: int = 512, window: int = 128) -> np.ndarray:
    """Natural log probability of each whole document, state carried across its windows."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    total, longest = sum(map(len, docs)), max(map(len, docs))
    symbols, fresh, which = in_lanes(docs, min(lanes, max(total // max(longest, 1), 32)))
    before = before_of(symbols, fresh)
    active = (symbols >= 0).sum(axis=1)
    k = model.s.hidden
    h = np.zeros((symbols.shape[1], k), np.float32)
    inp, rec = model.halved()
    for t in range(0, len(symbols), window):
        end = min(t + window, len(symbols))
        width = int(active[t])
        gates = inp[before[t:end, :width]]
        states = np.zeros((end - t, width, k), np.float32)
        begins = fresh[t:end].any(axis=1)
        for i in range(end - t):
            n = int(active[t + i])
            # lanes end in order, so the first n go on; a state that a document starts from is not read again
            own = h[:n]
            if begins[i]:
                own[fresh[t + i, :n]] = 0
            h = model.step(gates[i, :n], own, rec)[0]
            states[i, :n] = h
        there = symbols[t:end, :width] >= 0
        logp, _ = model.output(states[there], symbols[t:end, :width][there])
        out += np.bincount(which[t:end, :width][there], logp, len(docs))
    return out


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _bundled(docs: DataFrame, s: Settings) -> tuple[DataFrame, int]:
    """b (bundle), doc_id, held_out, packed, rows spread evenly whatever their ids and texts are; and the number of bundles."""
    size = docs.agg(F.sum(F.octet_length(raw("text")))).first()[0]
    n = parts_for(docs.sparkSession, size, s.bundle_bytes)
    doc_id = F.col("doc_id").cast("bigint")
    rows = packed(docs, doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"))
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    return rows.withColumn("b", F.element_at(longs(_one_per_partition(docs.sparkSession, n)), turn + 1)).repartition(n, "b"), n


def _one_per_partition(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that a hash partitioning of ``n`` partitions deals to a partition each, so that no task gets several bundles."""
    place = F.pmod(F.hash("id"), F.lit(n)).alias("p")
    found = spark.range(n * (12 + 2 * n.bit_length())).groupBy(place).agg(F.min("id").alias("id"))
    own = [r["id"] for r in found.collect()]
    # a partition that no number was dealt to stays empty; its share goes to others
    return own + own[: n - len(own)]


def _numbered_words(rows: DataFrame) -> DataFrame:
    """Texts as places in the list of distinct words of their bundle, and that list.

    Rows of documents: b, doc_id, held_out and places (little-endian 32-bit, compressed). Rows of words: b, word, place and n, its number in training
    documents of the bundle (0 if only others have it).
    """
    schema = pa.schema([("b", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("places", pa.binary()),
                        ("word", pa.binary()), ("place", pa.int32()), ("n", pa.int64())])

    def columns(length: int, **given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(length, f.type)) for f in schema], schema=schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        lists: dict[int, dict[bytes, int]] = {}
        trained: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            places = []
            for b, out, text in zip(*(batch.column(c).to_pylist() for c in ("b", "held_out")), unpacked(batch.column("packed").to_pylist())):
                if b not in lists:
                    # a word that is new gets the next place
                    lists[b] = defaultdict(itertools.count().__next__)
                words = _words(text)
                own = np.fromiter(map(lists[b].__getitem__, words), "<u4", len(words))
                if not out:
                    trained.setdefault(b, []).append(own)
                places.append(press(own.tobytes()))
            yield columns(batch.num_rows, **{c: batch.column(c).cast(schema.field(c).type) for c in ("b", "doc_id", "held_out")},
                          places=pa.array(places, pa.binary()))
        for b, at in lists.items():
            n = np.bincount(np.concatenate([np.zeros(0, "<u4"), *trained.pop(b, [])]).astype(np.int64), minlength=len(at))
            words = list(at)
            for k in range(0, len(words), 50_000):
                some = words[k: k + 50_000]
                yield columns(len(some), b=pa.array([b] * len(some), pa.int64()), word=pa.array(some, pa.binary()),
                              place=pa.array(range(k, k + len(some)), pa.int32()), n=pa.array(n[k: k + len(some)]))

    return rows.mapInArrow(
        number, "b bigint, doc_id bigint, held_out boolean, places binary, word binary, place int, n bigint")


def _trained(docs: DataFrame, symbols: Symbols, s: Settings) -> tuple[Model, int]:
    """Weights after all rounds of data-parallel training, and the number of symbols that gave a gradient."""
    model, trained_on = Model(symbols, s), 0
    doc_id = F.col("doc_id").cast("bigint")
    turn = F.pmod(F.xxhash64(doc_id, raw("text")), F.lit(1_000_000)) / F.lit(1_000_000.0) / F.lit(s.train_share / s.rounds)
    rows = docs.where(~held_out(doc_id)).select(F.floor(turn).alias("turn"), raw("text").alias("text"))
    for r in range(s.rounds):
        start = model.flat

        def local(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own = Model(symbols, s, start.copy())
            adam = Adam(len(start), s.rate)
            number = symbols.number.get
            held: list[np.ndarray] = []
            size = seen = 0
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    words = _words(text)
                    doc = np.append(np.fromiter(map(number, words, itertools.repeat(OTHER)), np.int32, len(words)), np.int32(END))
                    held.append(doc)
                    size += len(doc)
                    if size > 500_000:
                        train(own, held, adam)
                        seen, size, held = seen + size, 0, []
            if held:
                train(own, held, adam)
                seen += size
            if seen:
                # blocks of weights, weighted by symbols, and the symbols themselves as the last one
                blocks = [*np.array_split(own.flat.astype(float) * seen, max(len(start) // 4096, 1)), np.array([float(seen)])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(len(blocks)), pa.int64()), pa.array([x.tolist() for x in blocks], pa.list_(pa.float64()))], ["block", "w"])

        parts = rows.where(F.col("turn") == r).select("text").mapInArrow(local, "block bigint, w array<double>")
        sums = sorted(parts.groupBy("block").agg(Summarizer.sum(array_to_vector("w")).alias("w")).select("block", vector_to_array("w").alias("w")).collect())
        if sums:
            x = np.concatenate([r["w"] for r in sums])
            model = Model(symbols, s, (x[:-1] / x[-1]).astype(np.float32))
            trained_on += int(x[-1])
    return model, trained_on


def score(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    # written, so that the documents and the words of a bundle go together whatever becomes of its task
    bundled, parts = _bundled(docs, s)
    numbered = stage(_numbered_words(bundled), "bundles")
    own = numbered.where(F.col("word").isNotNull()).select("b", "word", "place", "n")
    counts = stage(own.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    ends = docs.where(~held_out(F.col("doc_id"))).count()
    total = counts.where("c > 0").agg(F.count(F.lit(1)), F.sum("c")).first()
    v, n = total[0] + (ends > 0), (total[1] or 0) + ends
    top = counts.where("c > 0").orderBy(F.desc("c"), "word").limit(s.vocabulary).collect()
    inside = sum(r["c"] for r in top)
    symbols = Symbols([bytes(r["word"]) for r in top], [r["c"] for r in top], ends, n - ends - inside, s.classes)
    flat = _trained(docs, symbols, s)[0].flat
    # of the words outside the vocabulary: smoothed share of a word among them
    rest = (n - ends - inside) + (total[0] - len(top)) + 1
    base_log = math.log10(n + v + 1)
    end_term = math.log10(ends + 1) - base_log

    def judge(_, left: pa.Table, right: pa.Table) -> pa.Table:
        own = Model(symbols, s, flat)
        # what a text needs of a word comes from arrays by its place
        at, c = right.column("place").to_numpy(), right.column("c").to_numpy()
        count, symbol_of = np.zeros(len(at), np.int64), np.full(len(at), OTHER, np.int32)
        count[at] = c
        for k, w in zip(at.tolist(), right.column("word").to_pylist()):
            if w is not None:
                symbol_of[k] = symbols.number.get(w, OTHER)
        log_of = np.log10(count + 1.0)
        names, out = left.column("doc_id").to_pylist(), left.column("held_out").to_pylist()
        packs = left.column("places").to_pylist()
        tokens, known, base, scores = [], [], [], []
        held: list[np.ndarray] = []
        extra: list[float] = []
        size = 0

        def flush() -> None:
            found = log_likelihoods(own, held)
            scores.extend((found / LN10 + np.array(extra)).tolist())
            held.clear(), extra.clear()

        for k in range(0, len(packs), 64):
            for places in unpacked(packs[k: k + 64]):
                at = np.frombuffer(places, "<u4")
                doc = np.append(symbol_of[at], np.int32(END))
                logs = log_of[at]
                tokens.append(len(doc))
                known.append(int((count[at] > 0).sum()) + (ends > 0))
                base.append(float(logs.sum() - base_log * len(at) + end_term))
                others = doc[:-1] == OTHER
                extra.append(float(logs[others].sum() - math.log10(rest) * others.sum()))
                held.append(doc)
                size += len(doc)
            if size > 2_000_000:
                flush()
                size = 0
        flush()
        return pa.table({
            "doc_id": pa.array(names, pa.int64()), "held_out": pa.array(out, pa.bool_()), "n_tokens": pa.array(tokens, pa.int64()),
            "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n] * len(names), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    # only words as frequent as the rarest of the vocabulary travel as such
    least = min([r["c"] for r in top], default=0)
    with_c = own.join(counts, "word").select("b", "place", "c", F.when(F.col("c") >= least, F.col("word")).alias("word"))
    rows = numbered.where(F.col("word").isNull()).select(F.col("b").alias("b"), "doc_id", "held_out", "places")
    # dealt out as the bundles were, one to a task
    return rows.repartition(parts, "b").groupBy("b").cogroup(with_c.repartition(parts, "b").groupBy("b")).applyInArrow(
        judge, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
