"""Near-duplicate texts by MinHash, banded candidates, odd sketches and full sets.

Every text is the set of hashes of its word shingles. Equal sets fall together first. Of the others,

1. MinHash samples fill ``bands`` keys of ``rows`` samples each; sets that share a key are candidates. The same samples are folded into
   an odd sketch, a bitmap of the parity of hashed samples; the population count of the exclusive-or of two sketches tells
   the similarity of two sets precisely where it is high (miss rate below 1e-5 for a similarity at the threshold, with the defaults).
2. Every set is held against its best pivot, the set among those it shares a key with that shares keys with most others. Full
   sets decide. In a large group of copies this alone links nearly all, one comparison each.
3. Where a key still joins different components, blocks of its sets are compared by sketch; what passes ties components to
   clusters, which hold every link still missing.
4. Within clusters, blocks of sets are compared: by sketch, then by full sets, skipping what is linked already. Only links that join components leave
   a task, never all pairs of a group.

Large keys and clusters are cut into blocks of bounded size, a task per pair of blocks; nothing is capped. Clusters whose members don't link to
a common pivot cost the square of their size in sketch comparisons, which is the price of losing no link.

Defined results: without words (null or empty text) the set is empty and linked with nothing. With fewer words than a shingle has, the
whole sequence is the one shingle. Rows with a null doc_id get null component_id and kept = true. Rows that repeat a doc_id are one node with
the links of all its texts; ``keep_one`` compares rows instead. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import MIX, mix64, raw
from trolley.llm.components import block_pairs, components, sorted_groups
from trolley.session import stage

#: Odd base of the polynomial hash of a word's bytes (an arbitrary fixed value).
BASE = 0x9E3779B97F4A7C15 | 1
WORD_SPACES = np.zeros(256, bool)
WORD_SPACES[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity in whole percent; ``slack`` how far an estimate may fall below it."""

    shingle: int = 2
    percent: int = 80
    bands: int = 40
    rows: int = 6
    sketch_bits: int = 512
    slack: float = 0.2
    sketch_block: int = 4096
    set_block: int = 1024

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_odd(self) -> int:
        """Largest population count of the exclusive-or of two sketches that passes."""
        least = self.percent / 100 - self.slack
        return math.ceil(self.sketch_bits / 2 * (1 - math.exp(-4 * self.samples * (1 - least) / self.sketch_bits)))


def estimate(odd: np.ndarray, s: Settings) -> np.ndarray:
    """Similarity from the population count of the exclusive-or of two sketches."""
    rest = np.maximum(1 - 2 * np.asarray(odd, float) / s.sketch_bits, 1e-9)
    return 1 + s.sketch_bits / (4 * s.samples) * np.log(rest)


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""

    def __init__(self, shingle: int):
        self.shingle = shingle
        self.inverse = pow(BASE, -1, 1 << 64)
        self.powers = self.inverses = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE, np.uint64)]))
                self.inverses = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, self.inverse, np.uint64)]))

    def words(self, text: bytes) -> np.ndarray:
        """A hash per word of a lower-cased text."""
        data = np.frombuffer(text, np.uint8)
        if not len(data):
            return np.zeros(0, np.uint64)
        self._grow(len(data) + 1)
        edge = np.diff(np.concatenate([[True], WORD_SPACES[data], [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)])])
            return mix64((total[end] - total[start]) * self.inverses[start])

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = self.words((text or b"").lower())
        w = min(self.shingle, len(words))
        if not w:
            return words
        with np.errstate(over="ignore"):
            out = words[: len(words) - w + 1].copy()
            for k in range(1, w):
                out = mix64(out * MIX[1] + words[k: len(words) - w + 1 + k])
        return np.unique(out)


class Signer:
    """MinHash samples, band keys and odd sketch of a set."""

    def __init__(self, s: Settings):
        self.s = s
        seed = mix64(np.arange(2 * s.samples, dtype=np.uint64))
        self.times, self.plus = seed[: s.samples] | np.uint64(1), seed[s.samples:]
        self.mixing = mix64(np.arange(1000, 1000 + s.rows, dtype=np.uint64)) | np.uint64(1)
        self.band = mix64(np.arange(5000, 5000 + s.bands, dtype=np.uint64))
        self.sample = mix64(np.arange(9000, 9000 + s.samples, dtype=np.uint64))

    def __call__(self, items: np.ndarray) -> tuple[bytes, bytes]:
        """Sketch and band keys (64-bit, little-endian); of an empty set, an empty sketch and no keys."""
        if not len(items):
            return b"", b""
        s = self.s
        with np.errstate(over="ignore"):
            low = np.full(s.samples, np.uint64(2**64 - 1))
            for k in range(0, len(items), 512):
                np.minimum(low, (items[k: k + 512, None] * self.times + self.plus).min(axis=0), out=low)
            keys = mix64((low.reshape(s.bands, s.rows) * self.mixing).sum(axis=1, dtype=np.uint64) + self.band)
            bits = (mix64(low + self.sample) % np.uint64(s.sketch_bits)).astype(np.int64)
        odd = np.bincount(bits, minlength=s.sketch_bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes(), keys.astype("<u8").tobytes()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are as similar as asked for."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n (size of the set), g and h (hash of the set), sketch and keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(s.shingle), Signer(s)
        for batch in batches:
            n, g, h, sketches, keys = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                items = shingler(text)
                sketch, key = signer(items)
                n.append(len(items))
                g.append(int(np.bitwise_xor.reduce(mix64(items), initial=np.uint64(0)).astype(np.int64)))
                with np.errstate(over="ignore"):
                    h.append(int(items.sum(dtype=np.uint64).astype(np.int64)))
                sketches.append(sketch)
                keys.append(np.frombuffer(key, "<i8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, g, h)), pa.array(sketches, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "g", "h", "sketch", "keys"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw("text").alias("text")).mapInArrow(
        sign, "doc_id bigint, n bigint, g bigint, h bigint, sketch binary, keys array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """sid, items (sorted 64-bit hashes, little-endian) of the texts whose doc_id is in ``wanted``."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.shingle)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column("sid"),
                pa.array([shingler(t).astype("<u8").tobytes() for t in batch.column("text").to_pylist()], pa.binary())], ["sid", "items"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("sid"), raw("text").alias("text"))
    return rows.join(wanted, "sid", "left_semi").mapInArrow(shingles, "sid bigint, items binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    rows = pairs.join(sets.select(F.col("sid").alias("b"), F.col("items").alias("y")), "b")
    rows = rows.join(sets.select(F.col("sid").alias("a"), F.col("items").alias("x")), "a")
    return rows.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def _matrix(column: pa.ChunkedArray, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, words)


def _passing(sketches: np.ndarray, sizes: np.ndarray, at: int, others: np.ndarray, s: Settings) -> np.ndarray:
    """Of ``others``, those that may be similar to row ``at`` by sketch and by size of the sets."""
    odd = np.bitwise_count(sketches[others] ^ sketches[at]).sum(axis=1)
    small, large = np.minimum(sizes[others], sizes[at]), np.maximum(sizes[others], sizes[at])
    return others[(odd <= s.most_odd) & (100 * small >= s.percent * large)]


def _similar(items: list[np.ndarray], at: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Of ``others``, those whose full sets are similar enough to that of row ``at``."""
    own = items[at]
    flat = np.concatenate([items[x] for x in others])
    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    size = np.array([len(items[x]) for x in others])
    both = np.add.reduceat(own[place] == flat, np.cumsum(size) - size, dtype=np.int64)
    return others[100 * both >= percent * (len(own) + size - both)]


def _walk(batches: Iterator[pa.RecordBatch], keys: list[str], s: Settings, full: bool) -> Iterator[pa.RecordBatch]:
    """Links that join components within each group, one per component at most: by sketch alone, or by full sets.

    A breadth-first search, largest component first, compares each row with the rows not reached yet.
    """
    for group in sorted_groups(batches, keys):
        comps, comp = np.unique(group.column("comp").to_numpy(), return_inverse=True)
        if len(comps) < 2:
            continue
        ids, sizes = group.column("sid").to_numpy(), group.column("n").to_numpy()
        sketches = _matrix(group.column("sketch"), s.sketch_bits // 64)
        items = [np.frombuffer(x, "<u8") for x in group.column("items").to_pylist()] if full else []
        order = np.argsort(comp, kind="stable")
        members = np.split(order, np.cumsum(np.bincount(comp))[:-1])
        left = np.arange(len(ids))
        reached = np.zeros(len(comps), bool)
        a, b = [], []
        for top in sorted(range(len(comps)), key=lambda c: -len(members[c])):
            if reached[top]:
                continue
            reached[top] = True
            queue = [top]
            left = left[comp[left] != top]
            while queue and len(left):
                for k in members[queue.pop()]:
                    found = _passing(sketches, sizes, k, left, s)
                    if full and len(found):
                        found = _similar(items, k, found, s.percent)
                    for x in found:
                        if not reached[comp[x]]:
                            reached[comp[x]] = True
                            queue.append(comp[x])
                            a.append(ids[k] if full else comps[comp[k]])
                            b.append(ids[x] if full else comps[comp[x]])
                    if len(found):
                        left = left[~reached[comp[left]]]
                        if not len(left):
                            break
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (whether it is that one)."""
    signed = stage(signatures(docs, s), "signatures")
    named = signed.where("n > 0 and doc_id is not null")
    # written, so that the rows of one hot set, which the join below brings together, can be split
    groups = stage(named.groupBy("g", "h", "n").agg(F.min("doc_id").alias("sid")), "set-groups")
    owners = stage(named.select("doc_id", "g", "h", "n").join(groups, ["g", "h", "n"]).select("doc_id", "sid"), "set-owners")
    distinct = signed.join(owners.where("doc_id = sid").select("doc_id").distinct(), "doc_id", "left_semi")

    keys = distinct.where("n > 0").select(F.col("doc_id").alias("sid"), F.explode("keys").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(keys.join(sizes, "key"), "shared-keys")
    degree = shared.groupBy("sid").agg(F.sum("size").alias("degree"))
    rated = shared.join(degree, "sid")
    pivots = rated.groupBy("key").agg(F.max(F.struct("degree", (-F.col("sid")).alias("minus"))).alias("p"))
    best = shared.join(pivots, "key").groupBy("sid").agg(F.max("p").alias("p"))
    pairs = best.select((-F.col("p.minus")).alias("a"), F.col("sid").alias("b")).where("a <> b")

    involved = shared.select("sid").distinct()
    sets = stage(_sets(docs, involved, s), "shingle-sets")
    same_text = owners.where("doc_id <> sid").select(F.col("sid").alias("a"), F.col("doc_id").alias("b"))
    links = stage(_verified(pairs, sets, s.percent), "pivot-links")
    first = stage(components(links, "pivot-components"), "pivot-components")

    traits = stage(
        distinct.where("n > 0").join(involved.withColumnRenamed("sid", "doc_id"), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("sid"), "n", "sketch")
        .join(first.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .select("sid", "n", "sketch", F.coalesce("component", "sid").alias("comp")), "set-traits")

    members = shared.select("key", "sid").join(traits.select("sid", "comp"), "sid")
    split = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi")
    rows = block_pairs(members.select("key", "sid").join(split.select("key"), "key", "left_semi"), "key", split, "sid", s.sketch_block)
    rows = rows.select("key", "i", "j", "sid").join(traits, "sid")

    def by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _walk(batches, ["key", "i", "j"], s, False)

    def by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _walk(batches, ["cluster", "i", "j"], s, True)

    ties = (rows.select("key", "i", "j", "sid", "n", "sketch", "comp").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j").mapInArrow(by_sketch, "a bigint, b bigint").distinct())
    clusters = components(ties, "clusters")
    inside = traits.join(clusters.select(F.col("node").alias("comp"), F.col("component").alias("cluster")), "comp")
    counts = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    rows = block_pairs(inside.select("cluster", "sid", "n", "sketch", "comp"), "cluster", counts, "sid", s.set_block)
    rows = rows.join(sets, "sid").select("cluster", "i", "j", "sid", "n", "sketch", "comp", "items")
    more = (rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
            .mapInArrow(by_set, "a bigint, b bigint"))

    final = components(links.union(more).union(same_text), "near-duplicates")
    out = signed.join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with all their columns, one row of each group of near duplicates: the one with the smallest doc_id.

    Rows are compared as rows, whatever their ids: those that share an id or have none are told apart by their place in a written copy.
    Rows without words stay.
    """
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "document-rows")
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), s)
    members = stage(found.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")), "document-groups")
    copies = members.where("__row <> __group").select("__group").distinct()
    inside = members.join(copies, "__group", "left_semi").join(rows.select("__row", F.col("doc_id").cast("bigint").alias("__id")), "__row")
    first = inside.groupBy("__group").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")).alias("__first"))
    gone = inside.join(first, "__group").where(F.col("__row") != F.col("__first.__row")).select("__row")
    return rows.join(gone, "__row", "left_anti").drop("__row")
