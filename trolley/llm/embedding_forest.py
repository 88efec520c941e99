"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again along a random direction at the median of their projections; vectors near the cut, by ``spill``
times the length of the difference of two linked unit vectors, go to both sides. A node whose vectors nearly all lie there is
a dense group and stays a leaf, so no cut runs through it. Vectors are compared within the leaves of ``trees`` such trees,
by cosine in double precision, if their labels agree. With the defaults a pair at the threshold is missed by all trees with a
probability of about 1e-5.

The cuts are fitted on a bounded sample (``sample`` vectors, those with the least hash of their id); every vector is
sent down every tree. A leaf that still holds over ``most`` vectors of a label is cut again, with cuts fitted on ``again`` vectors of its own, round
by round until no such leaf can be cut, so leaves stay small however many vectors there are. Equal vectors of a label are one vector with a weight. A leaf is cut into blocks, a task per pair of blocks,
so a leaf that a dense group fills stays spread out. A linked pair counts in the first leaf that both share only, so the numbers of
links are sums over leaves and no pair needs to be emitted; what leaves a task are sums per vector and the links of a spanning forest.

Defined results: a vector without id, without label, that is null, empty or zero, or that holds nulls or values that are not finite, links with
nothing, and so do vectors of different lengths. Repeated rows are vectors of their own (they link). A row without
id gets null component_id and kept = true. An empty table gives no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.components import block_pairs, components, sorted_groups
from trolley.session import stage


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.93
    trees: int = 8
    spill: float = 0.55
    most_shared: float = 0.85
    leaf: int = 2048
    sample: int = 20_000
    #: A node of the sample with fewer vectors is not cut, as its median says little.
    least_sample: int = 32
    #: A leaf with more vectors is cut again, with cuts fitted on ``again`` of them.
    most: int = 8192
    again: int = 4096
    block: int = 1024
    seed: int = 7


@dataclass(frozen=True)
class Node:
    direction: np.ndarray
    low: float
    high: float
    left: "Node | None"
    right: "Node | None"


def scaled(v: np.ndarray) -> np.ndarray:
    """``v`` times a power of two that brings its largest component near 1: the same angles, and no square becomes 0 or infinite."""
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1])


def grow(points: np.ndarray, depth: int, s: Settings, rng: np.random.Generator) -> Node | None:
    """Tree over unit vectors; None is a leaf. Vectors below ``high`` go left, those from ``low`` on go right."""
    if depth <= 0 or len(points) < 2 * s.least_sample:
        return None
    direction = rng.standard_normal(points.shape[1])
    at = points @ direction
    width = s.spill * math.sqrt(max(2 - 2 * s.cosine, 0))
    low, high = np.median(at) - width, np.median(at) + width
    if max((at < high).mean(), (at >= low).mean()) > s.most_shared:
        return None
    return Node(direction, float(low), float(high), grow(points[at < high], depth - 1, s, rng),
                grow(points[at >= low], depth - 1, s, rng))


def leaves(tree: Node | None, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each leaf that has rows (its path as bits behind a leading 1), and those rows."""
    todo = [(tree, 1, np.arange(len(points)))]
    while todo:
        node, path, rows = todo.pop()
        if not len(rows):
            continue
        if node is None:
            yield path, rows
            continue
        at = points[rows] @ node.direction
        todo.append((node.left, 2 * path, rows[at < node.high]))
        todo.append((node.right, 2 * path + 1, rows[at >= node.low]))


def fit(vectors: DataFrame, rows: int, s: Settings) -> dict[int, list[Node | None]]:
    """Trees by vector length, on a bounded sample of ``vectors`` (rid, v)."""
    some = (vectors.withColumn("r", F.xxhash64("rid")).orderBy("r", "rid").limit(s.sample).select("v").toPandas())
    points = [scaled(np.array(v, float)) for v in some["v"]]
    rng = np.random.default_rng(s.seed)
    depth = math.ceil(math.log2(max(rows / s.leaf, 1)))
    found = {}
    for size in sorted({len(p) for p in points}):
        x = np.stack([p / np.linalg.norm(p) for p in points if len(p) == size])
        found[size] = [grow(x, depth, s, rng) for _ in range(s.trees)]
    return found


PLACES = "rid bigint, label string, weight bigint, size int, x binary, codes array<bigint>, code bigint"


def placed(vectors: DataFrame, trees: dict[int, list[Node | None]]) -> DataFrame:
    """One row per vector and leaf: its code there and all its codes (tree and leaf in one number), the vector as doubles."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [scaled(np.array(v, float)) for v in batch.column("v").to_pylist()]
            codes: list[list[int]] = [[] for _ in values]
            lengths = np.array([len(v) for v in values], int)
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                x = np.stack([values[k] / np.linalg.norm(values[k]) for k in own])
                for t, tree in enumerate(trees.get(int(size), [None])):
                    for path, rows in leaves(tree, x):
                        for k in own[rows]:
                            codes[k].append(t << 40 | path)
            for k in range(0, len(values), 256):
                some = range(k, min(k + 256, len(values)))
                take = np.repeat(np.array(some), [len(codes[i]) for i in some])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(take)) for c in ("rid", "label", "weight")),
                    pa.array(lengths[take], pa.int32()), pa.array([values[i].tobytes() for i in take], pa.binary()),
                    pa.array([sorted(codes[i]) for i in take], pa.list_(pa.int64())),
                    pa.array([c for i in some for c in sorted(codes[i])], pa.int64())],
                    ["rid", "label", "weight", "size", "x", "codes", "code"])

    return vectors.select("rid", "label", "weight", "v").mapInArrow(down, PLACES)


def _leaf(spots: DataFrame) -> DataFrame:
    return spots.withColumn("leaf", F.concat_ws(":", "code", "size", "label"))


def deepened(spots: DataFrame, s: Settings) -> DataFrame:
    """The same vectors with the leaves of over ``most`` of them cut again, until those left are dense groups."""
    tried = None
    while True:
        sizes = _leaf(spots).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > s.most)
        large = stage(sizes if tried is None else sizes.join(tried, "leaf", "left_anti"), "large-leaves")
        if large.isEmpty():
            return spots
        tried = large.select("leaf") if tried is None else tried.union(large.select("leaf"))
        rows = _leaf(spots).join(large, "leaf").select("leaf", "n", "rid", "code", "x")
        first = Window.partitionBy("leaf").orderBy(F.xxhash64("rid"), "rid")
        some = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= s.again)
        trees = stage(some.select("leaf", "n", "x").groupBy("leaf").applyInArrow(
            lambda table: _subtree(table, s), "leaf string, n bigint, tree binary"), "subtrees")
        if trees.isEmpty():
            continue
        slices = F.ceil(F.col("n") / s.again).cast("bigint")
        dealt = trees.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        held = rows.withColumn("slice", F.pmod(F.xxhash64("rid", "code"), slices)).join(trees.select("leaf"), "leaf", "left_semi")
        moved = held.select("leaf", "slice", "rid", "code", "x").groupBy("leaf", "slice").cogroup(
            dealt.select("leaf", "slice", "tree").groupBy("leaf", "slice")
        ).applyInArrow(_resent, "rid bigint, code bigint, below array<bigint>")
        moved = stage(moved, "deeper-codes")
        # a vector has few codes, so they fit a row; its components follow by one join
        codes = (spots.select("rid", "code").join(moved, ["rid", "code"], "left")
                 .groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list(F.coalesce("below", F.array("code"))))).alias("codes")))
        own = spots.where(F.col("code") == F.col("codes")[0]).drop("codes", "code")
        spots = own.join(codes, "rid").select(*own.columns, "codes", F.explode("codes").alias("code"))
        spots = stage(spots.select("rid", "label", "weight", "size", "x", "codes", "code"), "leaf-places")


def _subtree(table: pa.Table, s: Settings) -> pa.Table:
    """Tree of one leaf from a sample of its vectors; no row where it cannot be cut."""
    leaf, n = table.column("leaf")[0].as_py(), table.column("n")[0].as_py()
    x = np.stack([np.frombuffer(b, float) for b in sorted(table.column("x").to_pylist())])
    x = x / np.linalg.norm(x, axis=1)[:, None]
    rng = np.random.default_rng([s.seed, *leaf.encode()])
    tree = grow(x, math.ceil(math.log2(n / s.leaf)), s, rng)
    kept = [] if tree is None else [pickle.dumps(tree)]
    return pa.table({"leaf": pa.array([leaf] * len(kept), pa.string()), "n": pa.array([n] * len(kept), pa.int64()),
                     "tree": pa.array(kept, pa.binary())})


def _resent(_, left: pa.Table, right: pa.Table) -> pa.Table:
    """Codes below their old one of some vectors of a leaf; the path within its tree is appended to the old path."""
    tree, code = pickle.loads(right.column("tree")[0].as_py()), left.column("code").to_pylist()
    below: list[list[int]] = [[] for _ in code]
    if code:
        x = np.stack([np.frombuffer(b, float) for b in left.column("x").to_pylist()])
        for path, rows in leaves(tree, x / np.linalg.norm(x, axis=1)[:, None]):
            bits = path.bit_length() - 1
            for k in rows:
                t, above = code[k] >> 40, code[k] & (1 << 40) - 1
                below[k].append(t << 40 | above << bits | path & (1 << bits) - 1)
    return pa.table({"rid": left.column("rid"), "code": left.column("code"), "below": pa.array(below, pa.list_(pa.int64()))})


def _compared(rows: DataFrame, s: Settings) -> DataFrame:
    """a, b, links: per vector the weights it links with (b null), and links of a spanning forest (links 0)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["leaf", "i", "j"]):
            rid, weight, own = (group.column(c).to_numpy() for c in ("rid", "weight", "own"))
            i, j, code = (group.column(c)[0].as_py() for c in ("i", "j", "code"))
            x = np.stack([np.frombuffer(b, float) for b in group.column("x").to_pylist()])
            norm = np.linalg.norm(x, axis=1)
            first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
            near = (x[first] @ x[second].T) / np.outer(norm[first], norm[second]) >= s.cosine
            if i == j:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            # pairs that an earlier leaf holds as well are counted there
            codes = group.column("codes").to_pylist()
            holders: dict[int, list[int]] = {}
            for k in range(len(rid)):
                for c in codes[k]:
                    if c < code:
                        holders.setdefault(c, []).append(k)
            counted = near.copy()
            place_a, place_b = np.full(len(rid), -1), np.full(len(rid), -1)
            place_a[first], place_b[second] = np.arange(len(first)), np.arange(len(second))
            for ks in holders.values():
                p, q = place_a[ks], place_b[ks]
                counted[np.ix_(p[p >= 0], q[q >= 0])] = False
            links = np.zeros(len(rid), np.int64)
            links[first] += counted @ weight[second]
            if i != j:
                links[second] += counted.T @ weight[first]
            some = np.flatnonzero(links)
            a, b = _forest(near, first, second, len(rid))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([rid[some], rid[a]]), pa.int64()),
                pa.array([None] * len(some) + rid[b].tolist(), pa.int64()),
                pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]), pa.int64())], ["a", "b", "links"])

    return (rows.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
            .select("leaf", "i", "j", "own", "rid", "weight", "x", "codes", "code")
            .mapInArrow(compare, "a bigint, b bigint, links bigint"))


def _forest(near: np.ndarray, first: np.ndarray, second: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    """Links of a spanning forest of the pairs in ``near``, whose rows are ``first`` and columns ``second``."""
    row_of, column_of = np.full(n, -1), np.full(n, -1)
    row_of[first], column_of[second] = np.arange(len(first)), np.arange(len(second))
    left = np.zeros(n, bool)
    left[first[near.any(axis=1)]] = True
    left[second[near.any(axis=0)]] = True
    a, b = [], []
    while left.any():
        top = int(np.argmax(left))
        left[top] = False
        queue = [top]
        while queue:
            k = queue.pop()
            reach = np.zeros(n, bool)
            if row_of[k] >= 0:
                reach[second[near[row_of[k]]]] = True
            if column_of[k] >= 0:
                reach[first[near[:, column_of[k]]]] = True
            new = np.flatnonzero(reach & left)
            left[new] = False
            a += [k] * len(new)
            b += new.tolist()
            queue += new.tolist()
    return a, b


def near_duplicates(rows: DataFrame, s: Settings = Settings(), id_column: str = "vec_id") -> DataFrame:
    """Per row: its id, n_links, component_id (smallest id reachable), kept (whether it is that one)."""
    v = F.col("embedding").cast("array<double>")
    named = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    huge = F.lit(float("inf"))
    sound = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < huge)) & F.exists("v", lambda e: e != 0)
    good = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    vectors = stage(good.groupBy("label", "v").agg(F.min("id").alias("rid"), F.count(F.lit(1)).alias("weight")), "vectors")
    trees = fit(vectors, vectors.count(), s)
    spots = _leaf(deepened(stage(placed(vectors, trees), "leaf-places"), s))
    sizes = spots.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = stage(_compared(block_pairs(spots.drop("size"), "leaf", sizes, "rid", s.block), s), "vector-links")

    parts = components(found.where("b is not null"), "vector-components")
    counts = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rid")
    known = (vectors.select("label", "v", "rid", "weight").join(counts, "rid", "left")
             .join(parts.select(F.col("node").alias("rid"), "component"), "rid", "left")
             .select(F.col("label").alias("l"), F.col("v").alias("u"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component", "rid").alias("component")))
    named = named.withColumn("good", F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    out = named.join(known, F.col("good") & (F.col("label") == F.col("l")) & (F.col("v") == F.col("u")), "left")
    out = out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                     F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))
