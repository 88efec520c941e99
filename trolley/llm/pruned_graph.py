"""Approximate nearest neighbours over robust-pruned directed graphs, one per shard.

Vectors are dealt to shards by hash. The graph of a shard is built by insertion in growing batches: a greedy beam search in the
graph so far proposes the nodes it went through, and relaxed distance pruning keeps the diverse ones: a candidate goes once a kept
neighbour is nearer to it, by the factor ``relax``, than the node itself. Edges are added both ways; a full node prunes again. The index is
a table with a row per different vector (``build``), written once, so a lost executor costs no second build. ``search`` sends every query
through a beam search of every shard, rescores what the beams hold in double precision on the original vectors and merges the
lists. Steps of many searches run together as array operations.

Shards hold ``growth * sqrt(n)`` vectors, between ``least_shard`` and ``most_shard``: a task's memory is bounded, and fewer, larger shards
serve more vectors, as a beam search costs about the same in any of them. All queries meet all shards, in blocks of ``query_block``.
Equal vectors are one node, which keeps their ``keep`` smallest ids: more can't be among the nearest.

Defined results: rows without id, whose vector is null, empty or zero, or holds nulls or values that are not finite, take no part. Vectors of
different lengths never meet. A query's own row is left out once; rows that repeat its id are candidates. Repeated query rows
give their list once each. A query with fewer candidates gets a shorter list or none. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first
from trolley.session import stage


@dataclass(frozen=True)
class Settings:
    degree: int = 40
    build_beam: int = 64
    beam: int = 160
    relax: float = 1.2
    passes: int = 1
    #: Nodes that a step of a search expands together.
    wide: int = 4
    #: Nodes that every search starts from: the one nearest to the mean, and others by hash.
    starts: int = 16
    batch: int = 1024
    least_shard: int = 8192
    most_shard: int = 131_072
    growth: int = 64
    query_block: int = 131_072


#: Cells of the table of nodes that a batch of searches has seen.
SEEN_CELLS = 32 << 20
FAR = np.float32(np.inf)


@dataclass
class Graph:
    """Unit vectors and up to ``degree`` neighbours of each, -1 behind the last; the first ``size`` nodes are in."""

    x: np.ndarray
    edges: np.ndarray
    size: int

    def distance(self, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
        return 2 - 2 * np.einsum("ij,ij->i", self.x[nodes], points)


def beam_search(g: Graph, points: np.ndarray, beam: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest nodes and their squared distances, and the nodes expanded on the way with theirs, nearest first, -1 behind the last."""
    b, wide = len(points), s.wide
    starts = np.arange(min(s.starts, g.size))
    row = np.arange(b)[:, None]
    seen = np.zeros((b, g.size), bool)
    seen[:, starts] = True
    near = np.full((b, beam), -1, np.int32)
    far = np.full((b, beam), FAR, np.float32)
    k = min(len(starts), beam)
    first = 2 - 2 * points @ g.x[starts].T
    order = np.argsort(first, axis=1, kind="stable")[:, :k]
    near[:, :k], far[:, :k] = starts[order], first[row, order]
    open_ = near >= 0
    passed, passed_far = [], []
    active = np.arange(b)
    while len(active):
        a = active[:, None]
        # the nearest nodes of each beam that are not expanded yet
        rank = np.cumsum(open_[active], axis=1)
        take = open_[active] & (rank <= wide)
        at = np.argsort(~take, axis=1, kind="stable")[:, :wide]
        chosen = np.take_along_axis(take, at, 1)
        nodes = np.where(chosen, near[a, at], -1)
        passed.append((active, nodes))
        passed_far.append(np.where(chosen, far[a, at], FAR))
        open_[active] &= ~take
        found = np.where(nodes[:, :, None] >= 0, g.edges[nodes], -1).reshape(len(active), -1)
        found.sort(axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[a, found]
        r, c = np.nonzero(fresh)
        new = found[r, c]
        seen[active[r], new] = True
        dist = g.distance(new, points[active[r]])
        better = dist < far[active[r], -1]
        r, new, dist = r[better], new[better], dist[better]
        # room for what each search found: its nodes side by side behind its beam
        count = np.bincount(r, minlength=len(active))
        most = int(count.max(initial=0))
        if most:
            place = np.arange(len(r)) - (np.cumsum(count) - count)[r]
            ids = np.full((len(active), most), -1, np.int32)
            ds = np.full((len(active), most), FAR, np.float32)
            ids[r, place], ds[r, place] = new, dist
            ids = np.concatenate([near[active], ids], axis=1)
            ds = np.concatenate([far[active], ds], axis=1)
            still = np.concatenate([open_[active], np.isfinite(ds[:, beam:])], axis=1)
            order = np.argsort(ds, axis=1, kind="stable")[:, :beam]
            near[active] = np.take_along_axis(ids, order, 1)
            far[active] = np.take_along_axis(ds, order, 1)
            open_[active] = np.take_along_axis(still, order, 1)
        active = active[open_[active].any(axis=1)]
    total = sum(n.shape[1] for _, n in passed)
    way, way_far = np.full((b, total), -1, np.int32), np.full((b, total), FAR, np.float32)
    for k, ((rows, nodes), d) in enumerate(zip(passed, passed_far)):
        way[rows, k * wide: (k + 1) * wide], way_far[rows, k * wide: (k + 1) * wide] = nodes, d
    order = np.argsort(way_far, axis=1, kind="stable")
    return near, far, np.take_along_axis(way, order, 1), np.take_along_axis(way_far, order, 1)


def robust_prune(g: Graph, candidates: np.ndarray, far: np.ndarray, s: Settings) -> np.ndarray:
    """Neighbours that stay of ``candidates`` (nearest first, -1 behind the last) at squared distances ``far`` from their node."""
    out = np.full((len(candidates), g.edges.shape[1]), -1, np.int32)
    for k in range(0, len(candidates), 256):
        ids, d = candidates[k: k + 256], far[k: k + 256]
        x = g.x[ids]
        between = (2 - 2 * x @ x.transpose(0, 2, 1)) * np.float32(s.relax**2)
        alive, row = ids >= 0, np.arange(len(ids))
        for slot in range(out.shape[1]):
            best = alive.argmax(axis=1)
            some = alive[row, best]
            if not some.any():
                break
            out[k: k + 256, slot] = np.where(some, ids[row, best], -1)
            alive &= between[row, best] > d
            alive[row, best] = False
    return out


def _add_back(g: Graph, nodes: np.ndarray, s: Settings) -> None:
    """The edges of ``nodes`` the other way round, pruned where a node has no room."""
    out = g.edges[nodes]
    source, slot = np.nonzero(out >= 0)
    target, source = out[source, slot], nodes[source]
    dist = g.distance(source, g.x[target])
    order = np.lexsort((source, dist, target))
    target, source, dist = target[order], source[order], dist[order]
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.array([], int)
    place = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
    into = target[first]
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(target)]))
    degree = g.edges.shape[1]
    room = min(int(place.max(initial=-1)) + 1, 2 * degree)
    near = place < room
    new, new_far = np.full((len(into), room), -1, np.int32), np.full((len(into), room), FAR, np.float32)
    new[group[near], place[near]], new_far[group[near], place[near]] = source[near], dist[near]
    old = g.edges[into]
    new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
    new_far[new < 0] = FAR
    r, c = np.nonzero(old >= 0)
    old_far = np.full(old.shape, FAR, np.float32)
    old_far[r, c] = g.distance(old[r, c], g.x[into[r]])
    ids, d = np.concatenate([old, new], axis=1), np.concatenate([old_far, new_far], axis=1)
    order = np.argsort(d, axis=1, kind="stable")
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    full = (ids >= 0).sum(axis=1) > degree
    g.edges[into[~full]] = ids[~full, :degree]
    g.edges[into[full]] = robust_prune(g, ids[full], d[full], s)


def _linked(g: Graph, nodes: np.ndarray, s: Settings) -> None:
    """Neighbours of ``nodes`` by searches of the graph as it is."""
    step = max(1, min(s.batch, SEEN_CELLS // max(g.size, 1)))
    ways = []
    for k in range(0, len(nodes), step):
        own = nodes[k: k + step]
        _, _, way, far = beam_search(g, g.x[own], s.build_beam, s)
        old = g.edges[own]
        r, c = np.nonzero(old >= 0)
        if len(r):
            old_far = np.full(old.shape, FAR, np.float32)
            old_far[r, c] = g.distance(old[r, c], g.x[own[r]])
            old[(old[:, :, None] == way[:, None, :]).any(axis=2)] = -1
            old_far[old < 0] = FAR
            way, far = np.concatenate([way, old], axis=1), np.concatenate([far, old_far], axis=1)
        far = np.where(way == own[:, None], FAR, far)
        way = np.where(way == own[:, None], -1, way)
        order = np.argsort(far, axis=1, kind="stable")[:, : 3 * s.build_beam]
        ways.append(robust_prune(g, np.take_along_axis(way, order, 1), np.take_along_axis(far, order, 1), s))
    g.edges[nodes] = np.concatenate(ways)
    g.size = max(g.size, int(nodes.max()) + 1)
    _add_back(g, nodes, s)


def build_graph(x: np.ndarray, s: Settings) -> Graph:
    """Graph over unit vectors; the first ``starts`` rows are where searches start."""
    n = len(x)
    g = Graph(x, np.full((n, s.degree), -1, np.int32), 0)
    first = min(n, 4 * s.starts)
    far = 2 - 2 * x[:first] @ x[:first].T
    np.fill_diagonal(far, FAR)
    ids = np.argsort(far, axis=1, kind="stable")[:, : first - 1].astype(np.int32)
    g.size = first
    if first > 1:
        g.edges[:first] = robust_prune(g, ids, np.take_along_axis(far, ids, 1), s)
        _add_back(g, np.arange(first), s)
    for turn in range(s.passes):
        at = first if turn == 0 else 0
        while at < n:
            to = min(n, at + min(max(at, first), s.batch))
            _linked(g, np.arange(at, to), s)
            at = to
    return g


# --- the index as a table --------------------------------------------------------------------------

INDEX = "size int, shard int, node int, ids array<bigint>, v binary, edges binary"


def sound(v: Column) -> Column:
    """Vectors that take part."""
    huge = F.lit(float("inf"))
    return F.coalesce(F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < huge)) & F.exists(v, lambda e: e != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, which is exact, so that no square overflows or vanishes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    v = scaled(vectors)
    return (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows in double precision, summed in the order of the components."""
    a, b = scaled(a), scaled(b)
    dot = lambda p, q: np.cumsum(p * q, axis=1)[:, -1]
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def _doubles(values: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<f8") for v in values.to_pylist()])


def shard_rows(n: Column, s: Settings) -> Column:
    return F.least(F.greatest(F.sqrt(n) * s.growth, F.lit(s.least_shard)), F.lit(s.most_shard))


def build(rows: DataFrame, keep: int, s: Settings = Settings(), id_column: str = "vec_id") -> DataFrame:
    """The index, a written table: one row per different vector with its ``keep`` smallest ids and its neighbours."""
    v = F.col("embedding").cast("array<double>")
    good = rows.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & sound(F.col("v")))
    # the few smallest ids of a vector: cut per task before anything is shuffled
    first = best_first(good.withColumn("tie", F.lit(0)), ["v"], keep, "tie", "id")
    nodes = stage(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("size", F.size("v")), "graph-vectors")
    sizes = nodes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    shards = sizes.select("size", F.ceil(F.col("n") / shard_rows(F.col("n"), s)).cast("int").alias("shards"))
    dealt = nodes.join(shards, "size").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))

    def grow(group: pa.Table) -> pa.Table:
        values = np.array(group.column("v").combine_chunks().flatten()).reshape(group.num_rows, -1)
        x = unit(values)
        # an order that no source or copy decides; the start nearest to the mean comes first
        order = np.argsort(np.array(group.column("turn")), kind="stable")
        middle = int(np.argmax(x[order] @ x.mean(axis=0)))
        order = np.r_[order[middle], np.delete(order, middle)]
        g = build_graph(np.ascontiguousarray(x[order]), s)
        group = group.take(pa.array(order))
        return pa.table({
            "size": group.column("size"), "shard": group.column("shard"), "node": pa.array(np.arange(len(order)), pa.int32()),
            "ids": group.column("ids"), "v": pa.array([r.astype("<f8").tobytes() for r in values[order]], pa.binary()),
            "edges": pa.array([e[e >= 0].astype("<i4").tobytes() for e in g.edges], pa.binary())})

    turned = dealt.select("size", "shard", "ids", "v", F.xxhash64(F.lit(1), F.element_at("ids", 1), "v").alias("turn"))
    # a task per shard, whatever few bytes it has
    turned = turned.repartition(2 * (shards.agg(F.sum("shards")).first()[0] or 1), "size", "shard")
    return stage(turned.groupBy("size", "shard").applyInArrow(grow, INDEX), "graph-index")


def search(index: DataFrame, queries: DataFrame, k: int, s: Settings = Settings(), id_column: str = "vec_id") -> DataFrame:
    """The ``k`` nearest found per row of ``queries``: query_id, rank (from 1), vec_id, score."""
    v = F.col("embedding").cast("array<double>")
    asked = queries.select(F.col(id_column).cast("bigint").alias("query_id"), v.alias("q")).where(F.col("query_id").isNotNull() & sound(F.col("q")))
    asked = stage(asked.groupBy("query_id", "q").agg(F.count(F.lit(1)).alias("times")).withColumns(
        {"size": F.size("q"), "query": F.xxhash64("query_id", "q")}), "graph-queries")
    blocks = asked.agg(F.greatest(F.ceil(F.count(F.lit(1)) / s.query_block), F.lit(1)).cast("int")).scalar()
    places = index.groupBy("size").agg(F.max("shard").alias("last"))
    nodes = index.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "size", "shard", "block", F.lit(0).alias("kind"), F.col("node").cast("bigint").alias("at"), "v", "edges", "ids",
        F.lit(None).cast("bigint").alias("query_id"), F.lit(None).cast("array<double>").alias("q"))
    points = asked.join(places, "size").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last")))).select(
        "size", "shard", F.pmod("query", blocks).cast("int").alias("block"), F.lit(1).alias("kind"), F.col("query").alias("at"),
        F.lit(None).cast("binary").alias("v"), F.lit(None).cast("binary").alias("edges"), F.lit(None).cast("array<bigint>").alias("ids"),
        "query_id", "q")

    def beams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        g = values = ids = None
        for batch in batches:
            keys = np.stack([np.array(batch.column(c)) for c in ("size", "shard", "block", "kind")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                part, here = batch.slice(at, to - at), tuple(keys[at, :3])
                if here != place:
                    place, held, g = here, [], None
                if keys[at, 3] == 0:
                    held.append(part.select(["v", "edges", "ids"]))
                    continue
                if g is None:
                    table = pa.Table.from_batches(held)
                    held = []
                    values, ids = _doubles(table.column("v")), table.column("ids").combine_chunks()
                    found = [np.frombuffer(e, "<i4") for e in table.column("edges").to_pylist()]
                    edges = np.full((len(found), max(map(len, found), default=0) or 1), -1, np.int32)
                    for n, e in enumerate(found):
                        edges[n, : len(e)] = e
                    g = Graph(unit(values), edges, len(found))
                q = np.array(part.column("q").flatten()).reshape(part.num_rows, -1)
                step = max(1, min(256, SEEN_CELLS // g.size))
                for n in range(0, len(q), step):
                    some = q[n: n + step]
                    near = beam_search(g, unit(some), s.beam, s)[0]
                    row, slot = np.nonzero(near >= 0)
                    node = near[row, slot]
                    score = cosine(some[row], values[node])
                    order = np.lexsort((node, -score, row))
                    row, node, score = row[order], node[order], score[order]
                    # own node and k others
                    keep = np.arange(len(row)) - np.searchsorted(row, row) <= k
                    # equal scores at the cut: their smaller ids may be behind
                    last = np.full(len(some), np.inf)
                    np.minimum.at(last, row[keep], score[keep])
                    keep |= score == last[row]
                    row, node, score = row[keep], node[keep], score[keep]
                    same = (some[row] == values[node]).all(axis=1)
                    yield pa.RecordBatch.from_arrays([
                        part.column("query_id").take(pa.array(n + row)), part.column("at").take(pa.array(n + row)),
                        ids.take(pa.array(node)), pa.array(score), pa.array(same)], ["query_id", "query", "ids", "score", "same"])

    dealt = (nodes.unionByName(points).repartition("size", "shard", "block").sortWithinPartitions("size", "shard", "block", "kind", "at"))
    near = dealt.mapInArrow(beams, "query_id bigint, query bigint, ids array<bigint>, score double, same boolean")
    own = F.when(F.col("same"), F.array_position("ids", F.col("query_id")).cast("int")).otherwise(0)
    others = F.filter("ids", lambda x, i: i + 1 != F.col("own"))
    found = near.withColumn("own", own).select("query_id", "query", "score", F.explode(others).alias("vec_id"))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    times = asked.select("query_id", "query", "times")
    return best.join(times, ["query_id", "query"]).withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select(
        "query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, queries: DataFrame, k: int, s: Settings = Settings(), id_column: str = "vec_id") -> DataFrame:
    """The ``k`` nearest rows found of each query row, itself left out."""
    return search(build(rows, k + 1, s, id_column), queries, k, s, id_column)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of ``exact`` (query_id, vec_id) that were found."""
    hits = exact.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0] or 1.0
