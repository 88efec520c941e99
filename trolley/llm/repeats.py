"""Repeated passages by maximal repeats of an enhanced suffix array.

A byte goes if a string of ``least`` bytes that covers it also starts somewhere else in the corpus. The suffixes that matter are the
starts of windows of ``least`` bytes, and two of them can only share that many bytes if their windows are equal. So windows
are dealt out by their minimizer, the least hash among the ``gram``-byte strings inside; neighbouring windows
with one minimizer stay together as a stretch of text. Equal windows have equal minimizers: each minimizer's stretches are a suffix sorting problem of
their own, and nothing is lost between them.

1. Only minimizers seen twice go on. If all their stretches are equal, every window repeats, with nothing left to sort.
2. Otherwise one stretch of each content goes on with its text. Suffixes from all window starts are sorted by prefix doubling, common prefixes
   follow from the ranks, and a stack scan of those yields the tree of common-prefix intervals. An interval of ``least`` or more whose
   suffixes differ in the character to the left is a maximal repeat; it is output with all its occurrences.
3. A minimizer with over ``most_stretches`` different stretches (a passage in very many surroundings) is not sorted in one task:
   its windows are bucketed by their whole ``least``-byte prefix instead, a count per prefix, combined before the shuffle.

Spans are judged on the input. Stretches are compared by 64-bit hashes of minimizer and content together.

Defined results: null text counts as empty. A text shorter than ``least`` keeps all its bytes. Rows that repeat, ids that repeat and
null ids are documents of their own, so a repeated row of ``least`` bytes or more goes as a whole, as exact copies do. An empty
table gives no rows. Very long texts are read in overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trolley.llm.common import MIX, mix64, packed, raw, unpacked
from trolley.llm.components import sorted_groups
from trolley.session import stage

BASE = int(MIX[2])
PLACE_BITS = np.uint64(24)
SEGMENT = 1 << 22
SORT_BYTES = 400_000


@dataclass(frozen=True)
class Settings:
    least: int = 200
    gram: int = 32
    most_stretches: int = 2000


class Hashes:
    """Polynomial hashes of all substrings of a text."""

    def __init__(self):
        self.inverse = pow(BASE, -1, 1 << 64)
        self.powers = self.inverses = np.zeros(0, np.uint64)

    def read(self, text: bytes) -> None:
        n = len(text) + 1
        with np.errstate(over="ignore"):
            if len(self.powers) < n:
                size = max(n, 1 << 17)
                ones = np.ones(1, np.uint64)
                self.powers = np.multiply.accumulate(np.concatenate([ones, np.full(size - 1, BASE, np.uint64)]))
                self.inverses = np.multiply.accumulate(np.concatenate([ones, np.full(size - 1, self.inverse, np.uint64)]))
            data = np.frombuffer(text, np.uint8).astype(np.uint64)
            self.total = np.zeros(n, np.uint64)
            np.cumsum((data + np.uint64(1)) * self.powers[: n - 1], out=self.total[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.total[end] - self.total[start]) * self.inverses[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, from running minima within blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def stretches(text: bytes, hashes: Hashes, s: Settings) -> tuple[np.ndarray, ...]:
    """start, windows, minimizer and content hash of the stretches of one segment of a text."""
    n = len(text)
    if n < s.least:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashes.read(text)
    at = np.arange(n - s.gram + 1)
    gram = hashes.between(at, at + s.gram)
    ranked = (gram >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    least = sliding_min(ranked, s.least - s.gram + 1)
    anchor = (least & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    start = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    windows = np.diff(np.concatenate([start, [len(anchor)]]))
    content = hashes.between(start, start + windows + s.least - 1)
    return start, windows, gram[anchor[start]].astype(np.int64), content.astype(np.int64)


def _segments(n: int, s: Settings) -> Iterator[tuple[int, int]]:
    for start in range(0, max(n - s.least + 1, 1), SEGMENT):
        yield start, min(start + SEGMENT + s.least - 1, n)


def all_stretches(rows: DataFrame, s: Settings) -> DataFrame:
    """rid, size, kh (minimizer), sh (content), start, windows for all texts of ``rows`` (rid, size, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            found: list[tuple] = []
            for rid, size, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "size", "text"))):
                for a, b in _segments(len(text), s):
                    start, windows, kh, sh = stretches(text[a:b], hashes, s)
                    if len(start):
                        found.append((np.full(len(start), rid), np.full(len(start), size), kh, sh, start + a, windows))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)],
                                                 ["rid", "size", "kh", "sh", "start", "windows"])

    return rows.mapInArrow(cut, "rid bigint, size bigint, kh bigint, sh bigint, start bigint, windows bigint")


def suffix_order(texts: list[bytes], windows: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Enhanced suffix array over the window starts of ``texts``: text, offset, common prefix with the one before, left character.

    Prefix doubling ranks the suffixes by 1, 2, 4 .. bytes; a different end mark per text stops every comparison there.
    """
    sizes = np.array([len(t) for t in texts])
    base = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for k, t in enumerate(texts):
        symbols[base[k]: base[k] + sizes[k]] = np.frombuffer(t, np.uint8)
        symbols[base[k] + sizes[k]] = 256 + k
    ranks, width = [np.unique(symbols, return_inverse=True)[1]], 1
    while width < sizes.max() + 1:
        r = ranks[-1]
        ahead = np.zeros_like(r)
        ahead[:-width] = r[width:] + 1
        ranks.append(np.unique(r * (r.max() + 2) + ahead, return_inverse=True)[1])
        width *= 2
    text = np.repeat(np.arange(len(texts)), windows)
    offset = np.concatenate([np.arange(w) for w in windows])
    order = np.argsort(ranks[-1][base[text] + offset], kind="stable")
    text, offset = text[order], offset[order]
    place = base[text] + offset
    common = np.zeros(len(place), np.int64)
    p, q = place[:-1].copy(), place[1:].copy()
    for level in reversed(range(len(ranks))):
        inside = np.maximum(p, q) < len(symbols)
        same = inside & (ranks[level][np.minimum(p, len(symbols) - 1)] == ranks[level][np.minimum(q, len(symbols) - 1)])
        step = same.astype(np.int64) << level
        p += step
        q += step
    common[1:] = p - place[:-1]
    left = np.where(offset > 0, symbols[place - 1], -1 - place)
    return text, offset, common, left


def maximal_repeats(texts: list[bytes], windows: list[int], least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, texts and offsets of the occurrences of each maximal repeat, longer ones before those that hold them."""
    text, offset, common, left = suffix_order(texts, windows)
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    # runs of suffixes that share enough; the tree is only walked where some left character differs
    breaks = np.concatenate([np.flatnonzero(common < least), [len(common)]])
    for a, b in zip(breaks[:-1].tolist(), breaks[1:].tolist()):
        if b - a < 2 or changes[b - 1] == changes[a]:
            continue
        stack: list[tuple[int, int]] = []
        for i in range(a + 1, b + 1):
            now = int(common[i]) if i < b else 0
            begin = i - 1
            while stack and stack[-1][0] > now:
                length, begin = stack.pop()
                if changes[i - 1] > changes[begin]:
                    yield length, text[begin:i], offset[begin:i]
            if i < b and (not stack or stack[-1][0] < now):
                stack.append((now, begin))


def _repeat_spans(rows: DataFrame, s: Settings) -> DataFrame:
    """Occurrences of maximal repeats (rid, size, start, length) among the stretches of each minimizer; those of stretches
    with copies are left out, as they are known to repeat."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            rid, size, start, windows, copies, texts = zip(*held)
            out: list[list[int]] = [[], [], [], []]
            done = set()
            for length, which, offset in maximal_repeats(list(texts), list(windows), s.least):
                for k, o in zip(which.tolist(), offset.tolist()):
                    if copies[k] == 1 and (k, o) not in done:
                        done.add((k, o))
                        for column, value in zip(out, (rid[k], size[k], start[k] + o, length)):
                            column.append(value)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["rid", "size", "start", "length"])

        for group in sorted_groups(batches, ["kh"]):
            held += zip(*(group.column(c).to_pylist() for c in ("rid", "size", "start", "windows", "copies", "text")))
            total += group.nbytes
            if total > SORT_BYTES:
                yield flush()
                total = 0
        if held:
            yield flush()

    return (rows.select("kh", "rid", "size", "start", "windows", "copies", "text").repartition("kh").sortWithinPartitions("kh")
            .mapInArrow(scan, "rid bigint, size bigint, start bigint, length bigint"))


def _texts_of(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the text of each stretch; a document travels compressed and meets the list of its stretches."""
    lists = rows.groupBy("rid", "size").agg(F.collect_list(F.struct("kh", "start", "windows", "copies", "stretches", "length")).alias("s"))
    met = docs.dropDuplicates(["rid", "size"]).join(lists, ["rid", "size"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kh", "start", "windows", "copies", "stretches"]
        for batch in batches:
            for k in range(batch.num_rows):
                text = unpacked([batch.column("packed")[k].as_py()])[0]
                rows = batch.column("s")[k].as_py()
                n = len(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("rid")[k].as_py()] * n, pa.int64()), pa.array([batch.column("size")[k].as_py()] * n, pa.int64()),
                    *(pa.array([r[c] for r in rows], pa.int64()) for c in names),
                    pa.array([text[r["start"]: r["start"] + r["length"]] for r in rows], pa.binary())], ["rid", "size", *names, "text"])

    return met.select("rid", "size", "packed", "s").mapInArrow(
        take, "rid bigint, size bigint, kh bigint, start bigint, windows bigint, copies bigint, stretches bigint, text binary")


def _window_spans(rows: DataFrame, s: Settings) -> DataFrame:
    """Windows that repeat among stretches of crowded minimizers, by a count of whole windows."""
    w = (rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("windows").cast("int") - 1)))
         .withColumn("own", F.substring("text", F.col("o") + 1, F.lit(s.least)))
         .select("rid", "size", (F.col("start") + F.col("o")).alias("start"), F.xxhash64("kh", "own").alias("a"),
                 F.xxhash64(F.lit(1), "own").alias("b")))
    twice = w.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return w.join(twice, ["a", "b"], "left_semi").select("rid", "size", "start", F.lit(s.least).cast("bigint").alias("length"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, rid and size (which name a row's id and text) and text."""
    text = raw("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("rid"),
                       F.octet_length(text).cast("bigint").alias("size"), text.alias("text"))


def repeated_spans(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Spans (rid, size, start, length) whose union is what repeats; ``docs`` as from ``keyed``."""
    found = stage(all_stretches(docs.select("rid", "size", "text"), s), "stretches")
    seen = found.groupBy("kh").agg(F.count(F.lit(1)).alias("n"), F.min("sh").alias("lo"), F.max("sh").alias("hi")).where("n > 1")
    # written, so that the join is not tied to the partitions of the count and a hot minimizer's rows can be split
    seen = stage(seen.select("kh", (F.col("lo") != F.col("hi")).alias("mixed")), "shared-minimizers")
    rows = stage(found.join(seen, "kh"), "shared-stretches")
    length = (F.col("windows") + s.least - 1).alias("length")
    alike = rows.where("not mixed").select("rid", "size", "start", length)
    mixed = rows.where("mixed")
    contents = stage(mixed.groupBy("kh", "sh").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "size", "start", "windows")).alias("one")), "stretch-contents")
    copied = contents.where("copies > 1").select("kh", "sh")
    copies = mixed.join(copied, ["kh", "sh"], "left_semi").select("rid", "size", "start", length)
    crowds = contents.groupBy("kh").agg(F.count(F.lit(1)).alias("stretches"))
    ones = contents.join(crowds, "kh").select("kh", "copies", "stretches", "one.*").withColumn("length", length)
    texts = stage(_texts_of(ones, packed(docs, F.col("rid"), F.col("size"), text=F.col("text"))), "stretch-texts")
    sorted_ = _repeat_spans(texts.where(F.col("stretches") <= s.most_stretches), s)
    crowded = _window_spans(texts.where(F.col("stretches") > s.most_stretches), s)
    return alike.union(copies).union(sorted_).union(crowded)


def without_repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (maximal removed runs: start, length) and kept, the remaining bytes."""
    named = keyed(docs)
    spans = repeated_spans(named, s).groupBy("rid", "size").agg(F.collect_set(F.struct("start", "length")).alias("found"))
    rows = packed(named, F.col("doc_id"), F.col("rid"), F.col("size"), text=F.col("text")).join(spans, ["rid", "size"], "left")
    return _cut(rows.select("doc_id", F.col("size").alias("n_bytes"), "found", "packed"))


def remove_repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with their own columns, ``text`` without what repeats and ``n_chars``, where there is one, to match.

    A character that a span covers in part stays whole. A null text stays null; a document that loses all text stays, empty.
    """
    key = keyed(docs)
    spans = repeated_spans(key, s).groupBy("rid", "size").agg(F.collect_set(F.struct("start", "length")).alias("found"))
    text = raw("text")
    rows = packed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"), F.col("text").isNull().alias("none"),
                  F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("rid"), F.octet_length(text).cast("bigint").alias("size"))
    rows = rows.join(spans, ["rid", "size"], "left").select("row", "none", "found", "packed")
    new = F.when(~F.col("none"), F.decode("kept", "UTF-8"))
    columns = {"text": new, "n_chars": F.coalesce(F.length(new), F.lit(0)).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return _cut(rows, True).select(*(columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def _cut(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Merges the ``found`` spans of each row, takes them out of the packed text and passes the other columns on.

    ``whole`` draws spans in to whole characters.
    """
    others = [c for c in rows.columns if c not in ("found", "packed")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for found, text in zip(batch.column("found").to_pylist(), unpacked(batch.column("packed").to_pylist())):
                merged: list[dict] = []
                for x in sorted(found or [], key=lambda x: x["start"]):
                    end = x["start"] + x["length"]
                    if merged and x["start"] <= merged[-1]["start"] + merged[-1]["length"]:
                        merged[-1]["length"] = max(merged[-1]["length"], end - merged[-1]["start"])
                    else:
                        merged.append({"start": x["start"], "length": x["length"]})
                if whole:
                    merged = [y for y in (_inside(text, x) for x in merged) if y["length"] > 0]
                parts, at = [], 0
                for x in merged:
                    parts.append(text[at: x["start"]])
                    at = x["start"] + x["length"]
                parts.append(text[at:])
                spans.append(merged)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(spans, span), pa.array(kept, pa.binary())],
                                             [*others, "spans", "kept"])

    added = StructType.fromDDL("spans array<struct<start: bigint, length: bigint>>, kept binary")
    return rows.mapInArrow(cut, StructType([rows.schema[c] for c in others] + added.fields))


def _inside(text: bytes, span: dict) -> dict:
    start, end = span["start"], span["start"] + span["length"]
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return {"start": start, "length": end - start}
