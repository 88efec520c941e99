"""Best-fit packing of token pieces into sequences of fixed capacity, by large-item matching.

Pieces above a third of the capacity share a sequence with at most one other such piece: the longest unmatched one takes the
longest partner that still fits, which pairs as many as can be paired. Smaller pieces then fill the gaps from the longest
piece on, each into the tightest gap it fits, and open new sequences only where no gap is left.

Pieces of equal length are interchangeable, so the packing is a function of the histogram of lengths: at most ``capacity`` counts
reach the driver, whatever the corpus. It answers with segments "the pieces at places first.. of the global
order by length go into sequences from .. on, so many per sequence, from this offset on". A gap that takes pieces of one length
shrinks to less than half, so a group of like sequences gets at most log2(capacity) segments, and the
number of segments is bounded by the capacity alone. Every task looks its pieces up in that table.

Defined results: a null or empty text is the closing id alone. Texts are tokenized whole; only documents longer than the capacity are
cut, into full pieces and a rest. Repeated rows and null ids are packed like any other row. An empty table gives no rows.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import crc32_number, numbered, raw
from trolley.session import stage

END_ID = 1
#: Bytes of a cache of words, and what an entry takes besides its text and ids.
CACHE_BYTES, ENTRY_BYTES = 160 << 20, 200
FLUSH_BYTES = 16 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


#: Strings that may hold a special token; such words go through the whole tokenizer.
SPECIAL = b"<|"


class WordTokenizer:
    """Little-endian 32-bit ids of whole texts, for a tokenizer that drops white space and never looks across it.

    A text is cut at ASCII white space only, all of which the tokenizer drops; every distinct word is encoded
    once while it stays in a cache of bounded bytes. ASCII words are lower-cased and cut by the tokenizer's own pattern here and
    only merged by its model; all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        with open(path) as file:
            steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
        pattern = next(x["pattern"]["Regex"] for x in steps if x["type"] == "Split")
        self.parts = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.cache: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def forget(self) -> None:
        """Drop all but the third of the words that came first: frequent words come early."""
        self.cache = dict(islice(self.cache.items(), len(self.cache) // 3))
        self.pieces = dict(islice(self.pieces.items(), len(self.pieces) // 3))
        self.held = sum(len(k) + len(v) + ENTRY_BYTES for x in (self.cache, self.pieces) for k, v in x.items())

    def _merged(self, part: str) -> bytes:
        ids = array.array("I", [t.id for t in self.merge(part)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _ascii(self, word: str) -> bytes:
        word = word.lower()
        if word.isalpha():
            return self._merged(word)
        found = []
        for part in self.parts(word):
            ids = self.pieces.get(part)
            if ids is None:
                ids = self.pieces[part] = self._merged(part)
                self.held += len(part) + len(ids) + ENTRY_BYTES
            found.append(ids)
        return found[0] if len(found) == 1 else b"".join(found)

    def _learn(self, words: list[bytes]) -> None:
        others = []
        for w in words:
            if w.isascii() and SPECIAL not in w and b"\x7f" not in w and min(w) > 32:
                self.cache[w] = self._ascii(w.decode())
            else:
                others.append(w)
        for w, e in zip(others, self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)):
            self.cache[w] = np.array(e.ids, "<u4").tobytes()
        self.held += sum(len(w) + len(self.cache[w]) + ENTRY_BYTES for w in words)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        if self.held > CACHE_BYTES:
            self.forget()
        new = list(set().union(*split).difference(self.cache))
        if new:
            self._learn(new)
        cache = self.cache
        return [b"".join([cache[w] for w in words]) for words in split]


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its bounded cache outlives a task."""
    return WordTokenizer(path)


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the ids as little-endian unsigned 32-bit numbers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 5
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids"])
            rows.clear()
            return out

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(names), 256):
                for name, ids in zip(names[at: at + 256], tokenizer.encode(texts.slice(at, 256).to_pylist())):
                    ids += end
                    for k in range(0, len(ids), step):
                        part = ids[k: k + step]
                        rows.append((name, k // step, k // 4, len(part) // 4, part))
                        held += len(part)
                if held > FLUSH_BYTES:
                    yield flush()
                    held = 0
        yield flush()
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw("text").alias("text")).mapInArrow(pieces, PIECES)


@dataclass(frozen=True)
class Packing:
    """Segments by ``first`` place: pieces from there on go ``each`` per sequence from ``sequence`` on, behind ``offset``."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(counts: dict[int, int], capacity: int) -> Packing:
    """Packing of ``counts[length]`` pieces per length, placed in the order of descending length."""
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    place, total = {}, 0
    for n in sorted(counts, reverse=True):
        place[n] = total
        total += counts[n]
    left = dict(counts)
    segments: list[tuple[int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    used = 0

    def put(n: int, pieces: int, sequence: int, each: int, offset: int) -> None:
        segments.append((place[n], sequence, each, offset))
        place[n] += pieces
        left[n] -= pieces

    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((p for p in large if left[p] and p <= capacity - n and (p < n or left[n] > 1)), None)
            if partner is None:
                rows = left[n]
                put(n, rows, used, 1, 0)
                gaps[capacity - n].append((used, rows))
            elif partner == n:
                rows = left[n] // 2
                put(n, 2 * rows, used, 2, 0)
                gaps[capacity - 2 * n].append((used, rows))
            else:
                rows = min(left[n], left[partner])
                put(n, rows, used, 1, 0)
                put(partner, rows, used, 1, n)
                gaps[capacity - n - partner].append((used, rows))
            used += rows
    for n in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        gap = n
        while left[n]:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:
                gap = capacity
                rows = -(-left[n] // (capacity // n))
                gaps[gap].append((used, rows))
                used += rows
            sequence, rows = gaps[gap].pop()
            each = gap // n
            full = min(rows, left[n] // each)
            if full:
                put(n, full * each, sequence, each, capacity - gap)
                gaps[gap - each * n].append((sequence, full))
            if full < rows:
                some = left[n]
                if some:
                    put(n, some, sequence + full, some, capacity - gap)
                    gaps[gap - some * n].append((sequence + full, 1))
                    full += 1
                if full < rows:
                    gaps[gap].append((sequence + full, rows - full))
    segments.sort()
    first, sequence, each, offset = (np.array(c, np.int64) for c in (list(zip(*segments)) or [()] * 4))
    return Packing(first, sequence, each, offset, used)


def assign(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length``; ``order`` ends ties of length, so that hot lengths spread."""
    placed = numbered(pieces, [F.desc("length"), *order], "packing")
    packing = plan({int(r["length"]): r["count"] for r in placed.groupBy("length").count().collect()}, capacity)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for at, length in parts:
            at, length = at.to_numpy(), length.to_numpy()
            k = np.searchsorted(packing.first, at, "right") - 1
            turn = at - packing.first[k]
            yield pd.DataFrame({"sequence_id": packing.sequence[k] + turn // packing.each[k],
                                "offset": packing.offset[k] + turn % packing.each[k] * length})

    return placed.withColumn("__put", look_up("at", "length")).select(
        *pieces.columns, F.col("__put.sequence_id").alias("sequence_id"), F.col("__put.offset").alias("offset"))


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "piece", "start", "length", crc32_number(F.col("ids")).alias("ids_crc32"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = END_ID) -> DataFrame:
    """Place of every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # written before the sort, which reads its input twice to find its bounds
    pieces = stage(digest(tokenized(docs, tokenizer_path, capacity, end_id)), "pieces")
    return assign(pieces, capacity, ["doc_id", "piece", "ids_crc32"])


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids. ``doc_id`` must tell the documents apart."""
    rows = pieces.join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    # a sequence is bounded by its capacity
    parts = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("p"))
    return parts.select("sequence_id", F.unhex(F.array_join("p.ids", "")).alias("ids"))
