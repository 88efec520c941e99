"""Byte-level BPE as folds over distinct words.

Texts are cut by the tokenizer's pattern. A task deals its texts to bundles; each of its distinct words travels once, in the bundle that meets it first,
and every text is places in the list of the task's words so far. That list starts anew after ``HELD_DISTINCT`` words, so it is bounded whatever
the size of a partition. Spark's higher-order functions then fold the ranked merges over the bytes of the words: the state is one array of
longs, per token the rank of its pair with the next one, its place and its id, so the smallest element is the leftmost pair of the lowest rank.
A step joins that pair and looks up the two ranks that change. The ranks of pairs of ids are a literal in the plan, dealt out without collisions, so a
lookup reads two array elements. Decoding concatenates the bytes of the ids' pieces from a literal array. At last every text puts the results of
its words together, in the same task. There is no shuffle.

Bytes travel as strings of the characters 0 to 255 (ISO-8859-1), which is what JSON literals and string functions can hold.

Defined results: a null or empty text has no tokens. Special tokens are ordinary text. Repeated rows and null ids get their own row
each. An empty table gives no rows. Texts are encoded whole. Ranks that lack a byte are refused.
"""

from __future__ import annotations

import base64
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trolley.llm.common import raw

#: Maps that hold the pieces; a lookup in a Spark map reads it from the start.
BUCKETS = 16384
#: No such piece; larger than every rank.
NONE = 2**31 - 1
#: A bundle ends with so many new words, or so many words in all.
BUNDLE_DISTINCT = 20_000
BUNDLE_WORDS = 500_000
#: A task's list of words starts anew when it is longer.
HELD_DISTINCT = 500_000
LATIN = "iso-8859-1"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _literal(values, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


def deal_out(keys: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Places without collisions for different keys: (q, b, shift, place), where ``place`` is ``key % q + shift[key % b]``."""
    q, b = max(len(keys), 1) | 1, max(len(keys) // 3, 1) | 1
    rng = np.random.default_rng(5)
    while True:
        shift, taken, place = np.zeros(b, np.int64), np.zeros(2 * q, bool), np.zeros(len(keys), np.int64)
        order = np.argsort(keys % b, kind="stable")
        own, starts, sizes = np.unique(keys[order] % b, return_index=True, return_counts=True)
        for k in np.argsort(-sizes, kind="stable").tolist():
            members = order[starts[k]: starts[k] + sizes[k]]
            at = keys[members] % q
            if len(members) > 1 and len(np.unique(at)) < len(at):
                break
            for tried in range(1000):
                new = at + int(rng.integers(q))
                if not taken[new].any():
                    break
            else:
                break
            taken[new] = True
            place[members] = new
            shift[own[k]] = new[0] - at[0]
        else:
            return q, b, shift, place
        q, b = q + q // 8 + 2 | 1, b + 2


class RankMap:
    """The literals: pieces to ranks by bucket, pairs of ids to ranks, pairs of bytes to elements of the state, and ids to pieces."""

    def __init__(self, spark, ranks: dict[bytes, int]):
        alone = [ranks.get(bytes([k])) for k in range(256)]
        if None in alone:
            raise ValueError(f"the ranks lack byte {alone.index(None)}")
        last = max(ranks.values())
        #: Bits of an id; one id more stands for both ends of a word, the highest number for no rank.
        self.bits = (last + 2).bit_length()
        self.end, self.none = last + 1, (1 << self.bits) - 1
        #: Left of rank and place in an element.
        self.high = 63 - self.bits
        if self.high - self.bits < 24:
            raise ValueError("ids of over 19 bits leave no room for the place in a word")
        pieces = [p.decode(LATIN) for p in ranks]
        names = spark.createDataFrame([(p,) for p in pieces], StructType([StructField("p", StringType())]))
        places = [r[0] for r in names.coalesce(1).select(self._bucket(F.col("p"))).collect()]
        buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        by_id = [""] * (last + 1)
        for p, at, rank in zip(pieces, places, ranks.values()):
            buckets[at - 1][p] = rank
            by_id[rank] = p
        self._ranks = _literal(buckets, "array<map<string,int>>")
        self._pieces = _literal(by_id, "array<string>")
        pairs = [(ranks[p[:k]], ranks[p[k:]], rank) for p, rank in ranks.items()
                 for k in range(1, len(p)) if p[:k] in ranks and p[k:] in ranks]
        left, right, joined = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left << self.bits | right
        self._q, self._b, shift, place = deal_out(keys)
        # what no key has: the end of a word is left of nothing
        table = np.full(2 * self._q, (self.end << self.bits | self.end) << self.bits, np.int64)
        table[place] = keys << self.bits | joined
        self._shift, self._table = _literal(shift.tolist(), "array<bigint>"), _literal(table.tolist(), "array<bigint>")
        by_pair = {(a, b): m for a, b, m in pairs}
        self._starts = _literal(
            [by_pair.get((a, b), self.none) << self.high | a for a in alone for b in [*alone, self.end]], "array<bigint>")

    @staticmethod
    def _bucket(piece: Column) -> Column:
        return F.hash(piece).bitwiseAND(F.lit(BUCKETS - 1)) + 1

    def rank(self, piece: Column) -> Column:
        return F.coalesce(F.try_element_at(F.element_at(self._ranks, self._bucket(piece)), piece), F.lit(NONE))

    def pair(self, left: Column, right: Column) -> Column:
        """Key of two ids."""
        return F.shiftleft(left, self.bits).bitwiseOR(right)

    def pair_rank(self, key: Column) -> Column:
        """Rank of the piece that the pair makes, ``none`` if it makes none."""
        at = key % F.lit(self._q) + F.get(self._shift, (key % F.lit(self._b)).cast("int"))
        # equal keys cancel out; what is left of others is larger than every rank
        return F.least(F.get(self._table, at.cast("int")).bitwiseXOR(F.shiftleft(key, self.bits)), F.lit(self.none).cast("bigint"))

    def start(self, pair: Column) -> Column:
        """Element of a byte and the next one, given as ``257 * byte + next`` (256 at the end), at place 0."""
        return F.get(self._starts, pair)

    def piece(self, number: Column) -> Column:
        return F.element_at(self._pieces, number + 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_merges(pairs: Column, ranks: RankMap) -> Column:
    """Ids (array<int>) of a word that is no piece itself, given as its pairs of bytes (see ``RankMap.start``)."""
    def long(x: int) -> Column:
        return F.lit(x).cast("bigint")

    token, place = long(ranks.none), long((1 << ranks.high) - 1 - ranks.none)
    edge = F.array(long(ranks.none << ranks.high | ranks.end))
    start = F.concat(edge, F.transform(pairs, lambda x, k: ranks.start(x).bitwiseOR(F.shiftleft(k.cast("bigint"), ranks.bits))), edge)

    def join(s: Column, i: Column) -> Column:
        first, before = F.get(s, i - 1), F.get(s, i - 2)
        joined = F.shiftright(first, ranks.high)
        keys = F.array(ranks.pair(before.bitwiseAND(token), joined), ranks.pair(joined, F.get(s, i + 1).bitwiseAND(token)))
        lows = F.array(before.bitwiseAND(long((1 << ranks.high) - 1)), first.bitwiseAND(place).bitwiseOR(joined))
        both = F.zip_with(keys, lows, lambda key, low: F.shiftleft(ranks.pair_rank(key), ranks.high).bitwiseOR(low))
        return F.concat(F.slice(s, F.lit(1), i - 2), both, F.slice(s, i + 2, F.size(s)))

    def step(s: Column, _: Column) -> Column:
        lowest = F.array_position(s, F.array_min(s)).cast("int")
        return _let(lowest, lambda i: F.when(F.get(s, i - 1) < long(ranks.none << ranks.high), join(s, i)).otherwise(s))

    merged = F.aggregate(pairs, start, step)
    return F.transform(F.filter(merged, lambda e: e.bitwiseAND(token) != long(ranks.end)), lambda e: e.bitwiseAND(token).cast("int"))


def encode_word(word: Column, pairs: Column, ranks: RankMap) -> Column:
    """Ids of a word given as ISO-8859-1 string of its bytes and as its pairs of bytes, as array<int>."""
    return _let(ranks.rank(word), lambda r: F.when(r != NONE, F.array(r)).otherwise(fold_merges(pairs, ranks)))


def decode_ids(ids: Column, ranks: RankMap) -> Column:
    """Bytes of ids, as ISO-8859-1 string."""
    return F.array_join(F.transform(ids, ranks.piece), "")


def _one_by_one(values: pa.Array) -> Iterator[bytes]:
    for k in range(0, len(values), 128):
        yield from values.slice(k, 128).to_pylist()


def byte_pairs(words: list[bytes]) -> pa.Array:
    """Per word, each byte with the next one as ``257 * byte + next``; 256 is the end."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    after = np.empty_like(flat)
    after[:-1] = flat[1:]
    after[ends - 1] = 256
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat * 257 + after))


def bundles(docs: DataFrame, pattern: str) -> DataFrame:
    """Texts as places in the list of distinct words of their task: doc_ids, places (little-endian 32-bit), and what the list grows by, words and
    their byte pairs, from place ``first`` on; 0 starts a new list."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern).findall
        at: dict[str, int] = {}
        new: list[bytes] = []
        names: list = []
        places: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([len(at) - len(new)], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.binary())),
                 pa.array([[w.decode(LATIN) for w in new]], pa.list_(pa.string())),
                 pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), byte_pairs(new))],
                ["first", "doc_ids", "places", "words", "pairs"])
            new.clear(), names.clear(), places.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), _one_by_one(batch.column("text"))):
                before = len(at)
                found = [at.setdefault(w, len(at)) for w in cut(text.decode())]
                if len(at) > before:
                    new.extend(w.encode() for w in list(itertools.islice(reversed(at), len(at) - before))[::-1])
                names.append(name)
                places.append(np.array(found, "<u4").tobytes())
                held += len(found)
                if len(new) > BUNDLE_DISTINCT or held > BUNDLE_WORDS:
                    yield flush()
                    held = 0
                    if len(at) > HELD_DISTINCT:
                        at.clear()
        if names:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw("text").alias("text")).mapInArrow(
        pack, "first bigint, doc_ids array<bigint>, places array<binary>, words array<string>, pairs array<array<int>>")


def _applied(rows: DataFrame) -> DataFrame:
    """Results of whole texts from those of their task's words."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[str] = []
        pieces: list[bytes] = []
        for batch in batches:
            for k in range(batch.num_rows):
                first = batch.column("first")[k].as_py()
                if first == 0:
                    ids.clear(), pieces.clear()
                if first != len(ids):
                    raise RuntimeError("the bundles of a task came in another order")
                new, names, places = (batch.column(c)[k].as_py() for c in ("ids", "doc_ids", "places"))
                ids.extend(new)
                pieces.extend(s.encode(LATIN) for s in batch.column("decoded")[k].as_py())
                for i in range(0, len(names), 512):
                    some = [np.frombuffer(p, "<u4").tolist() for p in places[i: i + 512]]
                    joined = [",".join([ids[j] for j in p]) for p in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[i: i + 512], pa.int64()), pa.array([s.count(",") + 1 if s else 0 for s in joined], pa.int64()),
                        pa.array(joined, pa.string()), pa.array([b"".join([pieces[j] for j in p]) for p in some], pa.binary())],
                        ["doc_id", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(put, "doc_id bigint, n_tokens bigint, ids string, decoded binary")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (decimal, joined by commas) and decoded, the bytes of those ids."""
    table = RankMap(docs.sparkSession, ranks)
    rows = bundles(docs, pattern).withColumn("found", F.zip_with("words", "pairs", lambda w, p: encode_word(w, p, table)))
    return _applied(rows.select(
        "first", "doc_ids", "places", F.transform("found", lambda x: F.array_join(x.cast("array<string>"), ",")).alias("ids"),
        F.transform("found", lambda x: decode_ids(x, table)).alias("decoded")))
