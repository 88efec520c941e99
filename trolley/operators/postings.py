"""TF-IDF postings of a large corpus without moving a posting.

Documents are dealt to parts of bounded text, a task each. A part counts in how many of its documents each term occurs; these counts are added up by
term, and the terms that occur in several documents travel back to the parts they came from. The documents are then read once more and weighted where
they are. What is shuffled is the text, twice, and the distinct terms of each part, in order and packed by hash, but never a row per document and term.

Defined results: as ``documents.tfidf_weights`` over ``documents.term_counts``; rows that share an id are one document, rows without text have no terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.documents import terms
from trolley.operators.vectors import NO_ID

#: Characters of a part, rows of a batch of results, terms whose letters are hashed at once.
CHARACTERS, BATCH, HASHED = 16_000_000, 100_000, 50_000


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Ids of the documents; document, code and frequency of each posting, by document; the terms by code."""
    names, row = np.unique(np.array(pc.fill_null(batch.column("doc"), int(NO_ID))), return_inverse=True)
    column = batch.column("terms")
    coded = column.flatten().dictionary_encode()
    many = max(1, len(coded.dictionary))
    key, tf = np.unique(np.repeat(row, np.diff(np.array(column.offsets))) * many + np.array(coded.indices, np.int64), return_counts=True)
    return names, key // many, key % many, tf, coded.dictionary


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (part, doc, ...), in this order, cut so that none has two parts and no document is in two of them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, doc = np.array(batch.column("part")), np.array(pc.fill_null(batch.column("doc"), int(NO_ID)))
        before = last or (part[0], doc[0])
        new_part = np.r_[before[0], part[:-1]] != part
        new = np.flatnonzero(new_part | (np.r_[before[1], doc[:-1]] != doc))
        last = part[-1], doc[-1]
        if not len(new):
            held.append(batch)
            continue
        # up to the last document, which may go on in the next batch
        cut, at = int(new[-1]), 0
        for end in sorted({*np.flatnonzero(new_part).tolist(), cut}):
            held.append(batch.slice(at, end - at))
            yield from _joined(held)
            held, at = [], end
        held.append(batch.slice(cut))
    yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    some = [b for b in held if b.num_rows]
    if some:
        yield some[0] if len(some) == 1 else pa.Table.from_batches(some).combine_chunks().to_batches()[0]


def _packed(names: pa.Array, n: np.ndarray) -> tuple[bytes, bytes]:
    """Terms, best in order, and their counts; terms have no line breaks."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), "\n")[0].as_py().encode()
    return _zip(joined), _zip(n.astype(np.int64).tobytes())


def _zip(plain: bytes) -> bytes:
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(plain, asbytes=True)


def _unzip(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def _unpacked(names: bytes, n: bytes) -> tuple[pa.Array, np.ndarray]:
    return pc.split_pattern(pa.array([_unzip(names).decode()]), "\n").flatten(), np.frombuffer(_unzip(n), np.int64)


_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _bucket(names: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each term, the same wherever it is computed."""
    return np.concatenate([np.zeros(0, np.int64), *(_bucket_of(names[t: t + HASHED], buckets) for t in range(0, len(names), HASHED))])


def _bucket_of(names: pa.Array, buckets: int) -> np.ndarray:
    raw = names.cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64)[raw.offset: raw.offset + len(raw) + 1]
    letters = np.frombuffer(data, np.uint8)[at[0]: at[-1]]
    size = np.diff(at)
    place = np.arange(len(letters)) - np.repeat(at[:-1] - at[0], size)
    total = np.r_[np.uint64(0), np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * _FACTORS[place & 255], dtype=np.uint64)]
    mixed = (total[at[1:] - at[0]] - total[at[:-1] - at[0]]) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _counted(buckets: int):
    """(bucket, part, names, n): terms of the part and how many of its documents have them, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found, counts = None, [], []

        def end() -> Iterator[pa.RecordBatch]:
            if not found:
                return
            coded = pa.chunked_array(found).combine_chunks().dictionary_encode()
            n = np.bincount(np.array(coded.indices), np.concatenate(counts), len(coded.dictionary)).astype(np.int64)
            # neighbours in order share their beginnings
            order = pc.sort_indices(coded.dictionary)
            names, n = coded.dictionary.take(order), n[np.array(order)]
            own = _bucket(names, buckets)
            order = np.argsort(own, kind="stable")
            names, n, own = names.take(pa.array(order)), n[order], own[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else []
            for a, b in zip(first, [*first[1:], len(own)]):
                packed = _packed(names[a:b], n[a:b])
                yield pa.RecordBatch.from_arrays([pa.array([int(own[a])], pa.int32()), pa.array([part], pa.int32()), *(pa.array([x]) for x in packed)],
                                                 ["bucket", "part", "names", "n"])

        for batch in _whole(batches):
            own = batch.column("part")[0].as_py()
            if own != part:
                yield from end()
                part, found, counts = own, [], []
            _, _, code, _, names = _postings(batch)
            found.append(names)
            counts.append(np.bincount(code, minlength=len(names)))
        yield from end()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, bucket, names, n): of each packet the terms that several documents of the corpus have, with the number of all that have them."""
    bucket, rows = None, []

    def end() -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        coded = pa.chunked_array([names for _, names, _ in rows]).combine_chunks().dictionary_encode()
        code = np.array(coded.indices)
        df = np.bincount(code, np.concatenate([n for *_, n in rows])).astype(np.int64)[code]
        at = 0
        for part, names, _ in rows:
            own = df[at: at + len(names)]
            at += len(names)
            some = own > 1
            if some.any():
                packed = _packed(names.filter(pa.array(some)), own[some])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bucket], pa.int64()), *(pa.array([x]) for x in packed)],
                                                 ["part", "bucket", "names", "n"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                yield from end()
                bucket, rows = row["bucket"], []
            rows.append((row["part"], *_unpacked(row["names"], row["n"])))
    yield from end()


def _weighted(n_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, counts, known, df = None, [], [], None, None
        for batch in _whole(batches):
            own = batch.column("part")[0].as_py()
            if own != part:
                part, names, counts, known = own, [], [], None
            listed = np.array(batch.column("n").is_valid())
            if listed.any():
                # the terms of a part come first
                for row in batch.select(["names", "n"]).filter(pa.array(listed)).to_pylist():
                    told = _unpacked(row["names"], row["n"])
                    names.append(told[0])
                    counts.append(told[1])
                batch = batch.filter(pa.array(~listed))
                if not batch.num_rows:
                    continue
            if known is None:
                known = pa.chunked_array(names, pa.string()).combine_chunks()
                df = np.concatenate([*counts, [1]])
            ids, doc, code, tf, terms_ = _postings(batch)
            if not len(doc):
                continue
            place = pc.fill_null(pc.index_in(terms_, value_set=known), len(known))
            idf = np.log((1.0 + n_docs) / (1.0 + df[np.array(place)])) + 1.0
            w = (1.0 + np.log(tf)) * idf[code]
            weight = w / np.sqrt(np.bincount(doc, w * w, len(ids)))[doc]
            for t in range(0, len(doc), BATCH):
                cut = slice(t, t + BATCH)
                own_ids = ids[doc[cut]]
                yield pa.RecordBatch.from_arrays([pa.array(own_ids, mask=own_ids == NO_ID), terms_.take(pa.array(code[cut])), pa.array(weight[cut])],
                                                 ["doc", "term", "weight"])

    return run


def tfidf_postings(docs: DataFrame, doc_id: str, text: str, characters: int = CHARACTERS) -> DataFrame:
    """L2-normalised TF-IDF postings (doc_id, term, weight) of (doc_id, text) rows with whole numbers as ids."""
    size = docs.agg(F.count(F.lit(1)), F.sum(F.length(text))).first()
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil((size[1] or 0) / characters))
    part = F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(parts)).cast("int")
    tokens, bigrams = terms(F.col("text"))
    rows = docs.select(part.alias("part"), F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))

    def taken_apart(df: DataFrame, *more: str) -> DataFrame:
        named = df.select("part", "doc", *more, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
        return named.select("part", "doc", *more, F.concat("tokens", bigrams).alias("terms"))

    buckets = max(parts, math.ceil((size[1] or 0) / characters))
    counted = taken_apart(rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc")).mapInArrow(
        _counted(buckets), "bucket int, part int, names binary, n binary")
    # what a part is not told occurs in one document
    shared = counted.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(
        _shared, "part int, bucket bigint, names binary, n binary")
    no_list = [F.lit(None).cast("binary").alias(c) for c in ("names", "n")]
    both = shared.select("part", F.lit(0).alias("kind"), F.col("bucket").alias("doc"), F.lit(None).cast("string").alias("text"), "names", "n").unionByName(
        rows.select("part", F.lit(1).alias("kind"), "doc", "text", *no_list))
    dealt = both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind", "doc")
    found = taken_apart(dealt, "names", "n").mapInArrow(_weighted(size[0]), "doc bigint, term string, weight double")
    return found.select(F.col("doc").cast(dict(docs.dtypes)[doc_id]).alias(doc_id), "term", "weight")
