"""Alignment of two tokenizers' tokens, each different text once.

Texts are shuffled whole, so that equal ones meet; every different text is tokenized and aligned once, and its pairs count as often as the text
occurs. Documents get the results of their text by its SHA-256.

Both tokenizers end a token before every single space between two signs that are no space (the piece vocabulary holds no piece with a space
behind another sign, the byte pattern starts anew there). So a text falls into chunks, each a space and what follows, that are
tokenized and aligned alone; a different chunk is done once per bundle, a bounded number of texts. A bundle keeps
its texts as places in its list of chunks and its chunks as links in its list of token pairs. Corpus-wide counts of pairs, and the highest
per A id, go back to the bundles' pairs by joins; nothing that grows with the vocabulary or the corpus is broadcast or collected.

Links are the pairs of token occurrences whose byte ranges overlap. Byte offsets where tokens of both end cut the tokens into
groups. A text has no tokens if the bytes of its tokens, joined, differ from a space and the text, in either tokenizer.

Defined results: a null or empty text has no tokens. Every row counts as a document, repeated ones and those without id too. Special
tokens in texts are plain text. Texts are taken whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.session import stage


@dataclass(frozen=True)
class Settings:
    #: Texts of a bundle, its chunks, different ones, and their bytes.
    bundle_texts: int = 50_000
    bundle_chunks: int = 1_000_000
    bundle_distinct: int = 200_000
    bundle_bytes: int = 8 << 20


#: A single space between two signs that are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: The sign that stands for a space in pieces.
SPACE_SIGN = "▁"


def byte_signs() -> dict[str, int]:
    """The signs that byte-level vocabularies write for the 256 bytes: printable ones stand for themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Places(dict):
    """Places of chunks in the order in which they come, and their size in characters."""

    size = 0

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        self.size += len(chunk)
        return place


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        signs = byte_signs()
        with open(byte_path) as file:
            entries = json.load(file)["model"]["vocab"]
        self.a_bytes = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, number in entries.items():
            self.a_bytes[number] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE_SIGN, " ").encode() for k, p in enumerate(pieces)]
        #: Whether no piece runs on over a space, so that chunks can be tokenized alone.
        self.apart = not any(re.search(f"[^{SPACE_SIGN}]{SPACE_SIGN}", p) for p in pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        #: How a token is written: an A id before another one or at the end of its group, a B id also at the end of its chunk.
        self.written = [b"%d%s" % (k, sign) for n, signs in ((len(self.a_bytes), (b",", b"|")), (len(self.b_bytes), (b",", b";", b"\n")))
                        for k in range(n) for sign in signs]

    def chunks(self, text: str) -> list[str]:
        return CUT.split(text) if self.apart else [text]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return ([e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)],
                self.b.encode(chunks, num_threads=1))

    def sound(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether the tokens' bytes are those of the space and the chunk, on both sides."""
        want = [b" " + c.encode() for c in chunks]
        size = np.fromiter(map(len, want), np.int64, len(want))
        good = np.ones(len(want), bool)
        for ids, own, sizes in ((a, self.a_bytes, self.a_size), (b, self.b_bytes, self.b_size)):
            flat = list(chain.from_iterable(ids))
            ends = np.r_[0, np.cumsum(sizes[np.array(flat, np.int64)])][np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]
            # one comparison for all; one by one only where it fails
            if np.array_equal(ends, np.cumsum(size)) and b"".join(map(own.__getitem__, flat)) == b"".join(want):
                continue
            good &= np.fromiter((b"".join(map(own.__getitem__, x)) == w for x, w in zip(ids, want)), bool, len(want))
        return good

    def tokens(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B chunk by chunk, their numbers per chunk, and which chunks are sound; the others get none. Few lists at a time."""
        parts = []
        for k in range(0, len(chunks), 4096):
            some = chunks[k: k + 4096]
            a, b = self.encode(some)
            good = self.sound(some, a, b)
            for x in np.flatnonzero(~good):
                a[x], b[x] = [], []
            parts.append([*(np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b)),
                          *(np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b)), good])
        ids_a, ids_b, n_a, n_b, good = (np.concatenate(x) for x in zip(*parts))
        return ids_a, ids_b, n_a, n_b, good


@dataclass
class Aligned:
    """Per chunk: tokens, groups and links, and the groups' text; links as (A id, B id), chunk by chunk."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    text: list[bytes]
    link_a: np.ndarray
    link_b: np.ndarray


def align(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, t: Tokenizers) -> Aligned:
    """Alignment of chunks whose tokens have the same bytes on both sides; chunks without tokens have nothing."""
    # both sides are the same stream of bytes, in which every chunk ends on both sides
    end_a, end_b = np.cumsum(t.a_size[ids_a]), np.cumsum(t.b_size[ids_b])
    start_a = end_a - t.a_size[ids_a]
    first, last = np.searchsorted(end_b, start_a, "right"), np.searchsorted(end_b, end_a, "left")
    many = last - first + 1
    link_a = np.repeat(ids_a, many)
    link_b = ids_b[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
    whose = np.repeat(np.arange(len(n_a)), n_a)
    n_links = np.bincount(whose, many, len(n_a)).astype(np.int64)
    both = np.append(end_b, -1)[last] == end_a
    n_groups = np.bincount(whose[both], minlength=len(n_a)).astype(np.int64)
    # groups in their order, A before B, every token as its text and the sign behind it
    cuts = end_a[both]
    group_a, group_b = np.searchsorted(cuts, end_a, "left"), np.searchsorted(cuts, end_b, "left")
    chunk_ends = np.zeros(len(ids_b) + 1, bool)
    chunk_ends[np.cumsum(n_b)[n_b > 0] - 1] = True
    closes_b = (cuts[group_b] == end_b).astype(np.int64) + chunk_ends[:-1]
    codes = np.r_[2 * ids_a + both, 2 * len(t.a_bytes) + 3 * ids_b + closes_b]
    order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
    codes = codes[order]
    parts = [b"".join(map(t.written.__getitem__, codes[k: k + 65_536].tolist())) for k in range(0, len(codes), 65_536)]
    lines = iter(b"".join(parts).split(b"\n"))
    text = [next(lines) if n else b"" for n in n_a.tolist()]
    return Aligned(n_a, n_b, n_groups, n_links, text, link_a, link_b)


# --- bundles ----------------------------------------------------------------------------------------

LONGS = "n_a n_b n_groups n_links".split()
BUNDLE = ("digests array<binary>, " + ", ".join(f"{c} array<bigint>" for c in LONGS) + ", hashes array<string>, "
          "places binary, ends binary, links binary, link_ends binary, pairs array<struct<a:int,b:int,n:bigint>>")


def _squeezed(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers).tobytes())


def _numbers(squeezed: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed), kind)


def _bundle(texts: list[tuple[bytes, int, np.ndarray]], chunks: list[str], t: Tokenizers) -> pa.RecordBatch:
    """Results of a bundle's texts (digest, times, places of their chunks)."""
    ids_a, ids_b, n_a, n_b, good = t.tokens(chunks)
    found = align(ids_a, ids_b, n_a, n_b, t)
    key, links = np.unique(found.link_a << 32 | found.link_b, return_inverse=True)
    ends = np.cumsum(found.n_links)
    counts = np.zeros(len(key), np.int64)
    numbers: dict[str, list] = {c: [] for c in LONGS}
    hashes, places = [], []
    for _, n, own in texts:
        if not good[own].all():
            own = own[:0]
        for c in LONGS:
            numbers[c].append(int(getattr(found, c)[own].sum()))
        hashes.append(hashlib.sha256(b";".join([found.text[k] for k in own.tolist()])).hexdigest() if len(own) else "")
        places.append(own)
        # a text's different pairs, from its different chunks
        different = np.unique(own)
        size = found.n_links[different]
        at = np.repeat(ends[different] - size - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        counts[np.unique(links[at])] += n
    used = counts > 0
    new = np.cumsum(used) - 1
    flat = pa.StructArray.from_arrays([pa.array((key[used] >> 32).astype(np.int32)), pa.array((key[used] & 0xFFFFFFFF).astype(np.int32)),
                                       pa.array(counts[used])], ["a", "b", "n"])
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays([
        one([d for d, _, _ in texts], pa.binary()), *(one(numbers[c], pa.int64()) for c in LONGS), one(hashes, pa.string()),
        *(pa.array([_squeezed(x)], pa.binary()) for x in (
            np.concatenate(places).astype("<i4"), np.cumsum([len(p) for p in places]), new[links].astype("<i4"), ends)),
        pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
        ["digests", *LONGS, "hashes", "places", "ends", "links", "link_ends", "pairs"])


def bundles(texts: DataFrame, byte_path: str, piece_path: str, s: Settings) -> DataFrame:
    """Written table of bundles, from different texts (digest, text, times)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizers(byte_path, piece_path)
        places, held, chunks = Places(), [], 0
        for batch in batches:
            digests, times, column = batch.column("digest"), batch.column("times"), batch.column("text")
            for k in range(batch.num_rows):
                own = t.chunks(column[k].as_py())
                held.append((digests[k].as_py(), times[k].as_py(), np.fromiter(map(places.__getitem__, own), np.int64, len(own))))
                chunks += len(own)
                if len(held) >= s.bundle_texts or chunks > s.bundle_chunks or len(places) > s.bundle_distinct or places.size > s.bundle_bytes:
                    yield _bundle(held, list(places), t)
                    places, held, chunks = Places(), [], 0
        if held:
            yield _bundle(held, list(places), t)
        pa.default_memory_pool().release_unused()

    found = texts.select("digest", "text", "times").mapInArrow(gather, BUNDLE)
    return stage(found.withColumn("bundle", F.monotonically_increasing_id()), "alignment-bundles")


def _measured(rows: DataFrame) -> DataFrame:
    """Results per text, from bundles with the counts of their pairs (known)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                known = row["known"].values
                count, best = (np.array(known.field(c)).astype(np.int64) for c in ("count", "best"))
                links, link_ends = _numbers(row["links"].as_py(), "<i4"), _numbers(row["link_ends"].as_py(), "<i8")
                places, ends = _numbers(row["places"].as_py(), "<i4"), _numbers(row["ends"].as_py(), "<i8")
                out = []
                for values in (best, count):
                    # chunks of texts without tokens may hold links that no text has; nobody reads their sums
                    links_sum = np.r_[0, np.cumsum(np.r_[values, 0][links])]
                    chunk = np.diff(links_sum[np.r_[0, link_ends]])
                    text = np.r_[0, np.cumsum(chunk[places])][np.r_[0, ends]]
                    out.append(pa.array(np.diff(text), pa.int64()))
                yield pa.RecordBatch.from_arrays([*(row[c].values for c in ["digests", *LONGS, "hashes"]), *out],
                                                 ["digest", *LONGS, "groups_sha256", "n_best", "count_sum"])

    return rows.select("digests", *LONGS, "hashes", "places", "ends", "links", "link_ends", "known").mapInArrow(
        measure, "digest binary, " + ", ".join(f"{c} bigint" for c in LONGS) + ", groups_sha256 string, n_best bigint, count_sum bigint")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    text = F.col("text").cast("string")
    digest = F.unhex(F.sha2(text, 256))
    # equal texts are counted in each task before they are shuffled, whole
    texts = docs.where(F.length(text) > 0).groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("times"))
    found = bundles(texts.withColumn("digest", F.unhex(F.sha2("text", 256))), byte_path, piece_path, s)

    entries = found.select("bundle", F.posexplode("pairs").alias("place", "x")).select("bundle", "place", "x.a", "x.b", "x.n")
    counts = stage(entries.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    # no more than the pairs of a bundle
    known = entries.join(counts, ["a", "b"]).groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("known"))
    empty = F.array().cast("array<struct<place:int,count:bigint,best:int>>")
    results = stage(_measured(found.join(known, "bundle", "left").withColumn("known", F.coalesce("known", empty))), "alignments")

    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest.alias("digest")).join(results, "digest", "left")
    zero = F.lit(0).cast("bigint")
    return out.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in [*LONGS, "n_best", "count_sum"]],
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
