"""Quality rules: distance of a document's histograms from those of its language.

A document is held against two reference histograms of its language by Jensen-Shannon distance (base 2,
so between 0 and 1): character classes, and the language's most common words with one bin for the rest.
Short texts scatter more, so both limits widen with 1/sqrt(words), and nothing under ``min_words`` is judged.

The references are means over all distinct texts of a language that pass the base rules: every distinct text
weighs the same, however often it is copied and however long it is. Sums are kept in whole millionths, so that
they don't depend on the order of rows. Which road a reference takes makes no difference to a verdict: those of at most ``max_languages`` languages (those with most texts,
``common_words`` words each) go through the driver, those of all other languages stay a table that joins their documents.

Defined results: a null or empty text has no words and fails the base rules. A document whose language is null, or has
under ``min_texts`` texts and so no reference, is judged by the base rules alone and has no distances.
Rows are judged one by one, so repeated rows and null ids get their own row each. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import packed, raw, unpacked
from trolley.session import stage

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "punctuation", "symbol", "inside")
MILLION = 1_000_000
FLUSH = 400_000
#: What a row of the reference statistics is about.
TEXTS, CLASS, WORD = 0, 1, 2


@dataclass(frozen=True)
class Rules:
    """Parameters. ``*_limit`` is the limit for endless texts, ``*_scatter`` what one word would add to it."""

    min_words: int = 50
    max_repeat_percent: int = 50
    class_limit: float = 0.15
    class_scatter: float = 1.5
    word_limit: float = 0.35
    word_scatter: float = 0.9
    common_words: int = 64
    min_texts: int = 20
    max_languages: int = 256


@dataclass(frozen=True)
class References:
    """By language: class histogram, common words, and their histogram with the rest as the last bin. ``more`` has the languages that
    don't reach the driver: lang, and its statistics (kind, item, share, r) as an array ``own``; None if there are none."""

    classes: dict[str, np.ndarray] = field(default_factory=dict)
    words: dict[str, list[bytes]] = field(default_factory=dict)
    shares: dict[str, np.ndarray] = field(default_factory=dict)
    more: DataFrame | None = None

    def add(self, lang: str, stats: list, rules: Rules) -> None:
        """Histograms of a language from its statistics, rows with kind, item, share and rank r."""
        total = sum(r["share"] for r in stats if r["kind"] == TEXTS)
        classes = np.zeros(len(CLASSES) - 1)
        for r in stats:
            if r["kind"] == CLASS:
                classes[r["item"][0]] = r["share"] / total
        words = sorted((r for r in stats if r["kind"] == WORD and r["r"] <= rules.common_words), key=lambda r: r["r"])
        share = np.array([r["share"] / total for r in words])
        self.classes[lang], self.words[lang] = classes / classes.sum(), [bytes(r["item"]) for r in words]
        self.shares[lang] = np.append(share, max(1 - share.sum(), 0.0))


def _class_table() -> np.ndarray:
    at = {c: i for i, c in enumerate(CLASSES)}
    kind = np.full(256, at["symbol"])
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            kind[b] = at["other_letter"]
        elif b >= 0x80:
            kind[b] = at["inside"]
        elif "a" <= c <= "z":
            kind[b] = at["lower"]
        elif "A" <= c <= "Z":
            kind[b] = at["upper"]
        elif c.isdigit():
            kind[b] = at["digit"]
        elif c in " \t\n\v\f\r":
            kind[b] = at["space"]
        elif c in ".,;:!?'\"()-":
            kind[b] = at["punctuation"]
    return kind


_KIND = _class_table()


def class_histogram(text: bytes) -> np.ndarray:
    """Share of each character class among the characters; bytes inside a character don't count."""
    counts = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=len(CLASSES))[:-1]
    return counts / max(counts.sum(), 1)


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    spaces = len(text) - sum(map(len, words))
    lines = Counter(line for line in text.split(b"\n") if line and not line.isspace())
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        n = Counter(triples)
        start = np.fromiter((n[t] > 1 for t in triples), bool, len(triples))
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k: k + len(start)] |= start
        repeated = int(covered.sum())
    return (len(words), len(text.decode("utf-8", "replace")) - spaces, sum(text.count(bytes([s])) for s in SYMBOLS),
            sum(lines.values()) - len(lines), repeated)


def base_failed(n_words: int, n_repeat_words: int, rules: Rules) -> bool:
    return n_words < rules.min_words or 100 * n_repeat_words > rules.max_repeat_percent * n_words


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the divergence, base 2."""
    m = (p + q) / 2
    total = 0.0
    for x in (p, q):
        some = x > 0
        total += float((x[some] * np.log2(x[some] / m[some])).sum())
    return float(np.sqrt(max(total / 2, 0.0)))


def word_histogram(counts: Counter, n: int, words: list[bytes]) -> np.ndarray:
    found = np.array([counts.get(w, 0) for w in words], float)
    return np.append(found, n - found.sum()) / max(n, 1)


def distances(text: bytes, lang: str | None, refs: References) -> tuple[float | None, float | None]:
    """Class and word distance from the language's reference; none without one."""
    if lang not in refs.classes:
        return None, None
    counts = Counter(text.lower().split())
    return (jensen_shannon(class_histogram(text), refs.classes[lang]),
            jensen_shannon(word_histogram(counts, sum(counts.values()), refs.words[lang]), refs.shares[lang]))


def verdict(text: bytes, lang: str | None, refs: References, rules: Rules) -> tuple:
    """The base counts, base_failed, kept, class_distance, word_distance."""
    counts = base_counts(text)
    failed = base_failed(counts[0], counts[4], rules)
    if counts[0] < rules.min_words:
        return *counts, failed, False, None, None
    by_class, by_word = distances(text, lang, refs)
    scatter = 1 / np.sqrt(counts[0])
    kept = not failed and (by_class is None or (
        by_class <= rules.class_limit + rules.class_scatter * scatter
        and by_word <= rules.word_limit + rules.word_scatter * scatter))
    return *counts, failed, bool(kept), by_class, by_word


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """One row (lang, packed) per distinct text and language with the text compressed, whatever the ids are. Texts with the same two
    hashes are equal; their copies fall together before the shuffle, so a much repeated text is one row per task."""
    lang = F.col("lang").cast("string")
    text = raw("text")
    rows = docs.where("lang is not null")
    rows = packed(rows, lang.alias("lang"), F.xxhash64(lang, text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), text=text)
    return rows.groupBy("lang", "h", "g").agg(F.first("packed").alias("packed")).select("lang", "packed")


def fit_references(docs: DataFrame, rules: Rules = Rules()) -> References:
    """Reference histograms over all distinct texts that pass the base rules; common words are those with the largest mean share."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int, bytes], int] = {}

        def flush() -> pa.RecordBatch:
            # in order, neighbours share prefixes and compress better in the shuffle
            keys = sorted(found)
            out = pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.binary()), pa.array([found[k] for k in keys], pa.int64())],
                ["lang", "kind", "item", "share"])
            found.clear()
            return out

        def add(lang: str, kind: int, item: bytes, share: float) -> None:
            key = (lang, kind, item)
            found[key] = found.get(key, 0) + math.floor(share * MILLION + 0.5)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), unpacked(batch.column("packed").to_pylist())):
                counts = base_counts(text)
                if base_failed(counts[0], counts[4], rules):
                    continue
                add(lang, TEXTS, b"", 1.0)
                for i, x in enumerate(class_histogram(text)):
                    add(lang, CLASS, bytes([i]), float(x))
                for w, n in Counter(text.lower().split()).items():
                    add(lang, WORD, w, n / counts[0])
                if len(found) > FLUSH:
                    yield flush()
        yield flush()

    rows = (_distinct_texts(docs).mapInArrow(shares, "lang string, kind int, item binary, share bigint")
            .groupBy("lang", "kind", "item").agg(F.sum("share").alias("share")))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("share"), "item")
    top = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max(rules.common_words, len(CLASSES)))
    top = stage(top, "reference-statistics")
    enough = top.where((F.col("kind") == TEXTS) & (F.col("share") >= rules.min_texts * MILLION))
    largest = [r["lang"] for r in enough.orderBy(F.desc("share"), "lang").limit(rules.max_languages + 1).collect()]
    chosen, beyond = largest[: rules.max_languages], len(largest) > rules.max_languages
    by: dict[str, list] = {x: [] for x in chosen}
    for r in top.where(F.col("lang").isin(chosen)).collect():
        by[r["lang"]].append(r)
    more = None
    if beyond:
        others = enough.where(~F.col("lang").isin(chosen)).select("lang")
        more = stage(top.join(others, "lang").groupBy("lang").agg(F.collect_list(F.struct("kind", "item", "share", "r")).alias("own")),
                     "more-references")
    refs = References(more=more)
    for x in chosen:
        refs.add(x, by[x], rules)
    return refs


def _with_own(docs: DataFrame, lang: str, refs: References) -> DataFrame:
    """``docs`` with the statistics of languages that are not on the driver as column ``__own``, null for all other rows."""
    if refs.more is None:
        return docs.withColumn("__own", F.lit(None).cast("array<struct<kind:int,item:binary,share:bigint,r:int>>"))
    more = refs.more.select(F.col("lang").alias("__lang"), F.col("own").alias("__own"))
    return docs.join(more, F.col(lang).cast("string") == F.col("__lang"), "left").drop("__lang")


def _verdicts(texts: list[bytes], langs: list[str | None], own: list[list | None], refs: References, rules: Rules) -> list[tuple]:
    """Verdicts of rows; a row with its own statistics is held against these."""
    found, out, last = References(), [], None
    for text, lang, stats in zip(texts, langs, own):
        if stats is None:
            out.append(verdict(text, lang, refs, rules))
            continue
        if lang != last:
            found, last = References(), lang
            found.add(lang, stats, rules)
        out.append(verdict(text, lang, found, rules))
    return out


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, class_distance double, word_distance double")


def judge(docs: DataFrame, refs: References, rules: Rules = Rules()) -> DataFrame:
    """One row per document with the base counts, the two distances and the verdict."""

    near = replace(refs, more=None)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2
        for batch in batches:
            found = _verdicts(*(batch.column(c).to_pylist() for c in ("text", "lang", "__own")), near, rules)
            columns = [list(c) for c in zip(*found)] or [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds[1:]))], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), raw("text").alias("text"))
    return _with_own(rows, "lang", refs).mapInArrow(each, SCHEMA)


def keep(docs: DataFrame, refs: References, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns as they came."""

    near = replace(refs, more=None)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, own = (batch.column(c).to_pylist() for c in ("text", "lang", "__own"))
            kept = [v[6] for v in _verdicts([(t or "").encode() for t in texts], langs, own, near, rules)]
            yield batch.drop_columns(["__own"]).filter(pa.array(kept, pa.bool_()))

    return _with_own(docs, "lang", refs).mapInArrow(each, docs.schema)


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Fit the references on ``docs`` and judge every document."""
    return judge(docs, fit_references(docs, rules), rules)
