"""Collocations: the best phrases of two to four words of every language, by best-first growth of prefixes.

The score of a phrase that occurs ``a`` times is its lowest cut, ``floor(2000000 * a / (l + r))`` with the counts of both parts. A phrase that grows from a
prefix counted ``c`` times, whose first word is counted ``f`` times, has ``a <= c``, and its first cut has ``l = f`` and ``r >= a``; so it scores
``floor(2000000 * c / (f + c))`` at most. Growth is best first: a round sets a score for each language, expands every prefix whose bound
reaches it, and settles what scores at least that. Where fewer than the wanted phrases survive, the next round goes further down, for
those languages only; at score 0 everything is expanded. A phrase falls to a longer one exactly if it falls to one that is a word longer, as a
longer one holds such a one between with a count no smaller; so a round also counts the phrases one word longer on either side of what it settles.

The corpus is read once, into bundles: the distinct words of a bounded number of texts, and the texts as places in that list. Words are
numbered over the corpus, rare ones end a run of words (no candidate holds one), and all later passes read the numbers. A pass counts per bundle
before anything is shuffled. Which prefixes a pass expands reaches the tasks as a bit array of at most ``most_bits``; what it lets through
beyond that is counted as well, rightly, and does no harm. All counts are exact.

Defined results: a null text is empty, a null language is ``und``. Repeated rows and null ids count like any other row. Languages with fewer
surviving phrases than wanted give what they have. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import mix64, numbered, raw
from trolley.session import stage


@dataclass(frozen=True)
class Settings:
    least: int = 30
    per_language: int = 2000
    dropped_percent: int = 80
    #: Phrases of two words, in multiples of ``per_language``, down to whose score the first round goes; then ``wider`` times as many.
    first: int = 2
    wider: int = 4
    bundle_words: int = 1_000_000
    bundle_bytes: int = 8 << 20
    bits_per_prefix: int = 16
    least_bits: int = 20
    most_bits: int = 27


SCALE = 2_000_000
NONE = "und"
#: Lower case, and one sign for the ends of pieces and one for spaces.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
END, GAP = -1, -2


class Words(dict):
    """Places of words; a new word is put at the end of a list that all languages share, and its size added to theirs."""

    def __init__(self, lang: str, all_words: list[tuple[str, bytes]], size: list[int]):
        super().__init__({b"\n": END, b"": GAP})
        self.lang, self.all_words, self.size = lang, all_words, size

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.all_words)
        self.all_words.append((self.lang, word))
        self.size[0] += len(word) + 16
        return place


def _squeezed(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _numbers(squeezed: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed), kind)


def _of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that few bundles are open at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k] for name in batch.schema.names}


def bundles(docs: DataFrame, s: Settings) -> DataFrame:
    """Written table: bundle, texts (places in ``words``, -1 at the ends of pieces), words (lang, word, n)."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[tuple[str, bytes]] = []
        places: dict[str, Words] = {}
        texts: list[np.ndarray] = []
        held, size = 0, [0]

        def flush() -> pa.RecordBatch:
            found = np.concatenate(texts)
            count = np.bincount(found[found >= 0], minlength=len(words))
            flat = pa.StructArray.from_arrays(
                [pa.array([x for x, _ in words], pa.string()), pa.array([w.decode() for _, w in words], pa.string()), pa.array(count, pa.int64())],
                ["lang", "word", "n"])
            out = pa.RecordBatch.from_arrays([
                pa.array([_squeezed(found)], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), flat).cast(kind)],
                ["texts", "words"])
            words.clear(), places.clear(), texts.clear()
            return out

        for batch in batches:
            langs, column = batch.column("lang").to_pylist(), batch.column("text")
            for k, lang in enumerate(langs):
                parts = column[k].as_py().translate(PLAIN).replace(b"\n", b" \n ").split(b" ")
                if lang not in places:
                    places[lang] = Words(lang, words, size)
                found = np.fromiter(map(places[lang].__getitem__, parts), np.int32, len(parts))
                found = np.append(found[found != GAP], np.int32(END))
                texts.append(found)
                held += len(found)
                if held > s.bundle_words or size[0] > s.bundle_bytes:
                    yield flush()
                    held, size[0] = 0, 0
        if texts:
            yield flush()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), raw("text").alias("text"))
    found = rows.mapInArrow(gather, "texts binary, words array<struct<lang:string,word:string,n:bigint>>")
    return stage(found.withColumn("bundle", F.monotonically_increasing_id()), "phrase-bundles")


def numbered_texts(found: DataFrame, words: DataFrame) -> DataFrame:
    """Written table: texts as places in ``ids``, the numbers of the bundle's words that ``words`` (lang, word, at) has; -1 for all others."""
    entries = found.select("bundle", F.posexplode("words").alias("place", "x")).select("bundle", "place", "x.lang", "x.word")
    known = entries.join(words.select("lang", "word", "at"), ["lang", "word"])
    # no more than the distinct words of a bundle
    of = known.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("place", "at"))).alias("known"))

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _of(batches):
            texts, known = _numbers(row["texts"].as_py(), "<i4"), row["known"].values
            place = np.array(known.field("place"))
            new = np.full(max(int(texts.max(initial=-1)), int(place.max(initial=-1))) + 2, -1, np.int32)
            new[place] = np.arange(len(place))
            texts = new[texts]
            texts = texts[np.r_[True, (texts[1:] >= 0) | (texts[:-1] >= 0)]]
            yield pa.RecordBatch.from_arrays([
                pa.array([_squeezed(texts)], pa.binary()), pa.array([np.array(known.field("at")).astype("<i8").tobytes()], pa.binary())], ["texts", "ids"])

    return stage(found.select("bundle", "texts").join(of, "bundle").select("texts", "known").mapInArrow(renumber, "texts binary, ids binary"),
                 "phrase-numbers")


# --- counting ----------------------------------------------------------------------------------


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of rows of numbers."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mix64(out ^ c.astype(np.uint64))
    return out


def names(n: int) -> list[str]:
    return [f"w{k}" for k in range(1, n + 1)]


@dataclass(frozen=True)
class Chosen:
    """Hashes of phrases as a bit array of 2^size bits."""

    bits: np.ndarray
    size: int

    def has(self, columns: list[np.ndarray]) -> np.ndarray:
        at = hashed(columns) >> np.uint64(64 - self.size)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def chosen(phrases: DataFrame, n: int, s: Settings) -> Chosen | None:
    """Phrases (w1..) as a bit array; None where there are none. At most 2^most_bits bits reach the driver."""
    total = phrases.count()
    if not total:
        return None
    size = min(max(s.least_bits, int(total * s.bits_per_prefix).bit_length()), s.most_bits)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (hashed([np.array(c) for c in batch.columns]) >> np.uint64(64 - size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], ["chunk", "at"])

    found = phrases.select(*names(n)).mapInArrow(places, "chunk bigint, at bigint")
    bits = np.zeros((1 << size) // 8, np.uint8)
    for row in found.groupBy("chunk").agg(F.bitmap_construct_agg("at").alias("bits")).collect():
        bits[row["chunk"] * 4096: row["chunk"] * 4096 + 4096] = np.frombuffer(row["bits"], np.uint8)
    return Chosen(bits, size)


def counted(texts: DataFrame, n: int, s: Settings, prefix: Chosen | None = None, suffix: Chosen | None = None,
            whole: Chosen | None = None) -> DataFrame:
    """Phrases of ``n`` words (w1..) with ``least`` occurrences or more (a): those whose first or last n - 1 words are chosen, or that
    are chosen as a whole; all of them if nothing is given."""
    sent = texts.sparkSession.sparkContext.broadcast((prefix, suffix, whole))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [(x, part) for x, part in zip(sent.value, (slice(None, -1), slice(1, None), slice(None))) if x is not None]
        for row in _of(batches):
            text, ids = _numbers(row["texts"].as_py(), "<i4"), np.frombuffer(row["ids"].as_py(), "<i8")
            end = len(text) - n + 1
            if end <= 0:
                continue
            runs = text[:end] >= 0
            for k in range(1, n):
                runs &= text[k: end + k] >= 0
            at = np.flatnonzero(runs)
            if wanted:
                words = [ids[text[at + k]] for k in range(n)]
                at = at[np.any([x.has(words[part]) for x, part in wanted], axis=0)]
            if not len(at):
                continue
            # rows of places as one number, a word more at a time
            key = text[at].astype(np.int64)
            for k in range(1, n):
                if k > 1:
                    key = np.unique(key, return_inverse=True)[1].astype(np.int64)
                key = key << 32 | text[at + k]
            _, first, many = np.unique(key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(ids[text[at[first] + k]], pa.int64()) for k in range(n)), pa.array(many, pa.int64())],
                                             [*names(n), "c"])

    found = texts.mapInArrow(count, ", ".join(f"{w} bigint" for w in [*names(n), "c"]))
    return found.groupBy(*names(n)).agg(F.sum("c").alias("a")).where(F.col("a") >= s.least)


# --- scores -----------------------------------------------------------------------------------


def exact_score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both); the product may pass 64 bits."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)"), both.cast("decimal(20,0)")).cast("bigint")


def lowest(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """Struct (score, k, l, r) of the lowest cut, ties to the smallest k."""
    found = [F.struct(exact_score(a, left + right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
             for k, (left, right) in enumerate(cuts, 1)]
    return found[0] if len(found) == 1 else F.array_min(F.array(*found))


def bound() -> Column:
    """What a phrase that starts with these words can score at most."""
    return exact_score(F.col("a"), F.col("f") + F.col("a"))


def _named(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def _falls(phrases: DataFrame, longer: DataFrame, n: int, s: Settings) -> DataFrame:
    """``phrases`` of n words without those that lie inside a phrase of ``longer`` (n + 1 words) with nearly all occurrences."""
    parts = [longer.select(*[F.col(f"w{k + shift}").alias(f"w{k}") for k in range(1, n + 1)], F.col("a").alias("longer")) for shift in (0, 1)]
    most = parts[0].unionByName(parts[1]).groupBy(*names(n)).agg(F.max("longer").alias("longer"))
    many = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * s.dropped_percent
    return phrases.join(most, names(n), "left").where(~F.coalesce(many, F.lit(False))).drop("longer")


def _with_goal(phrases: DataFrame, goals: DataFrame) -> DataFrame:
    return phrases.join(goals.select("lang", "goal"), "lang")


def _row(phrases: DataFrame, n: int) -> DataFrame:
    return phrases.select("lang", F.array(*names(n)).alias("ws"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                          F.col("cut.score").alias("score"))


def _settled(texts: DataFrame, pairs: DataFrame, goals: DataFrame, s: Settings) -> DataFrame:
    """All surviving phrases that score their language's goal or more: lang, ws, a, l, r, score. ``pairs`` are all phrases of two words."""
    two = _with_goal(pairs, goals).where("bound >= goal")
    good_two = two.where("cut.score >= goal")
    three = counted(texts, 3, s, chosen(two, 2, s), chosen(good_two, 2, s))
    head = _named(pairs, lang="lang", w1="w1", w2="w2", f="f", a12="a")
    tail = _named(pairs, w2="w1", w3="w2", a23="a", f3="g")
    three = three.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    three = three.withColumn("cut", lowest(F.col("a"), [(F.col("f"), F.col("a23")), (F.col("a12"), F.col("f3"))])).withColumn("bound", bound())
    three = stage(three.select("lang", *names(3), "a", "f", "a12", "cut", "bound"), "phrases-of-three")

    open_three = _with_goal(three, goals).where("bound >= goal")
    good_three = open_three.where("cut.score >= goal")
    heads, tails = chosen(open_three, 3, s), chosen(good_three, 3, s)
    rows = [_row(_falls(good_two, three, 2, s), 2)]
    if heads is not None:
        four = stage(counted(texts, 4, s, heads, tails), "phrases-of-four")
        rows.append(_row(_falls(good_three, four, 3, s), 3))
        head = open_three.select("lang", *names(3), "f", "a12", F.col("a").alias("a123"), "goal")
        tail = _named(pairs, w3="w1", w4="w2", a34="a", f4="g")
        high = four.join(head, names(3)).join(tail, ["w3", "w4"])
        a, both, last = F.col("a"), (F.col("a12"), F.col("a34")), (F.col("a123"), F.col("f4"))
        high = stage(high.where((bound() >= F.col("goal")) & (lowest(a, [both, last])["score"] >= F.col("goal"))), "phrases-of-four")
        # the last three words of such a phrase may start with a prefix that was not expanded
        ends = high.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3")).distinct()
        whole = chosen(ends, 3, s)
        if whole is not None:
            tail = _named(counted(texts, 3, s, whole=whole), w2="w1", w3="w2", w4="w3", a234="a")
            high = high.join(tail, ["w2", "w3", "w4"]).withColumn("cut", lowest(a, [(F.col("f"), F.col("a234")), both, last]))
            rows.append(_row(high.where("cut.score >= goal"), 4))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return stage(out, "phrases-settled")


def _goals(pairs: DataFrame, langs: DataFrame, place: int) -> DataFrame:
    """The score of the phrase of two words at ``place`` of each of ``langs``, 0 where there are fewer."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), "w1", "w2")
    top = (pairs.join(langs, "lang", "left_semi").select("lang", "w1", "w2", F.col("cut.score").alias("score"))
           .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= place))
    goal = top.groupBy("lang").agg(F.when(F.max("rank") >= place, F.min("score")).otherwise(F.lit(0)).cast("bigint").alias("goal"))
    return stage(goal, "phrase-goals")


def mine(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found = bundles(docs, s)
    every = stage(found.select(F.inline("words")).groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")
    total = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stage(numbered(every.where(F.col("f") >= s.least), ["lang", "word"], "phrase-word-numbers"), "phrase-word-numbers")
    texts = numbered_texts(found, words)

    one = words.select("at", "lang", "f")
    pairs = counted(texts, 2, s).join(_named(one, w1="at", lang="lang", f="f"), "w1").join(_named(one, w2="at", g="f"), "w2")
    pairs = pairs.withColumn("cut", lowest(F.col("a"), [(F.col("f"), F.col("g"))])).withColumn("bound", bound())
    pairs = stage(pairs.select("lang", "w1", "w2", "a", "f", "g", "cut", "bound"), "phrases-of-two")

    langs = stage(pairs.select("lang").distinct(), "phrase-languages")
    place, done = s.first * s.per_language, None
    while not langs.isEmpty():
        goals = _goals(pairs, langs, place)
        settled = _settled(texts, pairs, goals, s)
        many = settled.groupBy("lang").agg(F.count(F.lit(1)).alias("many"))
        state = goals.join(many, "lang", "left").withColumn("over", (F.coalesce("many", F.lit(0)) >= s.per_language) | (F.col("goal") <= 0))
        state = stage(state, "phrase-state")
        final = settled.join(state.where("over"), "lang", "left_semi")
        done = final if done is None else done.unionByName(final)
        langs = state.where("not over").select("lang")
        place *= s.wider
    if done is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")

    text = (done.select("lang", "ws", "a", "l", "r", "score", F.posexplode("ws").alias("k", "at"))
            .join(words.select("at", "word"), "at")
            .groupBy("lang", "ws", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("words")))
    text = text.withColumn("phrase", F.array_join("words.word", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = text.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.per_language)
    return best.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
