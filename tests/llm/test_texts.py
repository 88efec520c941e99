"""Operators on documents against brute force."""

import base64
import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from compare import difference
from llm.conftest import DOCS
from trolley.llm import byte_bpe, minhash, packing, quality, queries, recurrent_lm, repeats, sharding

P = pytest.importorskip("public_tokenizers")


def shingles(text, n):
    w = (text or "").encode().lower().split()
    m = min(n, len(w))
    return frozenset(tuple(w[i: i + m]) for i in range(len(w) - m + 1)) if m else frozenset()


def components(sets, percent=80):
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(docs, texts, n):
    # blocks of a few rows, so that groups are cut as large ones are
    s = minhash.Settings(shingle=n, sketch_block=4, set_block=3)
    rows = minhash.near_duplicates(docs, s).collect()
    want = components({i: shingles(t, n) for i, t in enumerate(texts)})
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(shingles(texts[r.doc_id], n)), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    s = minhash.Settings()
    signer = minhash.Signer(s)
    for share in (0.95, 0.85, 0.8):
        off = []
        for _ in range(20):
            items = rng.integers(0, 2**63, 600).astype(np.uint64)
            k = int(500 * share)
            a, b = items[:500], np.concatenate([items[:k], items[500: 1000 - k]])
            true = k / (1000 - k)
            x, y = (np.frombuffer(signer(np.unique(v))[0], np.uint64) for v in (a, b))
            off.append(minhash.estimate(np.bitwise_count(x ^ y).sum(), s) - true)
        assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.06


def test_keep_one(docs, texts, empty):
    kept = minhash.keep_one(docs, minhash.Settings(shingle=5))
    assert kept.columns == docs.columns
    want = components({i: shingles(t, 5) for i, t in enumerate(texts)})
    ids = [r.doc_id for r in kept.collect()]
    # of the two rows without id, one has the text of row 0 and goes
    assert sorted(i for i in ids if i is not None) == sorted(i for i in want if want[i] == i) and ids.count(None) == 1
    assert minhash.keep_one(empty).count() == 0


def test_keep_one_compares_rows_not_ids(spark):
    rng = random.Random(6)
    prose = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(6)]
    # 1: a text of its own and a copy of 0's under one id; 2: two copies under one id; null ids that are copies of each other; no words
    rows = [(0, prose[0]), (1, prose[1]), (1, prose[0]), (2, prose[2]), (2, prose[2] + " end"), (None, prose[3]), (None, prose[3] + " x"),
            (None, prose[4]), (7, prose[5]), (6, prose[5]), (8, ""), (8, ""), (None, None)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, __id int").repartition(4)
    kept = minhash.keep_one(df, minhash.Settings(shingle=5)).collect()
    assert collections.Counter(r.doc_id for r in kept) == collections.Counter([0, 1, 2, None, None, None, 6, 8, 8])
    assert {r.text for r in kept if r.doc_id in (0, 1, 6)} == {prose[0], prose[1], prose[5]}


def covered(all_texts, least):
    seen = collections.Counter(t[p: p + least] for t in all_texts for p in range(len(t) - least + 1))
    for t in all_texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - least + 1):
            if seen[t[p: p + least]] > 1:
                gone[p: p + least] = True
        yield gone


@pytest.mark.parametrize("s", [repeats.Settings(), repeats.Settings(40, 8, 2000), repeats.Settings(40, 8, 1)])
def test_repeats(docs, s):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    want = collections.Counter()
    for (i, t), gone in zip(rows, covered([t for _, t in rows], s.least)):
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i, len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])] += 1
    got = collections.Counter((r.doc_id, r.n_bytes, sum(x.length for x in r.spans), len(r.spans), bytes(r.kept))
                              for r in repeats.without_repeats(docs, s).collect())
    assert got == want
    assert any(k[2] and k[3] > 1 for k in want) or s.least == 200


def test_remove_repeats_keeps_columns_and_whole_characters(docs, empty):
    out = repeats.remove_repeats(docs, repeats.Settings(40, 8))
    assert out.columns == docs.columns
    before, after = docs.collect(), out.collect()
    assert len(before) == len(after) and all(r.n_chars == len(r.text or "") for r in after)
    assert sum(r.text is None for r in before) == sum(r.text is None for r in after)
    assert repeats.remove_repeats(empty).count() == 0


def test_maximal_repeats_are_whole_groups():
    texts = [b"--abcdefgh++", b"**abcdefgh//", b"..abcdezz"]
    found = {(n, tuple(sorted((int(k), int(o)) for k, o in zip(t, p)))) for n, t, p in
             repeats.maximal_repeats(texts, [len(t) - 3 for t in texts], 4)}
    assert (8, ((0, 2), (1, 2))) in found and (5, ((0, 2), (1, 2), (2, 2))) in found
    assert all(any(texts[k][p - 1] != texts[g[0][0]][g[0][1] - 1] for k, p in g) for _, g in found)


def test_word_cache_is_bounded_and_keeps_early_words(monkeypatch):
    path = P.path("word_bpe_49k.json")
    tokenizer = packing.WordTokenizer(path)
    monkeypatch.setattr(packing, "CACHE_BYTES", 20_000)
    most = 0
    for k in range(200):
        text = f"word{k}a é{k} -{k}- same".encode()
        ids = tokenizer.encode([text])
        most = max(most, tokenizer.held)
        assert k % 50 or ids == packing.WordTokenizer(path).encode([text])
    # an early word stays, the cache never holds much more than its bound
    assert b"same" in tokenizer.cache and 10_000 < most < 25_000 and len(tokenizer.cache) + len(tokenizer.pieces) < 130


def test_byte_bpe(docs, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    assert byte_bpe.read_ranks(path) == ranks
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spark = docs.sparkSession
    odd = spark.createDataFrame([(900, "a\x00b \x1c don't  \n\n x\u0301 日本語 <|endoftext|> 1234"), (901, None)], "doc_id bigint, text string")
    texts = collections.Counter((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").union(odd).collect())
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in
                              byte_bpe.encode(docs.select("doc_id", "text").union(odd), ranks, P.PATTERN).collect())
    want = collections.Counter()
    for (i, t), n in texts.items():
        ids = own.encode_ordinary(t)
        want[i, len(ids), ",".join(map(str, ids)), t.encode()] += n
    # one of them is a single run of letters
    assert max(len(t) for _, t in texts) > 15_000
    assert got == want
    assert byte_bpe.encode(empty, ranks, P.PATTERN).count() == 0


def test_byte_bpe_folds_a_word_of_a_task_once(docs, monkeypatch):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(byte_bpe, "BUNDLE_DISTINCT", 150)
    some = docs.where("doc_id < 38").select("doc_id", "text").coalesce(1)
    rows = byte_bpe.bundles(some, P.PATTERN).collect()
    words = [w for r in rows for w in r.words]
    assert len(rows) > 3 and len(words) == len(set(words))
    # and its list starts anew when it is long
    monkeypatch.setattr(byte_bpe, "HELD_DISTINCT", 400)
    assert sum(r["first"] == 0 for r in byte_bpe.bundles(some, P.PATTERN).collect()) > 1
    got = collections.Counter((r.doc_id, r.ids, bytes(r.decoded)) for r in byte_bpe.encode(some, ranks, P.PATTERN).collect())
    assert got == collections.Counter((r.doc_id, ",".join(map(str, own.encode_ordinary(r.text))), r.text.encode()) for r in some.collect())


def test_byte_bpe_pairs_take_different_places():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**34, 20_000))
    q, b, shift, place = byte_bpe.deal_out(keys)
    assert len(np.unique(place)) == len(keys) and (place == keys % q + shift[keys % b]).all() and place.max() < 2 * q
    with pytest.raises(ValueError):
        byte_bpe.RankMap(None, {b"a": 0})


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, 512).collect()
    want = collections.Counter()
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 512):
            part = np.array(ids[k: k + 512], "<u4")
            want[r.doc_id, k // 512, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 512
    assert packing.pack(empty, path, 512).count() == 0


def test_packed_sequences_hold_the_ids(docs):
    path = P.path("word_bpe_49k.json")
    some = docs.where("doc_id < 20").dropDuplicates(["doc_id"])
    pieces = packing.tokenized(some, path, 256)
    placed = packing.assign(packing.digest(pieces), 256, ["doc_id", "piece"])
    ids = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces, placed).collect()}
    for r in placed.collect():
        assert zlib.crc32(ids[r.sequence_id][4 * r.offset: 4 * (r.offset + r.length)]) == r.ids_crc32


def test_plan_pairs_large_items_and_fills_gaps():
    rng = np.random.default_rng(4)
    for _ in range(40):
        sizes = rng.integers(1, 101, 300)
        counts = dict(collections.Counter(sizes.tolist()))
        p = packing.plan(counts, 100)
        at = np.arange(len(sizes))
        length = np.sort(sizes)[::-1]
        k = np.searchsorted(p.first, at, "right") - 1
        turn = at - p.first[k]
        sequence, offset = p.sequence[k] + turn // p.each[k], p.offset[k] + turn % p.each[k] * length
        fill = np.bincount(sequence, length)
        assert fill.max() <= 100 and len(fill) == p.sequences and (np.bincount(sequence, 3 * length > 100) <= 2).all()
        order = np.lexsort((offset, sequence))
        same = sequence[order][1:] == sequence[order][:-1]
        assert (offset[order][1:] == np.where(same, (offset + length)[order][:-1], 0)).all()
        gaps = []
        for n in length.tolist():
            best = min((g for g in gaps if g >= n), default=None)
            if best is None:
                best = 100
            else:
                gaps.remove(best)
            gaps.append(best - n)
        assert p.sequences <= len(gaps)
    assert packing.plan({}, 100).sequences == 0


def test_sharding(docs, empty):
    rows = sharding.shard_by_curve(docs, ["lang", "source", "n_chars"], 7).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter(
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r.shard].append((r.slot, r.curve))
    counts = [len(shards[k]) for k in range(7)]
    assert max(counts) - min(counts) <= 1
    runs = [[c for _, c in sorted(shards[k])] for k in range(7)]
    assert all([s for s, _ in sorted(shards[k])] == list(range(counts[k])) for k in range(7))
    assert sum(runs, []) == sorted(sum(runs, []))
    assert sharding.shard_by_curve(empty, ["lang"], 24).count() == 0
    few = docs.limit(3)
    assert sorted(r.shard for r in sharding.shard_by_curve(few, ["lang"], 24).collect()) == [0, 1, 2]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def brute_quality(text):
    w = text.encode().split()
    n = collections.Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if n[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_quality_counts_and_verdicts(docs, empty):
    rules = quality.Rules(min_texts=3, common_words=8)
    rows = quality.quality_rules(docs, rules).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        if r.doc_id is None:
            continue
        n, chars, symbols, lines, repeated = brute_quality(by_id[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in rows}
    assert all(kept[i] for i in range(24)) and not kept[by_text(by_id, "##$$ " * 70)]
    assert quality.quality_rules(empty).count() == 0
    out = quality.keep(docs, quality.fit_references(docs, rules), rules)
    assert out.columns == docs.columns and out.where("doc_id is not null").dropDuplicates(["doc_id"]).count() == sum(
        v for k, v in kept.items() if k is not None)


def by_text(by_id, text):
    return next(i for i, t in by_id.items() if t == text)


def test_quality_references_weigh_distinct_texts_once(docs, texts, spark):
    one = quality.fit_references(docs, quality.Rules(min_texts=3))
    copies = spark.createDataFrame([(1000 + i, texts[3], "en", None, 1, 0) for i in range(60)], docs.schema)
    two = quality.fit_references(docs.union(copies), quality.Rules(min_texts=3))
    assert np.allclose(one.classes["de"], two.classes["de"])
    assert quality.jensen_shannon(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    assert quality.jensen_shannon(np.array([0.5, 0.5]), np.array([0.5, 0.5])) == 0


def test_recurrent_scores(docs, texts, empty):
    s = recurrent_lm.Settings(vocabulary=60, classes=8, hidden=6, lanes=8, window=8, train_share=1.0)
    rows = recurrent_lm.score(docs, s).collect()
    tokens = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in docs.collect()]
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens}
    c = collections.Counter(w for i, ws in tokens if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    want = collections.Counter((i, out[i], len(ws), sum(c[w] > 0 for w in ws), n,
                                round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 for r in rows)
    assert recurrent_lm.score(empty, s).count() == 0


def test_recurrent_texts_travel_as_places(docs):
    from pyspark.sql import functions as F

    numbered = recurrent_lm._numbered_words(recurrent_lm._bundled(docs, recurrent_lm.Settings(bundle_bytes=4000))[0])
    listed, counted, found = {}, collections.Counter(), collections.Counter()
    rows = numbered.collect()
    for r in rows:
        if r.word is not None:
            assert listed.setdefault((r.b, r.place), bytes(r.word)) == bytes(r.word)
            counted[bytes(r.word)] += r.n
    words = [x for x in rows if x.word is not None]
    assert len({r.b for r in rows}) > 3 and len({(r.b, bytes(r.word)) for r in words}) == len({(r.b, r.place) for r in words}) == len(words)
    for r in rows:
        if r.word is None:
            places = np.frombuffer(recurrent_lm.unpacked([r.places])[0], "<u4").tolist()
            found[r.doc_id, r.held_out, tuple(listed[r.b, k] for k in places)] += 1
    own = docs.select("doc_id", "text", recurrent_lm.held_out(F.col("doc_id")).alias("out")).collect()
    assert found == collections.Counter((r.doc_id, r.out, tuple((r.text or "").encode().lower().split())) for r in own)
    assert +counted == collections.Counter(w for r in own if not r.out for w in (r.text or "").encode().lower().split())


def test_recurrent_bundles_stay_one_to_a_task(docs):
    from pyspark.sql import functions as F

    s = recurrent_lm.Settings(vocabulary=60, classes=8, hidden=6, lanes=8, window=8, bundle_bytes=4000)
    parts = recurrent_lm._bundled(docs, s)[1]
    assert parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = recurrent_lm.score(docs, s)
    used = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    held = recurrent_lm._bundled(docs, s)[0].select(F.spark_partition_id().alias("p")).distinct().count()
    assert rows.rdd.getNumPartitions() == parts and used == held


def test_recurrent_softmax_without_the_largest_logit():
    m = small_model()
    rng = np.random.default_rng(2)
    states, targets = rng.uniform(-1, 1, (50, 4)).astype(np.float32), rng.integers(0, len(m.symbols), 50)
    assert m.bounded()
    near = m.output(states, targets)[0]
    m.rows = 7
    assert np.allclose(m.output(states, targets)[0], near, atol=1e-5)
    m.w["word"][3] = 1000
    assert not m.bounded() and np.isfinite(m.output(states, targets)[0]).all()


def test_recurrent_score_is_that_of_the_fitted_model(docs, monkeypatch):
    """Every document again, one state at a time in double precision, with the probability of every symbol written out."""
    s = recurrent_lm.Settings(vocabulary=60, classes=8, hidden=6, lanes=8, window=8)
    fit, fitted = recurrent_lm._trained, []
    monkeypatch.setattr(recurrent_lm, "_trained", lambda *given: fitted.append(fit(*given)) or fitted[-1])
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in recurrent_lm.score(docs, s).collect())
    model = fitted[0][0]
    w, sym, k = {n: x.astype(float) for n, x in model.w.items()}, model.symbols, s.hidden
    tokens = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    c = collections.Counter(x for i, ws in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for x in ws)
    assert set(sym.number) == set(sorted(c, key=lambda x: (-c[x], x))[:60])
    rest = sum(n + 1 for x, n in c.items() if x not in sym.number) + 1

    def log10p(words):
        h, before, total = np.zeros(k), recurrent_lm.END, 0.0
        for x in [*(sym.number.get(x, recurrent_lm.OTHER) for x in words), recurrent_lm.END]:
            inp, rec = w["inp"][before], h @ w["rec"]
            z, r = (1 / (1 + np.exp(-inp[a: a + k] - rec[a: a + k])) for a in (0, k))
            cand = np.tanh(inp[2 * k:] + r * rec[2 * k:])
            h = (1 - z) * cand + z * h
            p, classes = np.zeros(len(sym)), np.exp(h @ w["cls"] + w["cls_b"])
            for own, share in zip(sym.members, classes / classes.sum()):
                e = np.exp(w["word"][own] @ h + w["word_b"][own])
                p[own] = share * e / e.sum()
            assert abs(p.sum() - 1) < 1e-9
            total, before = total + math.log10(p[x]), x
        return total + sum(math.log10((c[x] + 1) / rest) for x in words if x not in sym.number)

    want = sorted((-1 if i is None else i, log10p(ws)) for i, ws in tokens)
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-4)


def test_quality_references_count_texts_not_ids(spark, tmp_path):
    """No ids, one id for different texts, and rows that repeat id and text; the verdicts are those of the SQL."""
    rng = random.Random(8)
    some = [" ".join(rng.choice(["ab", "cd", "ef", "gh", str(k)]) + rng.choice("xyz") for _ in range(60)) for k in range(66)]
    rows = [(None, t, "en", None, 1) for t in some[:22]] + [(7, t, "de", None, 1) for t in some[22:44]]
    rows += [(100 + k, t, "fr", None, 1) for k, t in enumerate(some[44:])] + [(100, some[44], "fr", None, 1)] * 30
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    refs = quality.fit_references(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert sorted(refs.classes) == ["de", "en", "fr"]
    assert difference(queries.op10_quality_rules(spark, str(tmp_path)), con, queries.OP10_SQL) is None


def test_languages_without_a_reference_are_judged_by_the_base_rules(spark, tmp_path):
    """300 languages have a reference, more than go through the driver; one has too few texts, one is null."""
    rng = random.Random(10)
    rows = []
    for k in range(300):
        own = [rng.choice("abcdefghij") + str(k % 7) for _ in range(6)]
        rows += [(None, " ".join(rng.choice(own) + rng.choice("xyz") for _ in range(52)), f"l{k}", None, 1) for _ in range(20)]
    rows += [(k, " ".join(rng.choice(["zz", "yy", "xx"]) + str(rng.randrange(99)) for _ in range(60)), lang, None, 1)
             for k, lang in enumerate(["few"] * 5 + [None] * 5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op10_quality_rules(spark, str(tmp_path))
    assert difference(got, con, queries.OP10_SQL) is None
    lone = got.where("doc_id < 10").collect()
    assert len(lone) == 10 and all(r.kept and r.class_distance is None for r in lone)


def test_every_language_with_enough_texts_has_its_reference(docs, spark):
    """With one language on the driver or with all, the verdicts are the same for documents of all languages with a reference."""
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice(x) + rng.choice("xyz") for _ in range(60)), x, None, 1)
            for k, x in enumerate(["abcd", "efgh", "ijkl"] * 8)]
    docs = spark.createDataFrame(rows, DOCS)
    few, many = quality.Rules(min_texts=5, max_languages=1), quality.Rules(min_texts=5)
    one, all_three = quality.fit_references(docs, few), quality.fit_references(docs, many)
    assert (len(one.classes), one.more.count()) == (1, 2) and len(all_three.classes) == 3 and all_three.more is None
    want = sorted(quality.judge(docs, all_three, many).collect())
    assert all(r.kept for r in want) and sorted(quality.judge(docs, one, few).collect()) == want
    assert sorted(quality.keep(docs, one, few).collect()) == sorted(docs.collect())


def test_every_training_document_gives_a_gradient(docs):
    s = recurrent_lm.Settings()
    own = docs.where(~recurrent_lm.held_out(docs.doc_id))
    want = sum(len((r.text or "").encode().split()) + 1 for r in own.collect())
    symbols = recurrent_lm.Symbols([b"the", b"of", b"and"], [3, 2, 1], 1, 1, s.classes)
    assert recurrent_lm._trained(docs, symbols, s)[1] == want


def small_model():
    s = recurrent_lm.Settings(vocabulary=12, classes=5, hidden=4)
    sym = recurrent_lm.Symbols([bytes([97 + k]) for k in range(12)], list(range(24, 0, -2)), 30, 9, s.classes)
    return recurrent_lm.Model(sym, s)


def test_gradient_matches_differences():
    m = small_model()
    m.flat[:] = np.random.default_rng(0).standard_normal(len(m.flat)) * 0.5
    rng = np.random.default_rng(2)
    before, targets = rng.integers(0, 14, (5, 3)), rng.integers(0, 14, (5, 3))
    fresh = rng.random((5, 3)) < 0.2
    h = rng.standard_normal((3, 4)).astype(np.float32)
    grad, _, _ = m.train_window(before, targets, fresh, h)
    base = m.flat.astype(np.float64)
    for k in rng.choice(len(base), 60, replace=False):
        loss = []
        for d in (1e-2, -1e-2):
            m.flat[:] = base
            m.flat[k] += d
            loss.append(m.train_window(before, targets, fresh, h)[2])
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(grad[k], abs=2e-3)
    m.flat[:] = base


def test_symbols_sum_to_one_and_state_is_carried():
    m = small_model()
    m.flat[:] = np.random.default_rng(0).standard_normal(len(m.flat)) * 0.5
    state = np.random.default_rng(3).standard_normal((1, 4)).astype(np.float32)
    logs = [m.output(state, np.array([k]))[0][0] for k in range(14)]
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    docs = [np.random.default_rng(k).integers(0, 14, n) for k, n in enumerate((200, 3, 1, 77))]
    whole = recurrent_lm.log_likelihoods(m, docs, window=64)
    assert np.allclose(whole, recurrent_lm.log_likelihoods(m, docs, window=5), atol=1e-3)
    for d, x in zip(docs, whole):
        assert recurrent_lm.log_likelihoods(m, [d])[0] == pytest.approx(x, abs=1e-3)
    assert hashlib.sha256(m.flat.tobytes()).hexdigest()
