"""Alignment of tokens against whole texts, token by token."""

import collections
import hashlib
import json
import random

import pytest

from trolley.llm import alignment
from trolley.llm.common import raw

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id bigint, text string, lang string, digest string, n_a bigint, bundle int"
ODD = ["", " ", "  lead", "trail  ", "a  b   c", "tab\tand\nline\r\n end", "no break", "x　y", "x\u0085y z", "   ", "x ▁ y", "▁", "<|endoftext|> and <s> </s> <0x41>",
       "don't we'll I'm 's 'S", "naïve café é", "日本語 テキスト です", "emoji 🤷🏽 here", "\x00 nul \x1f", "1,234.56 -- !!??", "a" * 3000, "é" * 500 + " x", "᠎ a ​ b", "#" * 400, "İstanbul ﬁ ½"]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def brute(texts):
    """Results of every text by the two whole encodings."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    signs = alignment.byte_signs()
    with open(P.path("byte_bpe_50k.json")) as file:
        entry = {n: bytes(signs[c] for c in e) for e, n in json.load(file)["model"]["vocab"].items() if e != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def piece(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()

    rows, held = [], collections.Counter()
    for t in texts:
        x = y = []
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            want = (" " + t).encode()
            if not b"".join(entry[k] for k in x) == want == b"".join(piece(k) for k in y):
                x = y = []
        ends = [[], []]
        for side, ids, size in ((0, x, entry.__getitem__), (1, y, piece)):
            at = 0
            for k in ids:
                at += len(size(k))
                ends[side].append(at)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, start = [], [], 0
        for c in cuts:
            part = [[k for k, e in zip(ids, es) if start < e <= c] for ids, es in ((x, ends[0]), (y, ends[1]))]
            groups.append("|".join(",".join(map(str, ids)) for ids in part))
            start = c
        j = 0
        for i, k in enumerate(x):
            lo, hi = ends[0][i - 1] if i else 0, ends[0][i]
            while j and (ends[1][j - 1] > lo):
                j -= 1
            while ends[1][j] <= lo:
                j += 1
            m = j
            while m < len(y) and (ends[1][m - 1] if m else 0) < hi:
                links.append((k, y[m]))
                m += 1
        held.update(set(links))
        rows.append((len(x), len(y), groups, links))
    best = collections.Counter()
    for (k, _), n in held.items():
        best[k] = max(best[k], n)
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for n_a, n_b, groups, links in rows]


def test_chunks_encode_as_whole_texts(tokenizers):
    assert tokenizers.apart
    for t in ODD:
        chunks = tokenizers.chunks(t)
        a, b = tokenizers.encode(chunks)
        assert sum(a, []) == tokenizers.a.encode(" " + t, add_special_tokens=False).ids, t
        if t:
            assert sum(b, []) == tokenizers.b.encode(t), t


def test_alignment_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["Antidisestablishment", "of", "the", "tokenizer's", "naïve", "42nd", "é", "東京", "don't", "x", "(y)", "--"]
    texts = ODD + [" ".join(rng.choices(words, k=rng.randrange(1, 80))) for _ in range(60)] + ["the same text again"] * 40 + [None, None]
    rows = [(i, t, "en", "x", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[30], (None, texts[40], None, None, None, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # bundles of a few chunks and of a few texts
    for s in (alignment.Settings(bundle_chunks=200), alignment.Settings(bundle_texts=3), alignment.Settings()):
        got = alignment.align_documents(df, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), s).collect()
        want = collections.Counter((r[0], *x) for r, x in zip(rows, brute([r[1] for r in rows])))
        assert collections.Counter(tuple(r) for r in got) == want
    assert any(r.n_groups != r.n_a for r in got) and any(r.n_best < r.n_links for r in got)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert alignment.align_documents(none, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).count() == 0
    assert raw("text") is not None
