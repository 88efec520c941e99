"""Best phrases against counting everything."""

import collections
import random
import re

import numpy as np
import pytest
from compare import difference

from trolley.llm import collocations as phrases
from trolley.llm.queries import OP12_SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, bundle bigint, word string, a bigint"


def brute(rows, least, most):
    """Every phrase of every language by its score."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for n in range(1, 5):
                counts[lang or "und" if lang != "" else ""].update(tuple(w[i: i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.defaultdict(int)
        for p, a in good.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i: i + size]] = max(inside[p[i: i + size]], a)
        found = []
        for p, a in good.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside[p] < 80 * a:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n, -score) for r, (score, a, p, x, y) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(9)
    words = ["The", "of", "and", "new", "York", "city", "state", "é", "naïve", "x1", "--", "z", "Y"]
    rows = []
    for k in range(160):
        parts = []
        for _ in range(rng.randrange(0, 60)):
            parts.append(rng.choice(["New York city", "state of the art", "new York", "AND, of", "é naïve", rng.choice(words), rng.choice(words) + rng.choice(".;:!?\n")]))
        rows.append((k, rng.choice([" ", "  ", "\t"]).join(parts), ["en", "de", None, "fr"][min(k % 6, 3)], 1, "w", 2))
    rows += [(200, None, "en", 1, "w", 2), (201, "", None, 1, "w", 2), (202, " \t\n.", "xx", 1, "w", 2), rows[3], rows[3], (None, rows[4][1], "de", 1, "w", 2),
             (None, None, None, None, None, None), (203, "again and " * 3000, "", 1, "w", 2), (204, "a" * 50_000 + " b", "en", 1, "w", 2)]
    return rows


@pytest.mark.parametrize("most,first", [(6, 1), (2000, 2)])
def test_phrases_equal_counting_everything(spark, prose, most, first):
    # small bundles, and goals that are met in later rounds only
    s = phrases.Settings(least=4, per_language=most, first=first, wider=2, bundle_words=400, bundle_bytes=900, bits_per_prefix=1, least_bits=15, most_bits=16)
    got = sorted(tuple(r) for r in phrases.mine(spark.createDataFrame(prose, SCHEMA).repartition(3), s).collect())
    want = brute([(t, lang) for _, t, lang, *_ in prose], 4, most)
    assert got == want and len({r[0] for r in got}) == 5 and len(got) > 20


def test_phrases_equal_sql(spark, prose):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in prose])
    assert difference(phrases.mine(spark.createDataFrame(prose, SCHEMA)), con, OP12_SQL) is None


def test_no_rows(spark):
    none = phrases.mine(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.mine(spark.createDataFrame([(1, "one two", "en", 1, "", 1)], SCHEMA)).count() == 0


def test_scores_beyond_64_bits(spark):
    # 2000000 * a passes 2^63; the quotients differ in the last place of a double
    rows = [(9_007_199_254_740_993, 9_007_199_254_740_993, 9_007_199_254_740_995), (7_000_000_000_001, 7_000_000_000_001, 7_000_000_000_003)]
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    from pyspark.sql import functions as F

    got = [x[0] for x in df.select(phrases.exact_score(F.col("a"), F.col("l") + F.col("r"))).collect()]
    assert got == [2_000_000 * a // (x + y) for a, x, y in rows]


def test_bounds_hold():
    rng = np.random.default_rng(2)
    for _ in range(300):
        f, c, a, r = sorted(int(x) for x in rng.integers(1, 1000, 4))[::-1]
        # a phrase of a occurrences under a prefix of c under a first word of f
        r = max(r, a)
        assert 2_000_000 * a // (f + r) <= 2_000_000 * c // (f + c)
