import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n):
    common = ["the", "of", "and", "to", "in", "is", "that", "it"]
    return [rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Prose with exact and near copies, shared passages, junk, nulls, empties, a long text and repeated rows."""
    rng = random.Random(3)
    out = [" ".join(words(rng, rng.randrange(55, 120))) for _ in range(24)]
    base = words(rng, 120)
    for k in range(10):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(len(near))] = "".join(rng.choice("klmnop") for _ in range(5))
        out.append(" ".join(near))
    passage = " ".join(words(rng, 60))
    out += [" ".join(words(rng, 30)) + "\n" + passage + "\n" + " ".join(words(rng, 20)) for _ in range(4)]
    out += [out[3]] * 5 + ["Spam! " * 80, "é" * 250, "é" * 250 + "x", "##$$ " * 70, "one", "two words", "", "  \n\t ", None, None]
    out += ["x".join(words(rng, 3000)), " ".join(words(rng, 5000))]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with a repeated row, a row without id, null metadata and an extra column."""
    rows = [(i, t, ["en", "de", None][i % 3], "src0" if i % 3 else None, len(t or ""), i) for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[0], "en", "s", 1, 0), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS + ", component_id bigint").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
