import math
from collections import defaultdict

import pytest

from trolley.operators import sequences


def by_customer(log):
    out = defaultdict(list)
    for c, i, day, kind, _, seq in log:
        if kind == 2:
            out[c].append((day, seq, i))
    return {c: sorted(rows) for c, rows in out.items()}


def expected(log, price, pad, length):
    rows = []
    for c, seq in by_customer(log).items():
        for t in range(1, len(seq)):
            past = [s[2] for s in seq[:t]]
            rows.append((
                c, seq[t][2], seq[t][0], [pad] * (length - len(past[-length:])) + past[-length:], min(t, length),
                math.log1p(t), float(seq[t][0] - seq[t - 1][0]), math.log1p(sum(price[i] for i in past) / t),
                math.log1p(seq[t][0] - seq[0][0]), len(set(past)) / t,
            ))
    return rows


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_sequences_do_not_depend_on_the_chunks(interactions, items, log, block):
    """Chunks of one row, of a few rows and of whole days give the plain per-customer result."""
    price = {r["item_id"]: r["price"] for r in items.collect()}
    got = [tuple(r) for r in sequences.causal_sequences(interactions, items, 99, 5, seq_block=block).collect()]
    want = expected(log, price, 99, 5)

    def key(r):
        return (r[0], r[5], r[1])

    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:])


def test_inference_state(spark, interactions, items, log):
    asked = spark.createDataFrame([(0,), (5,), (777,)], "customer_id int")
    got = {r["customer_id"]: r for r in sequences.inference_state(interactions, items, asked, 99, 5).collect()}
    assert got[777]["history"] == [99] * 5 and got[777]["history_len"] == 0 and got[777]["log_n_prior"] == 0.0
    seq = by_customer(log)[0]
    assert got[0]["history"] == [s[2] for s in seq[-5:]]
    assert got[0]["log_n_prior"] == pytest.approx(math.log1p(len(seq)))
    assert got[0]["log_days_active"] == pytest.approx(math.log1p(seq[-1][0] - seq[0][0]))
    assert got[0]["days_since_last"] == max(r[2] for r in log) - seq[-1][0]


def test_log_q_covers_unseen_items(spark, items):
    targets = spark.createDataFrame([(0,), (0,), (1,)], "target int")
    got = {r["item_id"]: r["log_q"] for r in sequences.log_q(targets, items).collect()}
    assert got[0] == pytest.approx(math.log(2 / 3)) and got[9] == pytest.approx(math.log(1e-10))
    assert len(got) == 32
