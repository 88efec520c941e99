"""Registered queries over the log, its split and the model inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.operators import diagnostics, joins, metrics, sequences, split
from trolley.plans.common import joined_text, rounded
from trolley.plans.oracle import build
from trolley.plans.setting import OrdersSetting, Setting
from trolley.session import scratch, stage
from trolley.sources import sinks, tables

SEQ_COLS = ("log_n_prior", "days_since_last", "log_mean_price", "log_days_active", "distinct_ratio")


def load_events_cut(spark, d):
    """Writes the canonical log by day, then reads it back up to the end of the train window."""
    s = Setting(spark, d)
    path = scratch(spark, "log")
    sinks.write_interactions(s.log(), path)
    return tables.load_events(spark, path, s.train_end).select(
        "customer_id", "item_id", "day", "event_type", "quantity", "event_seq"
    )


def catalog_canonical(spark, d):
    return tables.catalog(spark, d)


def customers_canonical(spark, d):
    return tables.customers(spark, d)


def event_revenue(spark, d):
    s = Setting(spark, d)
    return rounded(tables.with_revenue(s.log(), s.items).select("event_seq", "customer_id", "item_id", "revenue"))


def event_profile(spark, d):
    s = Setting(spark, d)
    last_day = s.valid_end + split.TEST_DAYS
    return rounded(diagnostics.event_profile(s.pairs(last_day), s.items))


def purchases_only(spark, d):
    return split.purchases_only(Setting(spark, d).log())


def temporal_split(spark, d):
    s = Setting(spark, d)
    return s.log().select("event_seq", "day", split.split_window(*s.days).alias("window"))


def eligible_customers(spark, d):
    return Setting(spark, d).eligible


def ground_truth(spark, d):
    return Setting(spark, d).truth()


def split_summary(spark, d):
    s = Setting(spark, d)
    return split.split_summary(s.log(), *s.days)


def basket_size_stats(spark, d):
    return rounded(split.basket_size_stats(Setting(spark, d).truth()))


def customer_holdout(spark, d):
    return split.customer_holdout(tables.customers(spark, d).select("customer_id"))


def salted_join(spark, d):
    """Events joined with the per-item purchase totals, a join on a skewed key."""
    s = Setting(spark, d)
    totals = split.purchases_only(s.log()).groupBy("item_id").agg(F.count(F.lit(1)).alias("item_purchases"))
    return joins.salted_left_join(
        s.log().select("event_seq", "customer_id", "item_id"), totals, ["item_id"], [F.col("event_seq")]
    )


def purchase_gini(spark, d):
    return rounded(metrics.purchase_concentration(split.purchases_only(Setting(spark, d).log())))


def purchase_gini_orders(spark, d):
    return rounded(metrics.purchase_concentration(tables.purchases_from_orders(spark, d)))


def causal_sequences(spark, d):
    s = Setting(spark, d)
    return rounded(joined_text(sequences.causal_sequences(s.train, s.items, s.items.count()), "history"))


def causal_sequences_orders(spark, d):
    s = OrdersSetting(spark, d)
    rows = sequences.causal_sequences(
        s.train, s.items, s.items.count(), order=("event_seq", "part_id", "supplier_id")
    )
    return rounded(joined_text(rows, "history"))


def inference_state(spark, d):
    s = Setting(spark, d)
    state = sequences.inference_state(s.train, s.items, tables.customers(spark, d), s.items.count())
    return rounded(joined_text(state, "history"))


def log_q(spark, d):
    s = Setting(spark, d)
    return rounded(sequences.log_q(sequences.causal_sequences(s.train, s.items, s.items.count()), s.items))


def price_buckets(spark, d):
    return rounded(sequences.price_buckets(Setting(spark, d).items))


def _sequences_sql(train: str, order: str) -> str:
    order += ", uid"  # rows may agree in all the rest
    window = f"PARTITION BY customer_id ORDER BY day, {order}"
    return f"""
SELECT customer_id, item_id AS target, day,
  array_to_string(list_concat(list_transform(range(20 - len(past20)), lambda x: n_items), past20), ',') AS history,
  CAST(len(past20) AS INTEGER) AS history_len, ln(1 + t::DOUBLE) AS log_n_prior, (day - prev)::DOUBLE AS days_since_last,
  ln(1 + spent / t) AS log_mean_price, ln(1 + (day - first_day)::DOUBLE) AS log_days_active,
  n_new::DOUBLE / t AS distinct_ratio
FROM (
  SELECT *, row_number() OVER w - 1 AS t, lag(day) OVER w AS prev, first_value(day) OVER w AS first_day,
    sum(price) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent,
    sum(is_new) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_new,
    coalesce(list(item_id) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), []) AS past20
  FROM (
    SELECT e.*, coalesce(price, 0) AS price, (SELECT CAST(count(*) AS INTEGER) FROM cat) AS n_items,
      CASE WHEN row_number() OVER (PARTITION BY customer_id, e.item_id ORDER BY day, {order}) = 1 THEN 1 ELSE 0 END AS is_new
    FROM (SELECT *, row_number() OVER () AS uid FROM {train}) e LEFT JOIN cat ON cat.item_id = e.item_id WHERE event_type = 2)
  WINDOW w AS ({window}))
WHERE t >= 1"""


_GINI = """
SELECT count(*) AS items, CAST(sum(n) AS BIGINT) AS purchases,
  sum((2 * rn - total - 1) * n)::DOUBLE / (any_value(total) * sum(n)) AS gini,
  sum(n) FILTER (top <= 100)::DOUBLE / sum(n) AS top_share
FROM (SELECT n, row_number() OVER (ORDER BY n) AS rn, row_number() OVER (ORDER BY n DESC, item_id) AS top,
  count(*) OVER () AS total FROM (SELECT item_id, count(*) AS n FROM {src} WHERE event_type = 2 GROUP BY 1))"""

QUERIES = {
    "load_events_cut": (load_events_cut, build("SELECT * FROM train")),
    "catalog_canonical": (catalog_canonical, build("SELECT * FROM cat")),
    "customers_canonical": (customers_canonical, """
SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_nationkey AS home_nation_id, c_mktsegment AS segment FROM customer"""),
    "event_revenue": (event_revenue, build("""
SELECT event_seq, customer_id, ev.item_id, quantity * price AS revenue
FROM ev LEFT JOIN cat ON cat.item_id = ev.item_id""", digits=("revenue",))),
    "event_profile": (event_profile, build("""
SELECT count(*) AS events, count(*) FILTER (event_type = 0) AS views, count(*) FILTER (event_type = 1) AS carts,
  count(*) FILTER (event_type = 2) AS purchases, count(DISTINCT customer_id) AS customers,
  count(DISTINCT ev.item_id) AS items, sum(quantity * price) FILTER (event_type = 2) AS revenue,
  1.0::DOUBLE - (SELECT count(*) FROM (SELECT DISTINCT customer_id, item_id FROM ev WHERE event_type = 2))::DOUBLE
    / count(*) FILTER (event_type = 2) AS repeat_share,
  (SELECT sum(n) FROM (SELECT item_id, count(*) AS n FROM ev WHERE event_type = 2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100))::DOUBLE
    / count(*) FILTER (event_type = 2) AS top_share
FROM ev LEFT JOIN cat ON cat.item_id = ev.item_id""", digits=("revenue", "repeat_share", "top_share"))),
    "purchases_only": (purchases_only, build("SELECT * FROM ev WHERE event_type = 2")),
    "temporal_split": (temporal_split, build("""
SELECT event_seq, day, CASE WHEN day <= train_end THEN 'train' WHEN day <= valid_end THEN 'valid' ELSE 'test' END AS "window"
FROM ev, lim""")),
    "eligible_customers": (eligible_customers, build("SELECT * FROM elig")),
    "ground_truth": (ground_truth, build("SELECT * FROM truth")),
    "split_summary": (split_summary, build("""
SELECT CASE WHEN day <= train_end THEN 'train' WHEN day <= valid_end THEN 'valid' ELSE 'test' END AS "window",
  min(day) AS first_day, max(day) AS last_day, count(*) AS events, count(*) FILTER (event_type = 2) AS purchases,
  count(DISTINCT customer_id) AS customers, count(DISTINCT item_id) AS items
FROM ev, lim GROUP BY 1""")),
    "basket_size_stats": (basket_size_stats, build("""
SELECT count(*) AS customers, avg(n) AS mean_size, quantile_cont(n::DOUBLE, 0.5) AS median_size,
  quantile_cont(n::DOUBLE, 0.9) AS p90_size
FROM (SELECT customer_id, count(*) AS n FROM truth GROUP BY 1)""", digits=("mean_size", "median_size", "p90_size"))),
    "customer_holdout": (customer_holdout, """
SELECT CAST(c_custkey AS BIGINT) AS customer_id,
  (c_custkey * 48271 + 332598) % 2147483647 % 100 < 15 AS is_holdout FROM customer"""),
    "salted_join": (salted_join, build("""
SELECT event_seq, customer_id, ev.item_id, item_purchases FROM ev LEFT JOIN (
  SELECT item_id, count(*) AS item_purchases FROM ev WHERE event_type = 2 GROUP BY 1) t ON t.item_id = ev.item_id""")),
    "purchase_gini": (purchase_gini, build(_GINI.format(src="ev"), digits=("gini", "top_share"))),
    "purchase_gini_orders": (purchase_gini_orders, build(_GINI.format(src="ord"), digits=("gini", "top_share"))),
    "causal_sequences": (causal_sequences, build(_sequences_sql("train", "event_seq"), digits=SEQ_COLS)),
    "causal_sequences_orders": (
        causal_sequences_orders, build(_sequences_sql("otrain", "event_seq, part_id, supplier_id"), digits=SEQ_COLS)
    ),
    "inference_state": (inference_state, build("""
SELECT CAST(c_custkey AS BIGINT) AS customer_id,
  array_to_string(list_concat(list_transform(range(20 - len(past20)), lambda x: n_items), past20), ',') AS history,
  CAST(len(past20) AS INTEGER) AS history_len, coalesce(ln(1 + n::DOUBLE), 0.0) AS log_n_prior,
  coalesce(((SELECT max(day) FROM train) - hi)::DOUBLE, 0.0) AS days_since_last,
  coalesce(ln(1 + mean_price), 0.0) AS log_mean_price, coalesce(ln(1 + (hi - lo)::DOUBLE), 0.0) AS log_days_active,
  coalesce(n_distinct::DOUBLE / n, 0.0) AS distinct_ratio
FROM (SELECT c_custkey, coalesce(t, []) AS past20, n, hi, lo, mean_price, n_distinct,
    (SELECT CAST(count(*) AS INTEGER) FROM cat) AS n_items
  FROM customer LEFT JOIN (SELECT customer_id, list(item_id ORDER BY recency DESC) AS t FROM last20 GROUP BY 1) a
    ON a.customer_id = c_custkey
  LEFT JOIN (SELECT customer_id, count(*) AS n, max(day) AS hi, min(day) AS lo, avg(price) AS mean_price,
      count(DISTINCT hp.item_id) AS n_distinct FROM hp LEFT JOIN cat ON cat.item_id = hp.item_id GROUP BY 1) b
    ON b.customer_id = c_custkey)""", digits=SEQ_COLS)),
    "log_q": (log_q, build(f"""
SELECT c.item_id, coalesce(n, 0) AS n_targets, ln(greatest(coalesce(n, 0)::DOUBLE / total, 1e-10)) AS log_q
FROM cat c CROSS JOIN (SELECT count(*) AS total FROM ({_sequences_sql("train", "event_seq")}) q1) x
LEFT JOIN (SELECT target, count(*) AS n FROM ({_sequences_sql("train", "event_seq")}) q2 GROUP BY 1) s
  ON s.target = c.item_id""", digits=("log_q",))),
    "price_buckets": (price_buckets, build("""
SELECT item_id, category_id, brand_id, price,
  CAST(len(list_filter(edges, lambda e: e < price)) AS INTEGER) AS price_bucket
FROM cat, (SELECT list_transform(quantile_cont(price, [{}]), lambda q: round(q, 6)) AS edges FROM cat)""".format(
        ", ".join(f"{i}/20.0" for i in range(1, 20))), digits=("price",))),
}
