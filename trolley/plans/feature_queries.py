"""Registered queries over the feature blocks, the candidate pool and its labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.operators import blocks, diagnostics, features, pooling
from trolley.operators.pairs import merged, pair_aggregate
from trolley.plans.common import rounded
from trolley.plans.oracle import build
from trolley.plans.setting import OrdersSetting, Setting
from trolley.session import scratch, stage
from trolley.sources import sinks

POOL_DOUBLES = tuple(f"{p}_{s}" for s in features.SOURCES for p in ("rr", "score"))
FRAME_DOUBLES = POOL_DOUBLES + (
    "ui_days_since", "ui_mean_gap", "ui_due_ratio", "ui_cart_rate", "ui_purchase_rate", "u_mean_price", "u_freq",
    "u_repeat_ratio", "uc_share", "uc_days_since", "ub_share", "i_pop", "i_n_buyers", "i_repeat_intensity",
    "i_log_price", "price_ratio", "cat_due_ratio",
)
FRAME = ["customer_id", "item_id", *features.FEATURE_COLUMNS]


def _pairs(s: Setting):
    return s.pairs(s.valid_end)


def user_item_features(spark, d):
    s = Setting(spark, d)
    return rounded(features.user_item_features(_pairs(s), s.valid_end))


def user_item_features_orders(spark, d):
    s = OrdersSetting(spark, d)
    return rounded(features.user_item_features(_pairs(s), s.valid_end))


def user_features(spark, d):
    s = Setting(spark, d)
    return rounded(features.user_features(features.user_category_totals(_pairs(s), s.items), s.valid_end))


def user_category_affinity(spark, d):
    s = Setting(spark, d)
    return rounded(features.user_category_affinity(features.user_category_totals(_pairs(s), s.items), s.valid_end))


def user_brand_affinity(spark, d):
    s = Setting(spark, d)
    return rounded(features.user_brand_affinity(_pairs(s), s.items))


def item_features(spark, d):
    s = Setting(spark, d)
    return rounded(features.item_features(_pairs(s), s.items))


def item_features_orders(spark, d):
    s = OrdersSetting(spark, d)
    return rounded(features.item_features(_pairs(s), s.items))


def candidate_pool(spark, d):
    s = Setting(spark, d)
    return rounded(s.pool(s.valid_end, s.asked))


def feature_frame(spark, d):
    s = Setting(spark, d)
    return rounded(s.feature_frame(s.valid_end, s.asked).select(*FRAME, "as_of_day"))


def attach_labels(spark, d):
    return Setting(spark, d).labelled().select("customer_id", "item_id", "n_sources", "label")


def group_sizes(spark, d):
    s = Setting(spark, d)
    return pooling.group_sizes(s.pool(s.valid_end, s.asked))


def candidate_diagnostics(spark, d):
    s = Setting(spark, d)
    labelled = pooling.attach_labels(s.pool(s.valid_end, s.asked), s.test_truth)
    return rounded(pooling.candidate_diagnostics(labelled, s.test_truth))


def feature_null_profile(spark, d):
    s = Setting(spark, d)
    frame = s.feature_frame(s.valid_end, s.asked)
    return rounded(diagnostics.feature_null_profile(frame, features.FEATURE_COLUMNS))


def feature_freshness(spark, d):
    s = Setting(spark, d)
    return diagnostics.feature_freshness(_pairs(s), s.items, s.valid_end)


def ordered_frame(spark, d):
    """Place of each row within its customer in the ordered frame, as a ranker's groups need it."""
    s = Setting(spark, d)
    frame = pooling.ordered_frame(s.labelled().select("customer_id", "item_id", "label"))
    # the frame is in order within its partitions, which a running number keeps
    placed = frame.withColumn("at", F.monotonically_increasing_id())
    first = placed.groupBy("customer_id").agg(F.min("at").alias("first"))
    return placed.join(first, "customer_id").select("customer_id", "item_id", "label", (F.col("at") - F.col("first")).alias("place"))


def feature_backfill(spark, d):
    """Two days written, the second one again: every day is there exactly once."""
    s = Setting(spark, d)
    path = scratch(spark, "features")
    first, second = (s.feature_frame(day, s.asked).select(*FRAME, "as_of_day") for day in s.days)
    second = stage(second, "day")
    for frame in (first, second, second):
        sinks.write_features(frame, path)
    return rounded(spark.read.parquet(path).select(*FRAME, "as_of_day"))


def feature_write_quality(spark, d):
    """Rows, latest day and nulls per column of a block, as the write that stored it saw them."""
    s = Setting(spark, d)
    block = features.user_item_features(_pairs(s), s.valid_end).withColumn("as_of_day", F.lit(s.valid_end))
    found = sinks.write_observed(block, scratch(spark, "features"))
    return spark.createDataFrame(sorted(found.items()), "metric string, value bigint")


def bucketed_feature_frame(spark, d):
    """The feature frame from blocks that were written in buckets and stay where they are."""
    s = Setting(spark, d)
    pairs = _pairs(s)
    kept = blocks.BucketedBlocks(scratch(spark, "blocks"), blocks.buckets_for(pairs.count()))
    kept.write(features.FeatureStore.from_pairs(pairs, s.items, s.valid_end))
    pool = stage(s.pool(s.valid_end, s.asked), "pool")
    return rounded(blocks.transform(kept.read(spark, s.valid_end), pool).select(*FRAME, "as_of_day"))


def incremental_days(spark, d):
    """The state of ten days ago, moved on day by day, each time with the rows of one day only."""
    s = Setting(spark, d)
    state = s.pairs(s.valid_end - 10)
    for day in range(s.valid_end - 9, s.valid_end + 1):
        rows = s.log(as_of_day=day, after_day=day - 1)
        state = stage(merged([state, pair_aggregate(rows, day)], day), "state")
    return rounded(state.select(*STATE))


STATE = ["customer_id", "item_id", "n_events", "last_day", "first_day", "n_purchase", "n_cart", "n_view", "qty", "units", "last_purchase",
         "first_purchase", "popular_w", "repeat_w", "implicit_w", "as_of_day"]
_AGE = "exp(-ln(2.0) * (d - day) / {})"
_ORD_UI = build("SELECT * FROM blk_ui", past="ohist", aod="SELECT valid_end AS d FROM olim",
                digits=("ui_mean_gap", "ui_due_ratio", "ui_cart_rate", "ui_purchase_rate"))
_FRAME_SQL = ", ".join(f'"{c}"' for c in FRAME)

_BLOCK = ("customer_id", "item_id", "ui_n_events", "ui_last_day", "ui_n_purchase", "ui_n_cart", "ui_n_view", "ui_qty", "ui_days_since",
          "ui_mean_gap", "ui_due_ratio", "ui_cart_rate", "ui_purchase_rate", "as_of_day")

QUERIES = {
    "feature_write_quality": (feature_write_quality, build(
        "SELECT unnest([{}]) AS metric, unnest([{}]) AS value FROM (SELECT blk_ui.*, aod.d AS as_of_day FROM blk_ui, aod)".format(
            ", ".join(["'rows'", "'latest_day'", *(f"'nulls_{c}'" for c in _BLOCK)]),
            ", ".join(["count(*)", "CAST(max(as_of_day) AS BIGINT)", *(f"count(*) FILTER ({c} IS NULL)" for c in _BLOCK)])), past="hist")),
    "user_item_features": (user_item_features, build(
        "SELECT * FROM blk_ui", past="hist", digits=("ui_mean_gap", "ui_due_ratio", "ui_cart_rate", "ui_purchase_rate"))),
    "user_item_features_orders": (user_item_features_orders, _ORD_UI),
    "user_features": (user_features, build(
        "SELECT * FROM blk_u", past="hist", digits=("u_mean_price", "u_max_price", "u_freq", "u_repeat_ratio"))),
    "user_category_affinity": (user_category_affinity, build(
        "SELECT * FROM blk_uc", past="hist", digits=("uc_share",))),
    "user_brand_affinity": (user_brand_affinity, build("SELECT * FROM blk_ub", past="hist", digits=("ub_share",))),
    "item_features": (item_features, build(
        "SELECT * FROM blk_i", past="hist",
        digits=("price", "i_pop", "i_n_buyers", "i_repeat_intensity", "i_log_price"))),
    "item_features_orders": (item_features_orders, build(
        "SELECT * FROM blk_i", past="ohist", aod="SELECT valid_end AS d FROM olim",
        digits=("price", "i_pop", "i_n_buyers", "i_repeat_intensity", "i_log_price"))),
    "candidate_pool": (candidate_pool, build("SELECT * FROM pool", past="hist", digits=POOL_DOUBLES)),
    "feature_frame": (feature_frame, build(
        f"SELECT {_FRAME_SQL}, as_of_day FROM ff", past="hist", digits=FRAME_DOUBLES)),
    "bucketed_feature_frame": (bucketed_feature_frame, build(
        f"SELECT {_FRAME_SQL}, as_of_day FROM ff", past="hist", digits=FRAME_DOUBLES)),
    "attach_labels": (attach_labels, build(
        "SELECT customer_id, item_id, n_sources, label FROM labelled", past="hist")),
    "group_sizes": (group_sizes, build(
        "SELECT customer_id, count(*) AS n_candidates FROM pool GROUP BY 1", past="hist")),
    "candidate_diagnostics": (candidate_diagnostics, build("""
SELECT CAST(sum(n) AS BIGINT) AS rows, count(n) AS customers, sum(n)::DOUBLE / count(n) AS candidates_per_customer,
  sum(coalesce(found, 0))::DOUBLE / sum(n) AS positive_rate,
  count(*) FILTER (found > 0)::DOUBLE / count(n) AS customer_coverage,
  avg(coalesce(found, 0)::DOUBLE / n_truth) AS recall_ceiling
FROM (SELECT customer_id, count(*) AS n_truth FROM truth GROUP BY 1) a FULL JOIN (
  SELECT p.customer_id, count(*) AS n, count(t.item_id) AS found
  FROM pool p LEFT JOIN truth t ON t.customer_id = p.customer_id AND t.item_id = p.item_id GROUP BY 1) b
  ON b.customer_id = a.customer_id""", past="hist",
        digits=("candidates_per_customer", "positive_rate", "customer_coverage", "recall_ceiling"))),
    "feature_null_profile": (feature_null_profile, build(" UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) AS null_share FROM ff"
        for c in features.FEATURE_COLUMNS), past="hist", digits=("null_share",))),
    "feature_freshness": (feature_freshness, build("""
SELECT block, latest_day, d - latest_day AS age_days FROM aod, (
  SELECT 'user_item' AS block, max(day) AS latest_day FROM past
  UNION ALL SELECT unnest(['user', 'user_category', 'user_brand']), max(day) FROM hp
  UNION ALL SELECT 'item', max(day) FROM hp WHERE item_id IN (SELECT item_id FROM cat))""", past="hist")),
    "ordered_frame": (ordered_frame, build("""
SELECT customer_id, item_id, label, row_number() OVER (PARTITION BY customer_id ORDER BY item_id) - 1 AS place
FROM labelled""", past="hist")),
    "incremental_days": (incremental_days, build(f"""
SELECT customer_id, item_id, count(*) AS n_events, max(day) AS last_day, min(day) AS first_day, count(*) FILTER (event_type = 2) AS n_purchase,
  count(*) FILTER (event_type = 1) AS n_cart, count(*) FILTER (event_type = 0) AS n_view, CAST(sum(quantity) AS BIGINT) AS qty,
  CAST(sum(quantity) FILTER (event_type = 2) AS BIGINT) AS units, max(day) FILTER (event_type = 2) AS last_purchase,
  min(day) FILTER (event_type = 2) AS first_purchase, sum({_AGE.format(21.0)}) FILTER (event_type = 2) AS popular_w,
  sum({_AGE.format(30.0)}) FILTER (event_type = 2) AS repeat_w,
  sum(CASE event_type WHEN 0 THEN 0.3 WHEN 1 THEN 1.0 ELSE 3.0 END * {_AGE.format(30.0)}) AS implicit_w, any_value(d) AS as_of_day
FROM past, aod GROUP BY 1, 2""", past="hist", digits=("popular_w", "repeat_w", "implicit_w"))),
    "feature_backfill": (feature_backfill, "SELECT * FROM ({}) UNION ALL SELECT * FROM ({})".format(
        build(f"SELECT {_FRAME_SQL}, as_of_day FROM ff", past="train", aod="SELECT train_end AS d FROM lim",
              digits=FRAME_DOUBLES),
        build(f"SELECT {_FRAME_SQL}, as_of_day FROM ff", past="hist", digits=FRAME_DOUBLES))),
}
