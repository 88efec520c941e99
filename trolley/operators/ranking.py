"""Second-stage ranking and batch slates."""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first
from trolley.operators.features import FEATURE_COLUMNS, SOURCES
from trolley.operators.split import customer_holdout
from trolley.session import stage, use_checkpoints

MISSING = -1.0
TREES, DEPTH, LEARNING_RATE, HOLDOUT_PERCENT = 400, 6, 0.05, 15
#: Trees without a lower hold-out error after which the fit ends.
PATIENCE = 40
#: Bound of the labelled rows of a fit.
MAX_ROWS = 2_000_000


def linear_score(weights: dict[str, float]) -> Column:
    """Weighted sum of features, nulls as 0: a transparent stand-in for a trained model."""
    return sum(
        (F.lit(float(w)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name, w in weights.items()),
        F.lit(0.0),
    )


def rank_candidates(scored: DataFrame, k: int, score: str = "score") -> DataFrame:
    """Top-k slate per customer by score."""
    return best_first(scored, ["customer_id"], k, score)


def _assembled(frame: DataFrame, features: list[str]) -> DataFrame:
    """Trees here take no nulls: the model input gets -1, the frame itself keeps its nulls."""
    filled = frame.withColumns({
        f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in features
    })
    assembler = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="features")
    return assembler.transform(filled).drop(*[f"_f_{c}" for c in features])


def best_prefix(errors: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Number of trees with the lowest error, and whether ``patience`` trees after it brought none lower."""
    least, kept = float("inf"), 0
    for n, error in enumerate(errors, 1):
        if error < least:
            least, kept = error, n
        elif n - kept >= patience:
            return kept, True
    return kept, False


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees."""
    own, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    jvm, kept, weights = gateway.jvm, list(own.trees())[:n], list(own.treeWeights())[:n]
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    factors = gateway.new_array(jvm.double, n)
    for k in range(n):
        trees[k], factors[k] = kept[k], float(weights[k])
    return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{own.uid()}_{n}", trees, factors))


def train_ranker(
    labelled: DataFrame,
    features: list[str] | None = None,
    trees: int = TREES,
    depth: int = DEPTH,
    learning_rate: float = LEARNING_RATE,
    holdout_percent: int = HOLDOUT_PERCENT,
    seed: int = 42,
    max_rows: int = MAX_ROWS,
    patience: int = PATIENCE,
) -> GBTClassificationModel:
    """Boosted trees on the label; whole customers are held out, and the model keeps the trees up to the lowest hold-out error.

    The fit takes ``max_rows`` labelled rows at most: beyond that, whole customers by hash, their number lowered in proportion.
    It grows a quarter of ``trees``, then half, then all of them, until ``patience`` trees in a row bring no lower error. ``trained_trees``,
    ``kept_trees`` and ``holdout_errors`` of the result say what was done.
    """
    total = labelled.count()
    if total > max_rows:
        share = F.pmod(F.xxhash64("customer_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * max_rows / total))
        labelled = labelled.filter(share)
    features = features or [c for c in FEATURE_COLUMNS if c in labelled.columns]
    held = customer_holdout(labelled, holdout_percent, seed)
    data = _assembled(held, features).select("features", F.col("label").cast("double").alias("label"), "is_holdout")
    data = stage(data, "ranker-rows")
    train, check = data.where(~F.col("is_holdout")), data.where("is_holdout")
    judged = not check.isEmpty()
    use_checkpoints(labelled.sparkSession)
    for n in sorted({max(trees // 4, 1), max(trees // 2, 1), trees}) if judged else [trees]:
        model = GBTClassifier(
            featuresCol="features", labelCol="label", maxIter=n, maxDepth=depth, stepSize=learning_rate,
            subsamplingRate=0.85, featureSubsetStrategy="0.85", minInstancesPerNode=20, seed=seed,
        ).fit(train)
        errors = model.evaluateEachIteration(check) if judged else []
        kept, ended = best_prefix(errors, patience) if judged else (n, True)
        if ended:
            break
    out = first_trees(model, kept) if 0 < kept < n else model
    out.trained_trees, out.kept_trees, out.holdout_errors = n, kept or n, list(errors)
    return out


def score_candidates(
    model: GBTClassificationModel, frame: DataFrame, features: list[str] | None = None
) -> DataFrame:
    features = features or [c for c in FEATURE_COLUMNS if c in frame.columns]
    scored = model.transform(_assembled(frame, features))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def feature_importance(model: GBTClassificationModel, spark, features: list[str] | None = None) -> DataFrame:
    """Normalised gain per feature; as many rows as features."""
    features = features or FEATURE_COLUMNS
    gain = model.featureImportances.toArray()
    gain = [*gain, *[0.0] * (len(features) - len(gain))]
    return spark.createDataFrame(
        [(name, float(g)) for name, g in zip(features, gain)], "feature string, importance double"
    ).orderBy(F.col("importance").desc(), "feature")


def contributing_sources(order: tuple[str, ...] = SOURCES) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f"in_{s}") == 1, F.lit(s)) for s in order]))


def reason_text() -> Column:
    """Short factual reason from the feature values."""
    # Wording of the reasons.
    n, days = F.col("ui_n_purchase"), F.col("ui_days_since").cast("int")
    return (
        F.when(
            (n > 0) & (F.col("ui_due_ratio") >= 1.0),
            F.concat(F.lit("You buy this regularly and it has been "), days.cast("string"), F.lit(" days")),
        )
        .when(
            n > 0,
            F.concat(
                F.lit("Purchased "), n.cast("int").cast("string"), F.lit(" time(s) before, most recently "),
                days.cast("string"), F.lit(" days ago"),
            ),
        )
        .when(F.col("uc_share") > 0.15, F.lit("Popular in a category you shop often"))
        .otherwise(F.lit("Similar to products you have bought"))
    )


def batch_slate(
    customers: DataFrame, scored: DataFrame, popularity: Column, items: DataFrame, k: int
) -> DataFrame:
    """Top-k slate of every customer: ranked candidates where there are any, the popular list else.

    ``scored`` holds the scored candidates of the customers with purchases,
    ``popularity`` is the array of (rank, item_id, score) of the popular items.
    """
    everyone = customers.select("customer_id").distinct()
    personal = rank_candidates(scored, k).select(
        "customer_id", "item_id", "rank", "score",
        F.concat_ws(",", contributing_sources()).alias("sources"),
        F.lit(False).alias("cold_start"),
    ).join(everyone, "customer_id", "left_semi")
    cold = (
        everyone.join(scored.select("customer_id").distinct(), "customer_id", "left_anti")
        .select("customer_id", popularity.alias("slate"))
        .select("customer_id", F.inline(F.slice("slate", 1, k)))
        .select(
            "customer_id", "item_id", "rank", (F.lit(float(k)) - F.col("rank")).alias("score"),
            F.lit("popularity").alias("sources"), F.lit(True).alias("cold_start"),
        )
    )
    meta = items.select("item_id", "category_name", "price")
    return personal.unionByName(cold).join(meta, "item_id", "left")
