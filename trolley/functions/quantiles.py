"""Exact order statistics without bringing a column into one task.

Spark's ``percentile`` keeps every distinct value of a group in the memory of
one task. Here a mergeable sketch brackets every wanted rank and the values are
counted. A second sketch inside each bracket cuts it into up to ``PARTS`` parts, and
only the parts that hold a wanted rank are sorted. The result is exact for any
cuts; the sketches only decide how much has to be sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BRACKET, ACCURACY, PARTS = 0.0005, 20_000, 1000


def order_statistics(
    df: DataFrame, groups: list[str], value: str, ranks: dict[str, tuple[float, str]]
) -> DataFrame:
    """One row per group with the values at the wanted 0-based ranks.

    ``ranks`` maps an output name to the approximate fraction of the rank and
    to an SQL expression over ``n``, the number of non-null values of the
    group, e.g. ``{"p50": (0.5, "n div 2")}``.
    """
    g = groups
    src = df.filter(F.col(value).isNotNull()).select(*g, F.col(value).alias("_v"))
    near = sorted({
        min(max(p + side, 0.0), 1.0) for p, _ in ranks.values() for side in (-BRACKET, BRACKET)
    })
    cuts = src.groupBy(*g).agg(F.percentile_approx("_v", near, ACCURACY).alias("_cuts"))
    hist = src.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # without groups the cuts are one value for all rows, not the side of a join
    cut = hist.join(cuts, g) if g else hist.withColumn("_cuts", cuts.scalar())
    binned = cut.select(
        *g, "_v", "_n", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_b")
    )
    # at most one row per cut from here on
    totals = binned.groupBy(*g, "_b").agg(F.sum("_n").alias("_bn"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *g, "_b", "_bn",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_before"),
        F.sum("_bn").over(Window.partitionBy(*g)).alias("n"),
    )
    wanted = (
        totals.withColumn(
            "_w", F.explode(F.array(*[
                F.struct(F.lit(name).alias("name"), F.expr(e).cast("long").alias("rank"))
                for name, (_, e) in ranks.items()
            ]))
        )
        .filter((F.col("_w.rank") >= F.col("_before")) & (F.col("_w.rank") < F.col("_before") + F.col("_bn")))
        .groupBy(*g, "_b", "_before", "n")
        .agg(F.collect_list("_w").alias("_wanted"))  # at most len(ranks) entries
    )
    inside = binned.join(wanted, [*g, "_b"])
    fine = inside.groupBy(*g, "_b").agg(
        F.percentile_approx("_v", [i / PARTS for i in range(1, PARTS)], ACCURACY).alias("_fine")
    )
    inside = inside.join(fine, [*g, "_b"]).withColumn(
        "_s", F.size(F.filter("_fine", lambda c: c < F.col("_v")))
    ).drop("_fine")
    # at most PARTS rows per bracket
    earlier = Window.partitionBy(*g, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    parts = inside.groupBy(*g, "_b", "_s").agg(F.sum("_n").alias("_sn")).withColumn(
        "_sbefore", F.coalesce(F.sum("_sn").over(earlier), F.lit(0))
    )
    inside = inside.join(parts, [*g, "_b", "_s"]).withColumn("_before", F.col("_before") + F.col("_sbefore")).filter(
        F.exists("_wanted", lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_sn")))
    )
    running = Window.partitionBy(*g, "_b", "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        inside
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(running))
        .withColumn("_w", F.explode(F.filter(
            "_wanted", lambda w: (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_n"))
        )))
    )
    out = hit.groupBy(*g, "n").agg(*[
        F.max(F.when(F.col("_w.name") == name, F.col("_v"))).alias(name) for name in ranks
    ])
    return out


def exact_percentiles(
    df: DataFrame, groups: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group."""
    ranks = {}
    for name, p in probs.items():
        ranks[f"_lo_{name}"] = (p, f"floor({p!r}D * (n - 1))")
        ranks[f"_hi_{name}"] = (p, f"ceil({p!r}D * (n - 1))")
    at = order_statistics(df, groups, value, ranks)
    cols = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return at.select(*groups, "n", *cols)
