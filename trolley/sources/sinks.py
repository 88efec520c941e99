"""Sinks: feature partitions, canonical log, reports, scored frame, audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Columns of the audit record.
AUDIT_SCHEMA = """request_id string, timestamp double, provider string, model string, prompt_version string,
prompt_hash string, latency_ms double, input_tokens bigint, output_tokens bigint, cache_read_tokens bigint,
cost_usd double, grounded boolean, ungrounded_ids array<string>, truncated boolean"""


def write_interactions(interactions: DataFrame, path: str) -> None:
    """Canonical log partitioned by day; rewriting a day replaces that day only.

    Rows are dealt to their day by a rebalance, which adaptive execution splits
    by size: a busy day gets as many writers as it fills, a quiet one is one file.
    """
    (
        interactions.hint("rebalance", F.col("day"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )


def write_features(frame: DataFrame, path: str) -> None:
    """Idempotent write: a rerun replaces exactly the ``as_of_day`` partitions it holds."""
    (
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of_day").parquet(path)
    )


def write_observed(frame: DataFrame, path: str, name: str = "features") -> dict[str, int | None]:
    """As ``write_features``; returns rows, latest_day and the nulls of each column, gathered by the write itself without another pass.

    A frame without rows has None as its latest day and no nulls.
    """
    seen = Observation(name)
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in frame.columns]
    write_features(frame.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("as_of_day").alias("latest_day"), *nulls), path)
    return seen.get


def write_scored(frame: DataFrame, path: str) -> None:
    """The columns that the diagnostics read back."""
    keep = [c for c in frame.columns if c.startswith("in_")]
    frame.select("customer_id", "item_id", "label", "score", *keep, "ui_n_purchase").write.mode(
        "overwrite"
    ).parquet(path)


def write_report(report: DataFrame, path: str, kind: str = "csv") -> None:
    """Reports have a few rows, so one file."""
    writer = report.coalesce(1).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown report kind {kind}")


def append_audit(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).json(path)
