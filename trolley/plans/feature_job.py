"""Daily feature job (S8): events, catalog and candidates in, one ``as_of_day`` partition out.

    spark-submit -m trolley.plans.feature_job --events E --catalog C --candidates P --output O --as-of-day N [--states S [--late-from D]]

With a folder of states the job reads the newest pair aggregate before that day and the events behind it, and leaves its own there. Events
that came late for day D are taken in by going on from the newest state before D.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.features import FeatureStore
from trolley.operators.pairs import merged, pair_aggregate
from trolley.session import build_session, release, stage
from trolley.sources.sinks import write_features
from trolley.sources.tables import load_events


def run(spark: SparkSession, events: str, catalog: str, candidates: str, output: str, as_of_day: int) -> None:
    history = load_events(spark, events, as_of_day)
    # the only pass over the log: all five blocks come from this aggregate
    pairs = stage(pair_aggregate(history, as_of_day), "pairs")
    store = FeatureStore.from_pairs(pairs, spark.read.parquet(catalog), as_of_day)
    frame = store.transform(spark.read.parquet(candidates))
    write_features(frame, output)


def state_before(spark: SparkSession, states: str, day: int) -> int | None:
    """Day of the newest stored state before ``day``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(states)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    # answered from the names of the partitions
    return spark.read.parquet(states).where(F.col("as_of_day") < day).agg(F.max("as_of_day")).first()[0]


def next_state(spark: SparkSession, events: str, states: str, as_of_day: int, late_from: int | None = None) -> DataFrame:
    """The pair aggregate of ``as_of_day``, from the newest state before it (and before ``late_from``) and the days since."""
    base = state_before(spark, states, min(as_of_day, late_from if late_from is not None else as_of_day))
    history = load_events(spark, events, as_of_day)
    if base is None:
        return pair_aggregate(history, as_of_day)
    since = pair_aggregate(history.where(F.col("day") > base), as_of_day)
    old = spark.read.parquet(states).where(F.col("as_of_day") == base).select(since.columns)
    return merged([old, since], as_of_day)


def run_next(
    spark: SparkSession, events: str, catalog: str, candidates: str, output: str, states: str, as_of_day: int, late_from: int | None = None,
) -> None:
    """As ``run``, from the states; the state of the day is written first, so that a rerun or the next day finds it."""
    write_features(stage(next_state(spark, events, states, as_of_day, late_from), "pairs"), states)
    pairs = spark.read.parquet(states).where(F.col("as_of_day") == as_of_day)
    store = FeatureStore.from_pairs(pairs, spark.read.parquet(catalog), as_of_day)
    write_features(store.transform(spark.read.parquet(candidates)), output)


def main() -> None:
    parser = argparse.ArgumentParser(description="Point-in-time features of one day")
    for name in ("events", "catalog", "candidates", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--as-of-day", type=int, required=True)
    parser.add_argument("--states")
    parser.add_argument("--late-from", type=int)
    args = parser.parse_args()
    spark = build_session("feature-job")
    try:
        if args.states:
            run_next(spark, args.events, args.catalog, args.candidates, args.output, args.states, args.as_of_day, args.late_from)
        else:
            run(spark, args.events, args.catalog, args.candidates, args.output, args.as_of_day)
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()
