"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that two engines can be compared by value."""
    return df.withColumns({
        name: F.round(F.col(f"`{name}`"), digits) for name, kind in df.dtypes if kind == "double"
    })


def joined_text(df: DataFrame, *columns: str, sep: str = ",") -> DataFrame:
    """Array columns as one string, a form that does not depend on the engine."""
    return df.withColumns({c: F.concat_ws(sep, F.transform(c, lambda x: x.cast("string"))) for c in columns})
