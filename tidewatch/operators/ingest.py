"""Raw to bronze."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def lower_case_columns(df: DataFrame) -> DataFrame:
    twice = [c for c, n in Counter(c.lower() for c in df.columns).items() if n > 1]
    if twice:
        raise ValueError(f"columns differ by case only: {', '.join(twice)}")
    return df.toDF(*[c.lower() for c in df.columns])


def bronze_ingest(df: DataFrame, source: str, ingest_ts: datetime | Column | None = None) -> DataFrame:
    """Lower-case the columns and add ``_ingest_ts`` and ``_source``.

    The ingest time is a parameter so that a run can be repeated; by default it is now.
    """
    if ingest_ts is None:
        stamp = F.current_timestamp()
    else:
        stamp = ingest_ts if isinstance(ingest_ts, Column) else F.lit(ingest_ts)
    return lower_case_columns(df).withColumns({"_ingest_ts": stamp, "_source": F.lit(source)})


def with_event_date(df: DataFrame, ts: str = "event_time") -> DataFrame:
    return df.withColumn("event_date", F.to_date(ts))
