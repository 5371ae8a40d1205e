"""Time features from epoch seconds: timestamp, hour, weekday, weekend flag, cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from .composite import FeatureExtractor

TIME_COLUMNS = ["timestamp", "hour", "day_of_week", "is_weekend",
                "hour_sin", "hour_cos", "day_sin", "day_cos"]


def timestamp_from(df: DataFrame, col: str = "ts") -> F.Column:
    dt = df.schema[col].dataType
    if isinstance(dt, TimestampType):
        return F.col(col)
    if isinstance(dt, TimestampNTZType):
        return F.col(col).cast("timestamp")
    # epoch seconds; text that is not a number gives a null timestamp
    return F.timestamp_seconds(F.col(col).try_cast("double"))


def time_parts(ts: F.Column) -> dict[str, F.Column]:
    hour = F.hour(ts)
    dow = F.weekday(ts)                           # Monday = 0
    two_pi = 2 * math.pi
    return {
        "hour": hour,
        "day_of_week": dow,
        "is_weekend": F.coalesce(dow.isin(5, 6), F.lit(False)).cast("int"),
        "hour_sin": F.sin(F.lit(two_pi) * hour / F.lit(24.0)),
        "hour_cos": F.cos(F.lit(two_pi) * hour / F.lit(24.0)),
        "day_sin": F.sin(F.lit(two_pi) * dow / F.lit(7.0)),
        "day_cos": F.cos(F.lit(two_pi) * dow / F.lit(7.0)),
    }


class TimeBasedFeatures(FeatureExtractor):
    name = "time_based"

    def __init__(self, ts_col: str = "ts"):
        self.ts_col = ts_col

    def extract_features(self, df: DataFrame) -> DataFrame:
        if self.ts_col not in df.columns:
            return df
        keep = [c for c in df.columns if c not in TIME_COLUMNS]
        t = df.select(*keep, timestamp_from(df, self.ts_col).alias("timestamp"))
        parts = time_parts(F.col("timestamp"))
        return t.select("*", *[e.alias(k) for k, e in parts.items()])
