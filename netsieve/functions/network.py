"""Traffic features: totals, ratios, rates, protocol dummies, numeric zero-fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, NumericType, StringType

from .composite import FeatureExtractor

# Columns coerced to numbers when they arrive as text.
COERCED = ["orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "duration"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def proto_vocabulary(df: DataFrame, col: str = "proto") -> list[str]:
    """Sorted distinct non-null protocol values (one small aggregate job)."""
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().collect()
    return sorted(r[0] for r in rows)


def fill_zero(c, dtype) -> "F.Column":
    if dtype.typeName() in ("double", "float"):
        return F.coalesce(F.nanvl(c, F.lit(None).cast(dtype)), F.lit(0).cast(dtype))
    return F.coalesce(c, F.lit(0).cast(dtype))


class NetworkTrafficFeatures(FeatureExtractor):
    """total_bytes, bytes_ratio, total_pkts, pkts_ratio, bytes_per_sec, pkts_per_sec,
    proto_<value> dummies, then null/NaN -> 0 in numeric columns.

    ``fill_zero=True`` is the reference behaviour (every numeric column, raw ones
    included); ``False`` fills only the derived columns so later imputation still sees
    the raw nulls.  ``proto_vocabulary`` fixes the dummy set (else one distinct pass).
    """

    name = "network_traffic"

    def __init__(self, fill_zero: bool = True, proto_vocabulary: list[str] | None = None):
        self.fill_zero = fill_zero
        self.vocab = proto_vocabulary

    def per_file(self) -> "NetworkTrafficFeatures":
        return self if self.vocab is not None else NetworkTrafficFeatures(self.fill_zero, [])

    def across_files(self, df: DataFrame) -> DataFrame:
        """The protocol dummies over the values of all files."""
        if self.vocab is not None or "proto" not in df.columns:
            return df
        return df.select("*", *[F.col("proto").eqNullSafe(F.lit(v)).cast("int").alias(f"proto_{v}") for v in proto_vocabulary(df)])

    def extract_features(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        types = {f.name: f.dataType for f in df.schema.fields}
        base = {c: F.col(c) for c in cols}
        for c in COERCED:
            if c in cols and isinstance(types[c], StringType):
                base[c] = F.col(c).try_cast("double")
        derived: dict[str, F.Column] = {}
        if "orig_bytes" in cols and "resp_bytes" in cols:
            derived["total_bytes"] = base["orig_bytes"] + base["resp_bytes"]
            derived["bytes_ratio"] = F.try_divide(base["orig_bytes"], base["resp_bytes"] + F.lit(1))
        if "orig_pkts" in cols and "resp_pkts" in cols:
            derived["total_pkts"] = base["orig_pkts"] + base["resp_pkts"]
            derived["pkts_ratio"] = F.try_divide(base["orig_pkts"], base["resp_pkts"] + F.lit(1))
        if "duration" in cols:
            safe = F.nullif(base["duration"], F.lit(0))
            if "total_bytes" in derived:
                derived["bytes_per_sec"] = F.try_divide(derived["total_bytes"], safe)
            if "total_pkts" in derived:
                derived["pkts_per_sec"] = F.try_divide(derived["total_pkts"], safe)
        if "proto" in cols:
            vocab = self.vocab if self.vocab is not None else proto_vocabulary(df)
            for v in vocab:
                derived[f"proto_{v}"] = F.col("proto").eqNullSafe(F.lit(v)).cast("int")
        out = []
        for c in cols:
            if c in derived:          # a re-run replaces an existing derived column
                continue
            coerced = c in COERCED and isinstance(types[c], StringType)
            dt = DoubleType() if coerced else types[c]
            e = base[c]
            if self.fill_zero and isinstance(dt, NumericType):
                e = fill_zero(e, dt)
            out.append(e.alias(c))
        for name, e in derived.items():
            if not name.startswith("proto_"):
                e = fill_zero(e.cast("double"), DoubleType())
            out.append(e.alias(name))
        return df.select(*out)
