"""Class-label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values (must equal the reference's): label spellings -> canonical class.
LABEL_MAPPING = {
    "malicious": "malicious",
    "benign": "benign",
    "normal": "benign",
    "anomaly": "malicious",
    "attack": "malicious",
}
# File-name keywords.  Label precedence: benign, malicious, then the
# first attack keyword in this order; inventory category precedence: malicious, benign.
NAME_LABELS = ["benign", "malicious"]
NAME_ATTACKS = ["botnet", "c&c", "ddos", "scan"]
UNKNOWN = "unknown"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def label_normalize(col="label") -> Column:
    """Lower-case, map known spellings to a class, pass others through, null -> 'unknown'."""
    c = _c(col)
    low = F.lower(c)
    e = F.when(c.isNull(), F.lit(UNKNOWN))
    for k, v in LABEL_MAPPING.items():
        if k != v:
            e = e.when(low == F.lit(k), F.lit(v))
    return e.otherwise(low)


def label_from_filename(name_col) -> Column:
    """Label for a file without a label column, from its (case-insensitive) name."""
    low = F.lower(_c(name_col))
    e = None
    for kw in NAME_LABELS + NAME_ATTACKS:
        cond = low.contains(kw)
        e = F.when(cond, F.lit(kw)) if e is None else e.when(cond, F.lit(kw))
    return e.otherwise(F.lit(UNKNOWN))


def category_from_filename(name_col) -> Column:
    """Inventory category: 'malicious' tested first, then 'benign', else 'unknown'."""
    low = F.lower(_c(name_col))
    return (F.when(low.contains("malicious"), F.lit("malicious"))
            .when(low.contains("benign"), F.lit("benign"))
            .otherwise(F.lit(UNKNOWN)))
