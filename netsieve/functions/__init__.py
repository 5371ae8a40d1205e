"""Column expressions (JVM-side, codegen-friendly) and DataFrame -> DataFrame extractors."""

from .labels import label_normalize, label_from_filename, category_from_filename
from .coerce import num_coerce, duration_seconds, inf_to_zero, bool_to_string
from .network import NetworkTrafficFeatures
from .timefeat import TimeBasedFeatures
from .composite import CompositeFeatures, FeatureExtractor

__all__ = [
    "label_normalize", "label_from_filename", "category_from_filename",
    "num_coerce", "duration_seconds", "inf_to_zero", "bool_to_string",
    "NetworkTrafficFeatures", "TimeBasedFeatures", "CompositeFeatures", "FeatureExtractor",
]
