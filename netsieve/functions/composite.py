"""Feature extractor protocol and composition.

An extractor is any object with a ``name`` and ``extract_features(df) -> df``; user
extractors subclass :class:`FeatureExtractor`.  Each built-in extractor issues a single
``select`` so plans stay flat however many features are added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


class FeatureExtractor:
    name = "identity"

    def __init__(self, name: str | None = None):
        if name:
            self.name = name

    def extract_features(self, df: DataFrame) -> DataFrame:
        return df

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.extract_features(df)

    def settings(self) -> str:
        """Text of everything that decides the output (part of a cache key)."""
        plain = {k: v for k, v in vars(self).items() if not k.startswith("_")}
        return f"{type(self).__module__}.{type(self).__qualname__}({sorted(plain.items())})"

    def per_file(self) -> "FeatureExtractor":
        """The part that looks at one row or file only, so its result can be cached."""
        return self

    def across_files(self, df: DataFrame) -> DataFrame:
        """What has to be added over all files together, after :meth:`per_file`."""
        return df


class CompositeFeatures(FeatureExtractor):
    """Extractors applied in order, each on the former's output; name joined by '_'."""

    def __init__(self, extractors):
        self.extractors = list(extractors)
        super().__init__("_".join(e.name for e in self.extractors))

    def extract_features(self, df: DataFrame) -> DataFrame:
        return reduce(lambda acc, e: acc.transform(e.extract_features), self.extractors, df)

    def settings(self) -> str:
        return "|".join(e.settings() if isinstance(e, FeatureExtractor) else repr(e) for e in self.extractors)

    def per_file(self) -> "CompositeFeatures":
        return CompositeFeatures([e.per_file() if isinstance(e, FeatureExtractor) else e for e in self.extractors])

    def across_files(self, df: DataFrame) -> DataFrame:
        for e in self.extractors:
            if isinstance(e, FeatureExtractor):
                df = e.across_files(df)
        return df
