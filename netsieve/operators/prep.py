"""Fitted preprocessing: impute (median / mode), scale (population std), one-hot, label index.

Statistics are computed by a handful of distributed aggregates; only the fitted state
(a few numbers per column, the category and label lists) reaches the driver.  Transform
is pure column expressions plus Spark ML's StringIndexer/OneHotEncoder/VectorAssembler,
so it runs inside whole-stage codegen on every partition.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from ..functions.coerce import duration_seconds, inf_to_zero
from ..functions.labels import label_normalize
from ..session import scratch_dir
from .rank import BROADCAST_ROWS, positional_index, released, running_sums, track

UNKNOWN = "unknown"
PARTS = ("numeric", "categorical", "labels")
LIST_CATEGORIES = 10_000    # categories of a column that the driver holds as a list
BRACKET = 5e-4              # half width of the percentile bracket, as a share of the rows
ACCURACY = 10_000           # percentile_approx: rank error 1e-4, inside the bracket


# ------------------------------------------------------------------ column selection

def select_features(df: DataFrame, target: str, categorical=None, numerical=None):
    """(numeric columns, categorical columns): given lists filtered to present columns, or
    inferred by type (numbers; text), target removed.  Booleans are categorical only when
    listed explicitly, as in the reference."""
    cols = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    if categorical is None:
        categorical = [c for c in cols if isinstance(types[c], StringType)]
    if numerical is None:
        numerical = [c for c in cols if isinstance(types[c], NumericType)]
    categorical = [c for c in categorical if c in cols and c != target]
    numerical = [c for c in numerical if c in cols and c != target]
    return numerical, categorical


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is null; if that would leave nothing, keep every row and
    fill the target with 'unknown' instead.  The emptiness test is one cheap probe."""
    kept = df.where(F.col(target).isNotNull())
    if kept.limit(1).count() == 0:
        return df.withColumn(target, F.coalesce(F.col(target), F.lit(UNKNOWN)))
    return kept


# ------------------------------------------------------------------ statistics

def _is_missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if dt.typeName() in ("double", "float"):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column, n_null) for columns with at least one null/NaN; one aggregate pass."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in cols])
    long = agg.unpivot([], cols, "column_name", "n_null")
    return long.where(F.col("n_null") > 0)


def null_count_dict(df: DataFrame, cols) -> dict[str, int]:
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def medians(df: DataFrame, cols, exact: bool = True, accuracy: int = 1_000_000) -> DataFrame:
    """(column, median) over non-null, non-NaN values; the mean of the two middle values
    for an even count.  ``exact=False``: percentile_approx.

    Exact: approximate percentiles bracket the middle of each column and the values below
    the bracket are counted, so only the values inside it (a thousandth of the rows) are
    counted per (column, value), partially aggregated map-side, and ordered: running counts
    over them (range-partitioned, skew-safe; see rank.running_sums) locate the middle
    position(s); the value v holds positions (cum - count, cum]."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, median double")
    if not exact:
        aggs = [F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]
        return df.agg(*aggs).unpivot([], cols, "column_name", "median").where(F.col("median").isNotNull())
    base = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    # percentiles bracket the middle; values outside the brackets are only counted
    sketch = base.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, [0.5 - BRACKET, 0.5 + BRACKET], ACCURACY)
                                 .alias("p")).alias(c) for c in cols]).first()
    known = {c: (sketch[c]["n"], *sketch[c]["p"]) for c in cols if sketch[c]["n"]}
    if not known:
        return df.sparkSession.createDataFrame([], "column_name string, median double")
    below = base.agg(*[F.count_if(F.col(c) < lo).alias(c) for c, (_, lo, _) in known.items()]).first()
    inside = [F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, (_, lo, hi) in known.items()]
    long = base.select(*inside).unpivot([], list(known), "column_name", "v").where("v is not null")
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts, ["v"], ["_c"], ["column_name"], n_groups=len(known), prefix="_cum")

    def fixed(values):
        return F.element_at(F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(v).cast("long"))]), F.col("column_name"))

    upto = F.col("_cum_c") + fixed({c: below[c] for c in known})
    before, n = upto - F.col("_c"), fixed({c: k for c, (k, _, _) in known.items()})

    def holds(k):
        return (before < k) & (k <= upto)

    mid = cum.where(holds(F.floor((n + 1) / 2)) | holds(F.floor(n / 2) + 1))
    return mid.groupBy("column_name").agg(F.avg("v").alias("median"))


def modes(df: DataFrame, cols) -> DataFrame:
    """(column, mode, n): most frequent non-null value as text, ties to the smallest.
    Counts are partially aggregated map-side, so a hot value never sits on one task."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, mode string, n long")
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "column_name", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("mode"),
        F.max("n").alias("n"))


def scaler_stats(df: DataFrame, cols) -> DataFrame:
    """(column, mean, std, divisor): population std; divisor 1 where std is 0."""
    cols = list(cols)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}")]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(f"m__{c}").alias("mean"),
                      F.col(f"s__{c}").alias("std")) for c in cols]
    long = row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    return long.withColumn("divisor", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def vocabulary(df: DataFrame, cols) -> DataFrame:
    """(column, category, idx): sorted distinct values per column, idx from 0.

    Numbers come from the range-partitioned positional index, so a column with a category
    per row (an id) is numbered like any other and stays distributed."""
    cols = list(cols)
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "column_name", "category").distinct())
    ranked = positional_index(long, ["category"], ["column_name"], n_groups=len(cols), pos_col="_vpos")
    return ranked.select("column_name", "category", (F.col("_vpos") - 1).cast("int").alias("idx"))


def label_index(df: DataFrame, target: str) -> DataFrame:
    """(label, idx): sorted distinct labels, numbered from 0 without a one-task sort."""
    labels = df.select(F.col(target).alias("label")).where("label is not null").distinct()
    return positional_index(labels, ["label"], pos_col="_p").select("label", (F.col("_p") - 1).cast("int").alias("idx"))


def label_classes(df: DataFrame, target: str) -> list[str]:
    return sorted(r[0] for r in df.select(target).distinct().collect() if r[0] is not None)


# ------------------------------------------------------------------ fitted state

@dataclass
class PrepState:
    target: str
    numeric: list
    categorical: list
    bool_cols: list = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    divisors: dict = field(default_factory=dict)
    vocab: dict = field(default_factory=dict)
    # column -> {"path", "n"}: numbered categories of a column with more than LIST_CATEGORIES
    # of them, a table that stays distributed
    tables: dict = field(default_factory=dict)
    labels: list = field(default_factory=list)
    handle_unknown: str = "ignore"

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "PrepState":
        return cls(**json.loads(text))


def normalise_inputs(df: DataFrame, target: str | None) -> DataFrame:
    """Target normalised (null -> 'unknown'); duration text -> seconds."""
    cols = []
    for f in df.schema.fields:
        c = f.name
        if target is not None and c == target:
            cols.append(label_normalize(c).alias(c))
        elif c == "duration" and isinstance(f.dataType, StringType):
            cols.append(duration_seconds(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def impute_exprs(df: DataFrame, st: PrepState) -> dict:
    """Column -> imputed expression (stored median/mode, else 0 / 'unknown')."""
    out = {}
    for c in st.numeric:
        if c in df.columns:
            fill = float(st.medians.get(c, 0.0))
            col = F.col(c).cast("double")
            out[c] = F.coalesce(F.nanvl(col, F.lit(None).cast("double")), F.lit(fill))
    for c in st.categorical:
        if c in df.columns:
            fill = st.modes.get(c, UNKNOWN)
            out[c] = F.coalesce(F.col(c).cast("string"), F.lit(str(fill)))
    return out


def scale_exprs(st: PrepState, imputed: dict) -> dict:
    return {c: (inf_to_zero(imputed[c]) - F.lit(float(st.means.get(c, 0.0))))
            / F.lit(float(st.divisors.get(c, 1.0))) for c in st.numeric if c in imputed}


def onehot_columns(st: PrepState, imputed: dict) -> list:
    """Column form: one 0/1 DOUBLE per (column, known category); unknown -> all zero."""
    _listed(st, "the column form")
    out = []
    for c in st.categorical:
        if c not in imputed:
            continue
        for v in st.vocab.get(c, []):
            out.append((imputed[c] == F.lit(v)).cast("double").alias(f"{c}_{v}"))
    return out


def label_index_expr(st: PrepState, col: str) -> F.Column:
    """Label -> index in the fitted (sorted) class list; unseen -> -1."""
    if not st.labels:
        return F.lit(-1.0)
    m = F.create_map(*[x for i, l in enumerate(st.labels) for x in (F.lit(l), F.lit(float(i)))])
    return F.coalesce(F.try_element_at(m, F.col(col)), F.lit(-1.0))


def _listed(st: PrepState, what: str) -> None:
    if st.tables:
        raise ValueError(f"{what} needs a name per category; {sorted(st.tables)} have more than {LIST_CATEGORIES}: "
                         "use the vector form, feature_table() and onehot_long()")


def feature_names(st: PrepState) -> list[str]:
    _listed(st, "a list of feature names")
    return list(st.numeric) + [f"{c}_{v}" for c in st.categorical for v in st.vocab.get(c, [])]


class Preprocessor:
    """fit(train) -> PreprocessorModel; the model transforms train, val and test alike."""

    def __init__(self, target: str = "label", categorical=None, numerical=None,
                 drop_na: bool = False, handle_unknown: str = "ignore", exact_median: bool = True):
        if handle_unknown not in ("ignore", "error"):
            raise ValueError(f"handle_unknown must be 'ignore' or 'error', not {handle_unknown!r}")
        self.target = target
        self.categorical = categorical
        self.numerical = numerical
        self.drop_na = drop_na
        self.handle_unknown = handle_unknown
        self.exact_median = exact_median

    def fit(self, df: DataFrame, parts=PARTS) -> "PreprocessorModel":
        """Fit what ``parts`` names: "numeric" (medians, scaler), "categorical" (modes, vocabularies),
        "labels".  The model knows the columns of those parts only; no statistic of the others is
        computed and their columns are not read."""
        if unknown := set(parts) - set(PARTS):
            raise ValueError(f"unknown parts {sorted(unknown)}; known: {PARTS}")
        if self.target not in df.columns:
            raise ValueError(f"target column {self.target!r} not found")
        d = df
        if self.drop_na:
            d = drop_null_target(d, self.target)
        d = normalise_inputs(d, self.target)
        num, cat = select_features(d, self.target, self.categorical, self.numerical)
        num, cat = (num if "numeric" in parts else []), (cat if "categorical" in parts else [])
        bools = [c for c in cat if isinstance(d.schema[c].dataType, BooleanType)]
        st = PrepState(self.target, num, cat, bools, handle_unknown=self.handle_unknown)
        with released():
            # the source is read once: every statistic below reads this pruned copy
            d = track(d.select(*num, *cat, self.target))
            nulls = null_count_dict(d, num + cat)
            med_cols = [c for c in num if nulls.get(c, 0) > 0]
            mode_cols = [c for c in cat if nulls.get(c, 0) > 0]
            st.medians = {c: 0.0 for c in med_cols}
            st.medians.update({r["column_name"]: float(r["median"])
                               for r in medians(d, med_cols, self.exact_median).collect()})
            st.modes = {c: ("false" if c in bools else UNKNOWN) for c in mode_cols}
            st.modes.update({r["column_name"]: r["mode"] for r in modes(d, mode_cols).collect()})
            imp = impute_exprs(d, st)
            filled = d.select(*[imp[c].alias(c) for c in num + cat], F.col(self.target))
            if num:
                clean = filled.select(*[inf_to_zero(c).alias(c) for c in num])
                for r in scaler_stats(clean, num).collect():
                    st.means[r["column_name"]] = float(r["mean"]) if r["mean"] is not None else 0.0
                    st.divisors[r["column_name"]] = float(r["divisor"]) if r["divisor"] is not None else 1.0
            # small vocabularies are model state on the driver; large ones are numbered by
            # range partitions and written, and encoding joins them
            st.vocab = {c: [] for c in cat}
            if cat:
                long = track(filled.select(*cat).unpivot([], cat, "column_name", "category").distinct())
                sizes = {r[0]: r[1] for r in long.groupBy("column_name").count().collect()}
                large = [c for c in cat if sizes.get(c, 0) > LIST_CATEGORIES]
                for r in long.where(~F.col("column_name").isin(large)).collect():
                    st.vocab[r["column_name"]].append(r["category"])
                st.vocab = {c: sorted(v) for c, v in st.vocab.items() if c not in large}
                for c in large:
                    path = scratch_dir(df.sparkSession, "vocabulary")
                    vocabulary(filled, [c]).select("category", "idx").write.parquet(path)
                    st.tables[c] = {"path": path, "n": sizes[c]}
            if "labels" in parts:
                st.labels = label_classes(filled, self.target)
        return PreprocessorModel(st)


class PreprocessorModel:
    def __init__(self, state: PrepState):
        self.state = state

    # column-level pieces, usable on their own
    def imputed(self, df: DataFrame) -> DataFrame:
        d = normalise_inputs(df, self.state.target if self.state.target in df.columns else None)
        imp = impute_exprs(d, self.state)
        return d.select(*[imp[c].alias(c) if c in imp else F.col(c) for c in d.columns])

    def scaled_columns(self, df: DataFrame) -> DataFrame:
        d = normalise_inputs(df, self.state.target if self.state.target in df.columns else None)
        sc = scale_exprs(self.state, impute_exprs(d, self.state))
        return d.select(*[sc[c].alias(c) if c in sc else F.col(c) for c in d.columns])

    def onehot_frame(self, df: DataFrame, keep=()) -> DataFrame:
        d = normalise_inputs(df, None)
        return d.select(*keep, *onehot_columns(self.state, impute_exprs(d, self.state)))

    def feature_names(self) -> list[str]:
        return feature_names(self.state)

    def feature_table(self, spark) -> DataFrame:
        """``position, column_name, category, name`` of every element of the features vector, however many
        there are (category null for a number); the names of :meth:`feature_names` in a table."""
        st, at = self.state, len(self.state.numeric)
        out = spark.createDataFrame([(i, c, None, c) for i, c in enumerate(st.numeric)], "position long, column_name string, category string, name string")
        listed = []
        for c in st.categorical:
            if c in st.tables:
                voc = spark.read.parquet(st.tables[c]["path"])
                out = out.unionByName(voc.select((F.col("idx") + at).cast("long").alias("position"), F.lit(c).alias("column_name"), "category",
                                                 F.concat(F.lit(f"{c}_"), "category").alias("name")))
                at += st.tables[c]["n"]
            else:
                listed += [(at + i, c, v, f"{c}_{v}") for i, v in enumerate(st.vocab.get(c, []))]
                at += len(st.vocab.get(c, []))
        return out.unionByName(spark.createDataFrame(listed, out.schema))

    def onehot_long(self, df: DataFrame, keep=()) -> DataFrame:
        """``keep`` columns, ``position, name, value``: the cells of the one-hot columns that are 1, a row a
        cell, whatever the number of categories (an unseen one has no row)."""
        d = normalise_inputs(df, None)
        imp = impute_exprs(d, self.state)
        cat = [c for c in self.state.categorical if c in imp]
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), imp[c].alias("category")) for c in cat])
        cells = d.select(*keep, F.explode(pairs).alias("cell")).select(*keep, F.col("cell.column_name").alias("c_name"), F.col("cell.category").alias("c_cat"))
        names = self.feature_table(df.sparkSession).where(F.col("category").isNotNull())
        n = sum(len(v) for v in self.state.vocab.values()) + sum(v["n"] for v in self.state.tables.values())
        names = F.broadcast(names) if n <= BROADCAST_ROWS else names
        return (cells.join(names, (F.col("c_name") == F.col("column_name")) & (F.col("c_cat") == F.col("category")))
                .select(*keep, "position", "name", F.lit(1.0).alias("value")))

    def transform(self, df: DataFrame, keep=(), features_col: str = "features",
                  label_col: str = "label_idx") -> DataFrame:
        """Assembled output: ``keep`` columns, ``features`` vector (scaled numerics, then
        one-hot blocks), ``label_idx`` (DOUBLE; -1 for an unseen class)."""
        st = self.state
        has_target = st.target in df.columns
        d = normalise_inputs(df, st.target if has_target else None)
        imp = impute_exprs(d, st)
        sc = scale_exprs(st, imp)
        num = [c for c in st.numeric if c in sc]
        cat = [c for c in st.categorical if c in imp]
        cols = [F.col(k) for k in keep]
        cols += [sc[c].alias(f"__n_{c}") for c in num]
        cols += [imp[c].alias(f"__c_{c}") for c in cat]
        if has_target:
            cols.append(label_index_expr(st, st.target).alias(label_col))
        t = d.select(*cols)
        vec_inputs = [f"__n_{c}" for c in num]
        if cat:
            invalid = "keep" if st.handle_unknown == "ignore" else "error"
            # one indexer per column: the multi-column factory pads unequal label lists
            for c in cat:
                if c in st.tables:
                    t = self._joined_index(t, c)
                    continue
                t = StringIndexerModel.from_labels(
                    st.vocab[c], inputCol=f"__c_{c}", outputCol=f"__i_{c}",
                    handleInvalid=invalid).transform(t)
            enc = OneHotEncoder(inputCols=[f"__i_{c}" for c in cat],
                                outputCols=[f"__o_{c}" for c in cat], dropLast=st.handle_unknown == "ignore").fit(t)
            t = enc.transform(t)
            vec_inputs += [f"__o_{c}" for c in cat]
        if vec_inputs:
            t = VectorAssembler(inputCols=vec_inputs, outputCol=features_col).transform(t)
        out = [F.col(k) for k in keep] + ([F.col(features_col)] if vec_inputs else [])
        if has_target:
            out.append(F.col(label_col))
        return t.select(*out)

    def _joined_index(self, t: DataFrame, c: str) -> DataFrame:
        """``__i_<c>`` from the written vocabulary; an unseen category gets the number behind
        the last, which the encoder drops (or is an error)."""
        path, n = self.state.tables[c]["path"], self.state.tables[c]["n"]
        voc = t.sparkSession.read.parquet(path).select(F.col("category").alias("__k"), F.col("idx").alias("__x"))
        voc = F.broadcast(voc) if n <= BROADCAST_ROWS else voc
        unseen = F.lit(n) if self.state.handle_unknown == "ignore" else F.raise_error(
            F.concat(F.lit(f"unseen category in {c}: "), F.col(f"__c_{c}"))).cast("int")
        size = n + (self.state.handle_unknown == "ignore")
        meta = {"ml_attr": {"type": "nominal", "num_vals": size, "name": f"__i_{c}"}}
        j = t.join(voc, F.col(f"__c_{c}") == F.col("__k"), "left")
        idx = F.when(F.col("__x").isNotNull(), F.col("__x")).otherwise(unseen).cast("double")
        return j.select(*t.columns, idx.alias(f"__i_{c}", metadata=meta))

    def save(self, path: str, spark) -> None:
        for c, v in self.state.tables.items():           # the saved model owns its vocabularies
            own = f"{path.rstrip('/')}_vocabulary/{c}"
            if v["path"] != own:
                spark.read.parquet(v["path"]).write.mode("overwrite").parquet(own)
                v["path"] = own
        spark.createDataFrame([(self.state.to_json(),)], "state string").coalesce(1) \
            .write.mode("overwrite").json(path)

    @classmethod
    def load(cls, path: str, spark) -> "PreprocessorModel":
        return cls(PrepState.from_json(spark.read.json(path).first()["state"]))


# ------------------------------------------------------------------ dummies (get_dummies form)

def dummies(df: DataFrame, cols, keep=()) -> DataFrame:
    """0/1 INT column ``<col>_<value>`` per distinct non-null value seen in ``df``
    (vocabulary from one distinct pass per call)."""
    cols = list(cols)
    vocab = (vocabulary(df.select(*cols).na.drop("all"), cols).where(F.col("category").isNotNull())
             .orderBy("column_name", "category").collect()) if cols else []
    out = [F.col(k) for k in keep]
    for r in vocab:
        c, v = r["column_name"], r["category"]
        out.append(F.col(c).cast("string").eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}"))
    return df.select(*out)


def align_dummies(df: DataFrame, expected, keep=()) -> DataFrame:
    """Force dummy columns onto the training list: absent -> 0, unexpected dropped."""
    have = set(df.columns)
    return df.select(*[F.col(k) for k in keep],
                     *[(F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)) if n in have
                        else F.lit(0.0)).alias(n) for n in expected])
