"""Catalog: fitted statistics and fitted transforms (2.5)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import fixtures
from ..functions import label_normalize
from ..operators import prep
from ..operators.split import split_time
from .catalog import register
from .defaults import CATEGORICAL, NUMERICAL
from .q_features import NORM_SQL

F1 = ("flows",)
RAW_NUM = [c for c in NUMERICAL if c in (
    "id_orig_p", "id_resp_p", "duration", "orig_bytes", "resp_bytes", "missed_bytes", "orig_pkts",
    "orig_ip_bytes", "resp_pkts", "resp_ip_bytes")]
MEDIAN_COLS = ["duration", "orig_bytes"]            # the numeric flows columns holding nulls
MODE_COLS = ["service", "local_orig", "history"]     # the categorical ones


def _flows(spark, sf):
    return fixtures.flows(spark, sf)


def fitted(spark, sf, parts=prep.PARTS, source=None):
    """Preprocessor fitted on flows with the default column lists."""
    df = source if source is not None else _flows(spark, sf)
    return prep.Preprocessor("label", CATEGORICAL, NUMERICAL).fit(df, parts)


# ---- DuckDB text shared by the oracles -------------------------------------------------

def _mode_sql(c):
    v = f"cast({c} as varchar)"
    return (f"(select {v} from flows where {c} is not null group by {v} "
            f"order by count(*) desc, {v} asc limit 1)")


def _imp_cte(stats: str = "flows", keep: str = "uid, label") -> str:
    """CTE ``imp``: flows imputed with the medians and modes of table ``stats``."""
    num = [f"cast(coalesce({c}, (select median({c}) from {stats})) as double) as {c}" if c in MEDIAN_COLS
           else f"cast({c} as double) as {c}" for c in RAW_NUM]
    cat = [f"coalesce(cast({c} as varchar), {_mode_sql(c).replace('from flows', 'from ' + stats)}) as {c}" if c in MODE_COLS
           else f"cast({c} as varchar) as {c}" for c in CATEGORICAL]
    return f"imp as (select {keep}, " + ", ".join(num + cat) + " from flows)"


IMP_CTE = _imp_cte()
# fixture vocabulary, as the fit finds it (sorted distinct values after imputation)
VOCAB = {"proto": ["icmp", "tcp", "udp"], "service": ["-", "dns", "http"],
         "conn_state": ["REJ", "S0", "SF"], "local_orig": ["false", "true"],
         "local_resp": ["false", "true"], "history": ["S", "ShAdDaFf", "Sr"]}


# ---------------------------------------------------------------- fit_* statistics

@register("fit_median", " union all ".join(
    f"select '{c}' as column_name, median({c}) as median from flows" for c in MEDIAN_COLS), F1)
def q_fit_median(spark, sf):
    """Exact median of each numeric column holding nulls (positional, skew-safe)."""
    f = _flows(spark, sf)
    nulls = prep.null_count_dict(f, RAW_NUM)
    return prep.medians(f, [c for c in RAW_NUM if nulls[c] > 0])


@register("fit_mode", " union all ".join(
    f"select '{c}' as column_name, {_mode_sql(c)} as mode" for c in MODE_COLS), F1)
def q_fit_mode(spark, sf):
    """Most frequent value of each category column holding nulls, ties to the smallest."""
    f = _flows(spark, sf)
    nulls = prep.null_count_dict(f, CATEGORICAL)
    return prep.modes(f, [c for c in CATEGORICAL if nulls[c] > 0]).select("column_name", "mode")


@register("fit_scaler", "with " + IMP_CTE + " " + " union all ".join(
    f"select '{c}' as column_name, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as std, "
    f"round(case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end, 6) as divisor from imp"
    for c in RAW_NUM), F1)
def q_fit_scaler(spark, sf):
    """Mean and population std per numeric column after imputation; divisor 1 for std 0."""
    m = fitted(spark, sf)
    imp = m.imputed(_flows(spark, sf))
    s = prep.scaler_stats(imp.select(*[prep.inf_to_zero(c).alias(c) for c in m.state.numeric]),
                          m.state.numeric)
    return s.select("column_name", *[F.round(c, 6).alias(c) for c in ("mean", "std", "divisor")])


@register("fit_vocabulary", "with " + IMP_CTE + " select column_name, category, "
          "cast(row_number() over (partition by column_name order by category) - 1 as int) as idx "
          "from (" + " union ".join(f"select '{c}' as column_name, {c} as category from imp"
                                    for c in CATEGORICAL) + ") t", F1)
def q_fit_vocabulary(spark, sf):
    """Sorted distinct categories per column after imputation."""
    f = _flows(spark, sf)
    st = prep.PrepState("label", [], CATEGORICAL, modes={r["column_name"]: r["mode"] for r in prep.modes(f, CATEGORICAL).collect()})
    return prep.vocabulary(prep.PreprocessorModel(st).imputed(f), CATEGORICAL)


@register("fit_label_index", f"select label, cast(row_number() over (order by label) - 1 as int) as idx "
          f"from (select distinct {NORM_SQL} as label from flows) t", F1)
def q_fit_label_index(spark, sf):
    """Sorted distinct normalised labels -> 0..k-1."""
    return prep.label_index(_flows(spark, sf).select(label_normalize("label").alias("label")), "label")


# ---------------------------------------------------------------- transforms

@register("prep_impute", "with " + IMP_CTE + " select uid, " + ", ".join(RAW_NUM + CATEGORICAL)
          + " from imp", F1)
def q_prep_impute(spark, sf):
    """Numerics filled with the fitted median, categories with the fitted mode."""
    m = fitted(spark, sf)
    return m.imputed(_flows(spark, sf)).select("uid", *RAW_NUM, *CATEGORICAL)


@register("prep_scale", "with " + IMP_CTE + " select uid, " + ", ".join(
    f"round(({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1 "
    f"else stddev_pop({c}) over () end, 6) as {c}" for c in RAW_NUM) + " from imp", F1)
def q_prep_scale(spark, sf):
    """(x - mean) / std with the fitted statistics."""
    m = fitted(spark, sf, ["numeric"])
    return m.scaled_columns(_flows(spark, sf)).select("uid", *[F.round(c, 6).alias(c) for c in RAW_NUM])


def _onehot_sql_cols(vocab):
    return ", ".join(f"cast({c} = '{v}' as double) as \"{c}_{v}\"" for c in CATEGORICAL for v in vocab[c])


@register("prep_onehot", "with " + IMP_CTE + " select uid, " + _onehot_sql_cols(VOCAB) + " from imp", F1)
def q_prep_onehot(spark, sf):
    """One 0/1 column per fitted category (column form of the encoder)."""
    m = fitted(spark, sf, ["categorical"])
    return m.onehot_frame(_flows(spark, sf), keep=["uid"])


_ALIGN_SQL = ("select uid, " + ", ".join(
    (f"cast(proto = '{v}' as double)" if c == "proto" else
     f"cast(conn_state = '{v}' as double)" if c == "conn_state" else "cast(0 as double)")
    + f" as \"{c}_{v}\"" for c in CATEGORICAL for v in VOCAB[c]) + " from flows_signal")


@register("prep_onehot_align", _ALIGN_SQL, ("flows_signal",))
def q_prep_onehot_align(spark, sf):
    """Dummies of a frame lacking some category columns, forced onto the training list."""
    m = fitted(spark, sf)
    sig = fixtures.flows_signal(spark, sf)
    d = prep.dummies(sig, [c for c in CATEGORICAL if c in sig.columns], keep=["uid"])
    return prep.align_dummies(d, [n for n in m.feature_names() if n not in m.state.numeric], keep=["uid"])


@register("prep_label_index", f"""
with cls as (select label as cls, row_number() over (order by label) - 1 as idx
             from (select distinct label from flows_signal) c)
select uid, label, cast(coalesce(idx, -1) as double) as label_idx
from (select uid, {NORM_SQL} as label from flows) t left join cls on t.label = cls.cls""", ("flows_signal",))
def q_prep_label_index(spark, sf):
    """Labels indexed with classes fitted elsewhere (flows_signal); unseen -> -1."""
    classes = prep.label_classes(fixtures.flows_signal(spark, sf), "label")
    st = prep.PrepState("label", [], [], labels=classes)
    f = _flows(spark, sf).select("uid", label_normalize("label").alias("label"))
    return f.select("uid", "label", prep.label_index_expr(st, "label").alias("label_idx"))


@register("prep_feature_names", "with " + IMP_CTE + ", num(pos, name) as (values " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(RAW_NUM)) + "), cat as (" + " union ".join(
    f"select {j} as col_order, '{c}' as column_name, {c} as category from imp"
    for j, c in enumerate(CATEGORICAL)) + ") select cast(pos as int) as position, name as feature_name "
    f"from num union all select cast({len(RAW_NUM)} + row_number() over (order by col_order, category) - 1 "
    "as int) as position, column_name || '_' || category as feature_name from cat", F1)
def q_prep_feature_names(spark, sf):
    """Names in vector order: numerics, then <column>_<category>."""
    names = fitted(spark, sf).feature_names()
    return spark.createDataFrame(list(enumerate(names)), "position int, feature_name string")


def _vector_sql(fit: str) -> str:
    """The assembled features of table ``imp``, scaled with the statistics of table ``fit``."""
    num = [f"({c} - (select avg({c}) from {fit})) / (select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from {fit})"
           for c in RAW_NUM]
    hot = [f"cast({c} = '{v}' as double)" for c in CATEGORICAL for v in VOCAB[c]]
    return "[" + ", ".join([f"round({e}, 6) + 0.0" for e in num] + hot) + "]::double[]"


_LABEL_IDX = (f"cls as (select label as cls, row_number() over (order by label) - 1 as idx from "
              f"(select distinct {NORM_SQL} as label from {{}}) c)")


def _rounded(col="features"):
    return F.transform(vector_to_array(col), lambda x: F.round(x, 6) + F.lit(0.0))


@register("prep_assemble", "with " + IMP_CTE + ", " + _LABEL_IDX.format("flows") + ", n as (select *, " + NORM_SQL + " as norm from imp) "
          "select uid, " + _vector_sql("imp") + " as features, cast(idx as double) as label_idx from n join cls on norm = cls", F1)
def q_prep_assemble(spark, sf):
    """Scaled numeric block then one-hot block, as one vector (shown as an array)."""
    m = fitted(spark, sf)
    t = m.transform(_flows(spark, sf), keep=["uid"])
    return t.select("uid", _rounded().alias("features"), "label_idx")


_SPLIT_SQL = ("ranked as (select *, row_number() over (order by ts asc nulls last, uid) as pos, count(*) over () as n from flows), "
              "starts as (select *, cast(floor(cast(n as double) * (1 - cast(0.15 as double))) as bigint) as test_start from ranked), "
              "parts as (select *, case when pos <= cast(floor(cast(test_start as double) * (1 - cast(0.15 as double))) as bigint) "
              "then 'train' when pos <= test_start then 'val' else 'test' end as split from starts), "
              "train as (select * from parts where split = 'train')")


@register("prep_fit_transform", "with " + _SPLIT_SQL + ", " + _imp_cte("train").replace("from flows)", "from parts)").replace(
          "select uid, label,", "select uid, label, split,") + ", fit as (select * from imp where split = 'train'), "
          + _LABEL_IDX.format("train") + ", n as (select *, " + NORM_SQL + " as norm from imp) "
          "select uid, split, " + _vector_sql("fit") + " as features, cast(coalesce(idx, -1) as double) as label_idx "
          "from n left join cls on norm = cls", F1)
def q_prep_fit_transform(spark, sf):
    """Fit on the train part of a time split, transform train/val/test with that state."""
    f = _flows(spark, sf)
    parts = split_time(f, "ts", tiebreak="uid")
    train = parts.where(F.col("split") == "train").drop("split")
    m = prep.Preprocessor("label", CATEGORICAL, NUMERICAL).fit(train)
    out = m.transform(parts, keep=["uid", "split"])
    return out.select("uid", "split", _rounded().alias("features"), "label_idx")
