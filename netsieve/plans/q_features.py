"""Catalog: labels, coercion, traffic and time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import (CompositeFeatures, NetworkTrafficFeatures, TimeBasedFeatures,
                         bool_to_string, duration_seconds, inf_to_zero, label_from_filename,
                         label_normalize, num_coerce)
from ..functions.timefeat import time_parts, timestamp_from
from ..operators.prep import drop_null_target, select_features
from .catalog import register

F1 = ("flows",)
NORM_SQL = ("case when label is null then 'unknown' when lower(label) = 'normal' then 'benign' "
            "when lower(label) in ('anomaly', 'attack') then 'malicious' else lower(label) end")
DUCK_TS = "make_timestamp(cast(ts * 1000000 as bigint))"


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _flows(spark, sf):
    return fixtures.flows(spark, sf)


# ---------------------------------------------------------------- labels

@register("label_normalize", f"select uid, label as raw_label, {NORM_SQL} as label from flows", F1)
def q_label_normalize(spark, sf):
    """Raw label next to its normalised class."""
    return _flows(spark, sf).select("uid", F.col("label").alias("raw_label"),
                                    label_normalize("label").alias("label"))


# Stand-in file names (so every branch of the name rule is reached); the rule itself is general.
FILE_NAME_SQL = ("concat(case user_id % 7 when 0 then 'CTU-Benign-' when 1 then 'CTU-Malicious-' "
                 "when 2 then 'benign-MALICIOUS-' when 3 then 'Botnet-DDoS-' when 4 then 'cc-C&C-' "
                 "when 5 then 'PortScan-' else 'capture-' end, cast(user_id % 4 as {STR}), '.csv')")


@register("label_from_filename", f"""
select uid, file_name,
  case when lower(file_name) like '%benign%' then 'benign'
       when lower(file_name) like '%malicious%' then 'malicious'
       when lower(file_name) like '%botnet%' then 'botnet'
       when lower(file_name) like '%c&c%' then 'c&c'
       when lower(file_name) like '%ddos%' then 'ddos'
       when lower(file_name) like '%scan%' then 'scan'
       else 'unknown' end as label
from (select concat('C', cast(event_id as varchar)) as uid,
             {FILE_NAME_SQL.format(STR='varchar')} as file_name from events) t
""")
def q_label_from_filename(spark, sf):
    """Label of a file with no label column, from its name."""
    ev = fixtures.table(spark, sf, "events")
    src = ev.selectExpr("concat('C', cast(event_id as string)) as uid",
                        FILE_NAME_SQL.format(STR="string") + " as file_name")
    return src.select("uid", "file_name", label_from_filename("file_name").alias("label"))


# ---------------------------------------------------------------- coercion

_TEXT_COLS = ["orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "duration"]


def _text_sql(STR):
    return ", ".join(f"case when {c} is null then '-' else cast({c} as {STR}) end as {c}"
                     for c in _TEXT_COLS)


@register("num_coerce", "select uid, " + ", ".join(
    f"try_cast({c} as double) as {c}" for c in _TEXT_COLS) +
    f" from (select uid, {_text_sql('varchar')} from flows) t", F1)
def q_num_coerce(spark, sf):
    """Five text columns ('-' for missing) coerced to DOUBLE, failures to null."""
    text = _flows(spark, sf).selectExpr("uid", *_text_sql("string").split(", "))
    return text.select("uid", *[num_coerce(c).alias(c) for c in _TEXT_COLS])


DURATION_TEXT = """case event_id % 7
  when 0 then cast(value as {STR})
  when 1 then concat('0 days 00:', lpad(cast(event_id % 60 as {STR}), 2, '0'), ':',
                     lpad(cast(event_id % 47 as {STR}), 2, '0'), '.',
                     lpad(cast(event_id % 1000000 as {STR}), 6, '0'))
  when 2 then '-'
  when 3 then ''
  when 4 then null
  when 5 then concat(cast(event_id % 90 as {STR}), 'ms')
  else concat(cast(event_id % 3 as {STR}), ' days 01:02:03') end"""

_TD = r"'^\s*(?:(-?\d+)\s+days?,?\s+)?(\d{1,2}):(\d{2}):(\d{2}(?:\.\d+)?)\s*$'"


def _g(i):
    return f"try_cast(nullif(regexp_extract(d, {_TD}, {i}), '') as double)"


@register("duration_seconds", f"""
select uid, d as duration_text,
  round(case when d is null then null else coalesce(
    try_cast(d as double),
    coalesce({_g(1)}, 0) * 86400 + {_g(2)} * 3600 + {_g(3)} * 60 + {_g(4)},
    try_cast(nullif(regexp_extract(d, '([\\d.]+)', 1), '') as double),
    0) end, 6) as duration_s
from (select concat('C', cast(event_id as varchar)) as uid,
             {DURATION_TEXT.format(STR='varchar')} as d from events) t
""")
def q_duration_seconds(spark, sf):
    """Duration text (numbers, time-delta text, junk) to seconds, per cell."""
    src = fixtures.table(spark, sf, "events").selectExpr(
        "concat('C', cast(event_id as string)) as uid",
        DURATION_TEXT.format(STR="string") + " as duration_text")
    return src.select("uid", "duration_text", r6(duration_seconds("duration_text")).alias("duration_s"))


INF_SRC = ("case event_id % 50 when 0 then cast('inf' as double) when 1 then cast('-inf' as double) "
           "when 2 then cast('nan' as double) else value end")


@register("num_inf_to_zero", f"""
select uid, case when v is null or isnan(v) or isinf(v) then 0.0 else v end as value_clean
from (select concat('C', cast(event_id as varchar)) as uid, {INF_SRC} as v from events) t
""")
def q_num_inf_to_zero(spark, sf):
    """+inf, -inf, NaN -> 0 (planted every 50th row)."""
    src = fixtures.table(spark, sf, "events").selectExpr(
        "concat('C', cast(event_id as string)) as uid", f"{INF_SRC} as v")
    return src.select("uid", inf_to_zero("v").alias("value_clean"))


@register("bool_to_string", """
select uid, cast(local_orig as varchar) as local_orig, cast(local_resp as varchar) as local_resp
from flows""", F1)
def q_bool_to_string(spark, sf):
    """Boolean categories as text."""
    return _flows(spark, sf).select("uid", bool_to_string("local_orig").alias("local_orig"),
                                    bool_to_string("local_resp").alias("local_resp"))


# ---------------------------------------------------------------- traffic features

def _net(spark, sf, **kw):
    return NetworkTrafficFeatures(**kw).extract_features(_flows(spark, sf))


_FEAT_SQL = {
    "total_bytes": "coalesce(orig_bytes + resp_bytes, 0)",
    "bytes_ratio": "coalesce(orig_bytes / (resp_bytes + 1), 0)",
    "total_pkts": "coalesce(orig_pkts + resp_pkts, 0)",
    "pkts_ratio": "coalesce(orig_pkts / (resp_pkts + 1), 0)",
    "bytes_per_sec": "coalesce((orig_bytes + resp_bytes) / nullif(duration, 0), 0)",
    "pkts_per_sec": "coalesce((orig_pkts + resp_pkts) / nullif(duration, 0), 0)",
}


def _feat_query(name):
    def q(spark, sf):
        return _net(spark, sf).select("uid", r6(name).alias(name))
    q.__name__ = f"q_feat_{name}"
    q.__doc__ = f"Traffic feature {name} (null/NaN filled with 0)."
    register(f"feat_{name}", f"select uid, round({_FEAT_SQL[name]}, 6) as {name} from flows", F1)(q)


for _n in _FEAT_SQL:
    _feat_query(_n)


@register("feat_proto_dummies", """
select uid, cast(coalesce(proto = 'icmp', false) as int) as proto_icmp,
       cast(coalesce(proto = 'tcp', false) as int) as proto_tcp,
       cast(coalesce(proto = 'udp', false) as int) as proto_udp
from flows""", F1)
def q_feat_proto_dummies(spark, sf):
    """One 0/1 column per distinct protocol (vocabulary from one distinct pass)."""
    df = _net(spark, sf)
    return df.select("uid", *[c for c in df.columns if c.startswith("proto_")])


NUMERIC_RAW = ["ts", "id_orig_p", "id_resp_p", "duration", "orig_bytes", "resp_bytes", "missed_bytes",
               "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes"]


@register("feat_fill_numeric_zero", "select uid, " + ", ".join(
    f"coalesce({c}, 0) as {c}" for c in NUMERIC_RAW) + " from flows", F1)
def q_feat_fill_numeric_zero(spark, sf):
    """Null/NaN -> 0 in every numeric column (raw columns included, reference default)."""
    return _net(spark, sf).select("uid", *NUMERIC_RAW)


# ---------------------------------------------------------------- time features

@register("time_from_epoch",
          f"select uid, strftime({DUCK_TS}, '%Y-%m-%d %H:%M:%S') as timestamp_text, "
          f"cast(epoch({DUCK_TS}) as double) as epoch_s from flows", F1)
def q_time_from_epoch(spark, sf):
    """Epoch seconds -> TIMESTAMP (shown as UTC text and back as epoch)."""
    f = _flows(spark, sf)
    t = f.select("uid", timestamp_from(f, "ts").alias("timestamp"))
    return t.select("uid", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp_text"),
                    F.unix_micros("timestamp").cast("double").__truediv__(1e6).alias("epoch_s"))


@register("time_parts", f"""
select uid, cast(hour({DUCK_TS}) as int) as hour, cast(isodow({DUCK_TS}) - 1 as int) as day_of_week,
       cast(isodow({DUCK_TS}) in (6, 7) as int) as is_weekend from flows""", F1)
def q_time_parts(spark, sf):
    """hour, day_of_week (Monday = 0), is_weekend."""
    f = _flows(spark, sf)
    p = time_parts(timestamp_from(f, "ts"))
    return f.select("uid", *[p[k].alias(k) for k in ("hour", "day_of_week", "is_weekend")])


@register("time_cyclic", f"""
select uid, round(sin(2 * pi() * hour({DUCK_TS}) / 24), 6) as hour_sin,
       round(cos(2 * pi() * hour({DUCK_TS}) / 24), 6) as hour_cos,
       round(sin(2 * pi() * (isodow({DUCK_TS}) - 1) / 7), 6) as day_sin,
       round(cos(2 * pi() * (isodow({DUCK_TS}) - 1) / 7), 6) as day_cos from flows""", F1)
def q_time_cyclic(spark, sf):
    """Cyclic hour and weekday encodings."""
    f = _flows(spark, sf)
    p = time_parts(timestamp_from(f, "ts"))
    return f.select("uid", *[r6(p[k]).alias(k) for k in ("hour_sin", "hour_cos", "day_sin", "day_cos")])


COMPOSITE_OUT = (["uid", "source_file", "id_orig_h", "id_resp_h", "proto", "service", "conn_state",
                  "local_orig", "local_resp", "history", "label"] + NUMERIC_RAW
                 + list(_FEAT_SQL) + ["proto_icmp", "proto_tcp", "proto_udp", "hour", "day_of_week",
                                      "is_weekend", "hour_sin", "hour_cos", "day_sin", "day_cos"])

_COMPOSITE_SQL = ("select uid, source_file, id_orig_h, id_resp_h, proto, service, conn_state, local_orig, "
                  "local_resp, history, label, "
                  + ", ".join(f"coalesce({c}, 0) as {c}" for c in NUMERIC_RAW) + ", "
                  + ", ".join(f"round({e}, 6) as {n}" for n, e in _FEAT_SQL.items()) + ", "
                  "cast(coalesce(proto = 'icmp', false) as int) as proto_icmp, "
                  "cast(coalesce(proto = 'tcp', false) as int) as proto_tcp, "
                  "cast(coalesce(proto = 'udp', false) as int) as proto_udp, "
                  f"cast(hour({DUCK_TS}) as int) as hour, cast(isodow({DUCK_TS}) - 1 as int) as day_of_week, "
                  f"cast(isodow({DUCK_TS}) in (6, 7) as int) as is_weekend, "
                  f"round(sin(2 * pi() * hour({DUCK_TS}) / 24), 6) as hour_sin, "
                  f"round(cos(2 * pi() * hour({DUCK_TS}) / 24), 6) as hour_cos, "
                  f"round(sin(2 * pi() * (isodow({DUCK_TS}) - 1) / 7), 6) as day_sin, "
                  f"round(cos(2 * pi() * (isodow({DUCK_TS}) - 1) / 7), 6) as day_cos from flows")


def composite_features(spark, sf):
    ex = CompositeFeatures([NetworkTrafficFeatures(), TimeBasedFeatures()])
    return ex.extract_features(_flows(spark, sf)), ex.name


@register("feat_composite", _COMPOSITE_SQL, F1)
def q_feat_composite(spark, sf):
    """network_traffic then time_based, each on the other's output."""
    df, _ = composite_features(spark, sf)
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[r6(c).alias(c) if c in dbl else F.col(c) for c in COMPOSITE_OUT])


# ---------------------------------------------------------------- selection, filters

_INFERRED_NUM = ["id_orig_p", "id_resp_p", "duration", "orig_bytes", "resp_bytes", "missed_bytes",
                 "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes"]
_INFERRED_CAT = ["uid", "source_file", "id_orig_h", "id_resp_h", "proto", "service", "conn_state",
                 "history"]


@register("select_features", "select ts, " + ", ".join(_INFERRED_NUM + _INFERRED_CAT) + " from flows", F1)
def q_select_features(spark, sf):
    """Feature columns inferred by type (numbers, then text), target excluded."""
    f = _flows(spark, sf)
    num, cat = select_features(f, "label")
    return f.select(*num, *cat)


@register("drop_null_target",
          "select uid, coalesce(label, 'unknown') as label from flows where label is not null", F1)
def q_drop_null_target(spark, sf):
    """Rows with a null target dropped (restored and filled if none would remain)."""
    return drop_null_target(_flows(spark, sf), "label").select("uid", "label")


@register("filter_class", f"select uid, label from (select uid, {NORM_SQL} as label from flows) t "
                          "where label = 'malicious'", F1)
def q_filter_class(spark, sf):
    """Rows of one class."""
    f = _flows(spark, sf).select("uid", label_normalize("label").alias("label"))
    return f.where(F.col("label") == "malicious")
