"""Stand-in inputs built from the driver's tables (FIXTURES.md F1, F2, F5).

Each fixture is one list of SQL expressions that runs unchanged in Spark (through
``selectExpr``) and in DuckDB (as a CTE for the oracle).  Only the epoch expression
and the string type name differ.  The fixtures produce rows in the schema the jobs
expect; every job downstream is general and takes nothing from how these rows are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"EPOCH": "unix_seconds(cast(ts as timestamp))", "STR": "string"}
DUCK = {"EPOCH": "floor(epoch(ts))", "STR": "varchar"}

# F1 `flows` over `events`
FLOWS_COLS = [
    "concat('C', cast(event_id as {STR})) as uid",
    "concat('capture-', cast(user_id % 4 as {STR})) as source_file",
    "cast({EPOCH} as double) as ts",
    "concat('192.168.1.', cast(user_id % 256 as {STR})) as id_orig_h",
    "cast(1024 + event_id % 5000 as int) as id_orig_p",
    "concat('10.0.0.', cast(event_id % 64 as {STR})) as id_resp_h",
    "cast(case event_id % 3 when 0 then 23 when 1 then 80 else 443 end as int) as id_resp_p",
    "case event_type when 'error' then 'icmp' when 'purchase' then 'udp' else 'tcp' end as proto",
    "case event_type when 'error' then null when 'purchase' then 'dns' "
    "when 'view' then 'http' else '-' end as service",
    "case when event_id % 11 = 0 then null when event_id % 7 = 0 then cast(0 as double) "
    "else value end as duration",
    "case when event_id % 13 = 0 then null else cast(floor(value * 100) as double) end as orig_bytes",
    "cast(event_id % 1500 as double) as resp_bytes",
    "case when event_id % 6 = 0 then 'S0' when event_id % 6 < 4 then 'SF' else 'REJ' end as conn_state",
    "case when event_id % 5 = 0 then null else event_id % 2 = 0 end as local_orig",
    "event_id % 3 = 0 as local_resp",
    "cast(0 as double) as missed_bytes",
    "case event_id % 4 when 0 then 'S' when 1 then 'ShAdDaFf' when 2 then 'Sr' else null end as history",
    "cast(1 + event_id % 17 as double) as orig_pkts",
    "cast(40 * (1 + event_id % 17) as double) as orig_ip_bytes",
    "cast(event_id % 9 as double) as resp_pkts",
    "cast(40 * (event_id % 9) as double) as resp_ip_bytes",
    "case event_id % 10 when 0 then 'Attack' when 1 then 'ANOMALY' when 2 then 'Malicious' "
    "when 3 then 'DDoS' when 4 then null when 5 then 'Normal' else 'Benign' end as label",
]

# F2 `predictions` over `events`: classes 0 benign, 1 ddos, 2 malicious, 3 unknown; -1 unseen
_ACTUAL = ("case event_id % 10 when 3 then 1 when 4 then 3 "
           "when 0 then 2 when 1 then 2 when 2 then 2 else 0 end")
PREDICTIONS_COLS = [
    "concat('C', cast(event_id as {STR})) as uid",
    f"cast({_ACTUAL} as int) as actual",
    f"cast(case when event_id % 97 = 0 then -1 when event_id % 8 = 0 then event_id % 3 "
    f"else {_ACTUAL} end as int) as predicted",
    "cast((event_id * 37) % 1000 as double) / 1000 as score",
    "value as f_value",
    "cast(event_id % 17 as double) as f_pkts",
]

# F5 `flows_signal` over `flows`
FLOWS_SIGNAL_COLS = [
    "uid", "source_file", "ts", "proto", "conn_state", "orig_pkts", "resp_pkts", "resp_bytes",
    "coalesce(duration, 0) as duration", "coalesce(orig_bytes, 0) as orig_bytes",
    "case when resp_bytes > 1000 then 'malicious' when proto = 'icmp' then 'scan' "
    "else 'benign' end as label",
]


def _fmt(cols, dialect):
    return [c.format(**dialect) for c in cols]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_fmt(FLOWS_COLS, SPARK))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_fmt(PREDICTIONS_COLS, SPARK))


def flows_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).selectExpr(*FLOWS_SIGNAL_COLS)


# ---- DuckDB side (oracle text) -------------------------------------------------------

def duck_flows_sql() -> str:
    return "select " + ",\n  ".join(_fmt(FLOWS_COLS, DUCK)) + "\nfrom events"


def duck_predictions_sql() -> str:
    return "select " + ",\n  ".join(_fmt(PREDICTIONS_COLS, DUCK)) + "\nfrom events"


def duck_flows_signal_sql() -> str:
    return "select " + ",\n  ".join(FLOWS_SIGNAL_COLS) + "\nfrom flows"


def with_fixtures(body: str, *names: str) -> str:
    """Prefix an oracle query with the CTEs it needs (flows, predictions, flows_signal)."""
    ctes = []
    need = set(names)
    if "flows_signal" in need:
        need.add("flows")
    if "flows" in need:
        ctes.append(f"flows as (\n{duck_flows_sql()}\n)")
    if "flows_signal" in need:
        ctes.append(f"flows_signal as (\n{duck_flows_signal_sql()}\n)")
    if "predictions" in need:
        ctes.append(f"predictions as (\n{duck_predictions_sql()}\n)")
    if not ctes:
        return body
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
