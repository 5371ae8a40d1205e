"""Default run configuration (a plain dict, same shape as the reference's settings file)."""

from __future__ import annotations

import copy

# The reference's default feature lists (source header dots -> underscores).
CATEGORICAL = ["proto", "service", "conn_state", "local_orig", "local_resp", "history"]
NUMERICAL = ["id_orig_p", "id_resp_p", "duration", "orig_bytes", "resp_bytes", "missed_bytes",
             "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes", "total_bytes",
             "bytes_ratio", "total_pkts", "pkts_ratio", "bytes_per_sec", "pkts_per_sec"]

# The reference's default settings (those that this package reads).
DEFAULT_CONFIG = {
    "data": {
        "path": None,
        "file_pattern": "*.csv",
        "num_files": None,
        "chunk_size": 50_000,
        "max_rows": None,
        "balance_classes": True,
        "cache_processed": False,
    },
    "features": {
        "extractors": ["network_traffic", "time_based"],
        "categorical_columns": CATEGORICAL,
        "numerical_columns": NUMERICAL,
        "target_column": "label",
    },
    "training": {
        "output_dir": None,
        "seed": 42,
        "hyperparameter_tuning": False,      # then ``param_grids``: {model: {setting: values}}
        "param_grids": {},
        "models": {
            "random_forest": {"enabled": True, "n_estimators": 100, "max_depth": 10},
            "logistic_regression": {"enabled": True, "max_iter": 1000},
            "knn": {"enabled": True, "n_neighbors": 5},
            "svm": {"enabled": False, "kernel": "rbf", "C": 1.0},
            "gaussian_nb": {"enabled": True},
            "gmm": {"enabled": True, "n_components": 5},
        },
    },
}


def merged(config: dict | None) -> dict:
    """DEFAULT_CONFIG updated section by section with ``config``."""
    out = copy.deepcopy(DEFAULT_CONFIG)
    for sec, vals in (config or {}).items():
        if isinstance(vals, dict) and isinstance(out.get(sec), dict):
            for k, v in vals.items():
                if k == "models" and isinstance(v, dict):
                    for m, mc in v.items():
                        out[sec]["models"].setdefault(m, {}).update(mc)
                else:
                    out[sec][k] = v
        else:
            out[sec] = vals
    return out
