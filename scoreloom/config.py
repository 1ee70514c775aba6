"""Settings shared by all operators: key columns, cut-offs, messages and search ranges."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SnapshotSpec:
    """Names of the columns every monthly snapshot carries."""

    month: str = "base_ym"
    customer_id: str = "customer_id"
    customer_hash: str = "customer_hash"
    target: str = "PERF"

    @property
    def keys(self) -> tuple[str, str, str]:
        return (self.month, self.customer_id, self.customer_hash)


DEFAULT_SPEC = SnapshotSpec()

# The Korean key names of existing snapshot files
# (closing month, policyholder customer id, encrypted resident number).
KOREAN_SPEC = SnapshotSpec(
    month="마감년월",
    customer_id="계약자고객ID",
    customer_hash="계약자주민등록번호암호화",
    target="PERF",
)

# Validation messages.
MISSING_KEYS = "Missing key values."
NULL_KEYS = "Key values contain NULL."
DUPLICATE_ID = "Duplicate values found in '{id}'."
NO_TARGET = "No target data ('{target}') found."
NULL_TARGET = "Target data ('{target}') contains NULL."
EXTRA_TARGET = "Target data ('{target}') should be removed."
VALID = "Data is valid."
SCHEMA_MISMATCH = "Dataset mismatch."
TARGET_CHECK = "Check target column."

# Points scale.
BASE_SCORE = 600.0
POINTS_TO_DOUBLE_ODDS = 40.0
BASE_ODDS = 1.0
MIN_SCORE = 1.0
MAX_SCORE = 1000.0

# Lowest score of each grade, per score type.
GRADE_CUTOFFS = {
    "general": ((638, 1), (582, 2), (538, 3), (498, 4), (457, 5), (418, 6), (322, 7), (1, 8)),
    "single": ((638, 1), (582, 2), (538, 3), (498, 4), (457, 5), (418, 6), (322, 7), (1, 8)),
}

# Lowest probability of each evaluation band.
BAND_FLOORS = (
    (0.9, 1), (0.8, 2), (0.7, 3), (0.6, 4), (0.5, 5),
    (0.4, 6), (0.3, 7), (0.2, 8), (0.1, 9), (0.0, 10),
)

# Profiling and split defaults.
QUANTILES = (0.2, 0.4, 0.6, 0.8)
SPECIAL_VALUES = (-99999999.0,)
VALIDATION_SHARE = 0.3
SPLIT_SEED = 42
MODEL_SEED = 50
SEARCH_SEED = 1
SEARCH_TRIALS = 55
RANDOM_TRIALS = 5
PATIENCE = 10

# Hyperparameter ranges of the two learner presets.
SEARCH_BOUNDS = {
    "xgb": {
        "max_depth": (3, 10),
        "learning_rate": (0.01, 0.2),
        "n_estimators": (10, 300),
        "min_child_weight": (0, 10),
        "subsample": (0.5, 1),
        "colsample_bytree": (0.5, 1),
        "reg_alpha": (0, 10),
        "reg_lambda": (0, 10),
        "gamma": (0, 10),
    },
    "lgb": {
        "colsample_bytree": (0.5, 1),
        "learning_rate": (0.01, 0.2),
        "max_depth": (3, 20),
        "min_child_samples": (20, 1000),
        "n_estimators": (10, 500),
        "num_leaves": (5, 500),
        "subsample": (0.5, 1),
        "reg_alpha": (0, 10),
        "reg_lambda": (0, 10),
    },
}
INTEGER_PARAMETERS = ("max_depth", "n_estimators", "num_leaves", "min_child_samples")

